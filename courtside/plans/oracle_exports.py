"""DuckDB SQL for the exports: the rows that the files must hold."""

from __future__ import annotations

from courtside.plans.oracle_boxscore import ALL_PAIRS_H2H, LAST10_AVG_WITH_SUMMARY, RANKED_AVG_LAST_N, TOPK_AVG_LAST_N
from courtside.plans.oracle_text import INVERTED_INDEX_TOP15, TERM_COUNTS_WIDE
from courtside.plans.text import PAGE_TERMS

_TERMS = ", ".join(f'"{t}"' for t in PAGE_TERMS)


def _section(sql: str, name: str) -> str:
    return (f"SELECT '{name}' AS section, CAST(rank AS BIGINT) AS rank, c_custkey, c_name, printf('%.2f', avg_price) AS avg_price, n_games FROM ({sql})")


SQL = {
    "export_csv": LAST10_AVG_WITH_SUMMARY,
    "export_index": f"SELECT row_number() OVER (ORDER BY rank, block) AS position, word, block, document_ids FROM ({INVERTED_INDEX_TOP15})",
    "export_counts": f"SELECT url AS URL, {_TERMS} FROM ({TERM_COUNTS_WIDE})",
    "export_report": f"{_section(RANKED_AVG_LAST_N, 'all')} UNION ALL {_section(TOPK_AVG_LAST_N, 'top')}",
    "export_per_team": ALL_PAIRS_H2H,
}
