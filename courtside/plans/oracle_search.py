"""DuckDB SQL for the search queries: full scoring, no index."""

from __future__ import annotations

from courtside.operators.matrix import BLOCK_SIDE
from courtside.operators.search import SCORE_DECIMALS
from courtside.plans.oracle_text import _POSTINGS, html_raw_text, term_filter_v2, whitespace_tokens, word_tokens
from courtside.plans.search import SEARCH_K

_WANTED = _POSTINGS + f""",
wanted AS (SELECT DISTINCT query_id, term FROM (
  SELECT item_id AS query_id, unnest({word_tokens('text')}) AS term FROM benchmark WHERE item_id IS NOT NULL) WHERE {term_filter_v2('term')})"""

SEARCH_TOPK_DOCUMENTS = _WANTED + f""",
freq AS (SELECT term, count(*) AS n FROM post WHERE doc_id IS NOT NULL GROUP BY term),
size AS (SELECT count(doc_id) AS n FROM documents),
scored AS (
  SELECT w.query_id, p.doc_id, sum((1 + log10(p.tf)) * log10(size.n / freq.n)) AS score
  FROM wanted w JOIN post p ON p.term = w.term JOIN freq ON freq.term = w.term, size WHERE p.doc_id IS NOT NULL GROUP BY ALL)
SELECT query_id AS item_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, {SCORE_DECIMALS}) DESC, doc_id) AS INTEGER) AS rank, doc_id, round(score, 6) AS score
FROM scored QUALIFY rank <= {SEARCH_K}
"""

CONJUNCTIVE_SEARCH = _WANTED + """,
ends AS (SELECT query_id, min(term) AS a, max(term) AS b FROM wanted GROUP BY query_id)
SELECT e.query_id AS item_id, p.doc_id FROM ends e JOIN post p ON p.term = e.a JOIN post o ON o.term = e.b AND o.doc_id = p.doc_id
"""

_ALL_TERMS = f"""
WITH found AS (SELECT page_id, unnest({whitespace_tokens(f"lower({html_raw_text('html')})")}) AS term FROM pages),
post AS (SELECT term, page_id, count(*) AS n FROM found GROUP BY term, page_id),
freq AS (SELECT term, count(*) AS df, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id FROM post GROUP BY term),
size AS (SELECT count(*) AS d FROM pages),
w AS (SELECT p.term, f.term_id, p.page_id, (1 + log10(p.n)) * log10(size.d / f.df) AS tfidf FROM post p JOIN freq f ON p.term = f.term, size)
"""

TFIDF_ALL_TERMS = _ALL_TERMS + "SELECT term, page_id, round(tfidf, 6) AS tfidf FROM w"

TFIDF_BLOCKS = _ALL_TERMS + f"""
SELECT CAST(floor(term_id / {BLOCK_SIDE}) AS BIGINT) AS term_block, CAST(floor(page_id / {BLOCK_SIDE}) AS BIGINT) AS page_block,
       count(*) AS n_cells, min(term_id) AS first_term_id, round(sum(tfidf), 4) AS weight FROM w GROUP BY ALL
"""

SQL = {
    "conjunctive_search": CONJUNCTIVE_SEARCH,
    "tfidf_all_terms": TFIDF_ALL_TERMS,
    "tfidf_blocks": TFIDF_BLOCKS,
    "search_topk_documents": SEARCH_TOPK_DOCUMENTS,
}
