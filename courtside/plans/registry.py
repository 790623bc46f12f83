"""Registry of the end-to-end queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtside.plans import boxscore, exports, graph, oracle_boxscore, oracle_exports, oracle_graph, oracle_search, oracle_text, search, text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "topk_avg_last_n": boxscore.topk_avg_last_n,
    "ranked_avg_last_n": boxscore.ranked_avg_last_n,
    "last_n_values_wide": boxscore.last_n_values_wide,
    "last10_avg_with_summary": boxscore.last10_avg_with_summary,
    "player_report": boxscore.player_report,
    "head_to_head_opponent": boxscore.head_to_head_opponent,
    "head_to_head_recent5": boxscore.head_to_head_recent5,
    "matchup_validation": boxscore.matchup_validation,
    "cells_guarded_cast": boxscore.cells_guarded_cast,
    "order_table_rows": boxscore.order_table_rows,
    "entity_search_first_hit": boxscore.entity_search_first_hit,
    "last10_rollup_summary": boxscore.last10_rollup_summary,
    "all_pairs_head_to_head": boxscore.all_pairs_h2h,
    "all_pairs_by_game": boxscore.all_pairs_h2h_by_game,
    "name_search": boxscore.name_search,
    "page_text": text.page_text,
    "page_raw_text": text.page_raw_text,
    "page_links": text.page_links,
    "page_links_absolute": text.page_links_absolute,
    "link_last_segment": text.link_last_segment,
    "tokens_clean": text.tokens_clean,
    "tokens_clean_v1": text.tokens_clean_v1,
    "page_url_forms": text.page_url_forms,
    "top15_terms": text.top15_terms,
    "top15_terms_en": text.top15_terms_en,
    "inverted_index_top15": text.inverted_index_top15,
    "inverted_index_stemmed": text.inverted_index_stemmed,
    "inverted_index_stemmed_en": text.inverted_index_stemmed_en,
    "term_counts_wide": text.term_counts_wide,
    "document_frequency": text.document_frequency,
    "idf": text.idf,
    "tf_sublinear": text.tf_sublinear,
    "tfidf": text.tfidf,
    "tfidf_matrix": text.tfidf_matrix,
    "search_topk": text.search_topk,
    "precision_recall": text.precision_recall,
    "out_degree_trade": graph.out_degree_trade,
    "pagerank_trade": graph.pagerank_trade,
    "pagerank_report": graph.pagerank_report,
    "hits_trade": graph.hits_trade,
    "page_out_degree": graph.page_out_degree,
    "link_graph_in_set": graph.link_graph_in_set,
    "pagerank_pages": graph.pagerank_pages,
    "search_topk_documents": search.search_topk_documents,
    "conjunctive_search": search.conjunctive_search,
    "tfidf_blocks": search.tfidf_blocks,
    "tfidf_all_terms": search.tfidf_all_terms,
    "export_csv": exports.export_csv,
    "export_index": exports.export_index,
    "export_counts": exports.export_counts,
    "export_report": exports.export_report,
    "export_per_team": exports.export_per_team,
}

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(oracle_boxscore.SQL)
ORACLE_SQL.update(oracle_text.SQL)
ORACLE_SQL.update(oracle_graph.SQL)
ORACLE_SQL.update(oracle_search.SQL)
ORACLE_SQL.update(oracle_exports.SQL)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
