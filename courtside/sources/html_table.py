"""Box-score tables landed as HTML (A4, A5).

A landed page holds a ``<table>``; its body rows become ``cells
array<string>`` (the visible text of each ``<td>``, stripped), numbered in
page order.  Extraction is three built-in regex functions per page, so it
runs in the scan's tasks with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.text import html_to_text

RE_TBODY = r"(?is)<tbody\b[^>]*>(.*?)</tbody>"
RE_ROW = r"(?is)<tr\b.*?</tr>"
RE_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"


def table_body(html: Column | str) -> Column:
    """The first ``<tbody>`` of the page, or the whole page when it has none."""
    h = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    body = F.regexp_extract(h, RE_TBODY, 1)
    return F.when(body != "", body).otherwise(h)


def html_table_rows(pages: DataFrame, key_cols: list[str], html_col: str = "html") -> DataFrame:
    """``key_cols, row_no, cells``: one row per ``<tr>`` of the table body (A4).

    ``row_no`` is 0-based page order (the recency order of a game log).
    Rows without ``<td>`` cells (header rows) keep an empty array; the arity
    guard of the consumer drops them.
    """
    rows = pages.select(*key_cols, F.posexplode(
        F.regexp_extract_all(table_body(html_col), F.lit(RE_ROW), 0)).alias("row_no", "tr"))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(RE_CELL), 1), lambda c: html_to_text(c))
    return rows.select(*key_cols, "row_no", cells.alias("cells"))
