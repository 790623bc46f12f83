"""DuckDB SQL for the graph queries: iterations unrolled into CTE chains."""

from __future__ import annotations

from courtside.plans.graph import HITS_STEPS, PAGE_RANK_DECIMALS, PAGE_RANK_STEPS, PAGERANK_STEPS
from courtside.plans.oracle_text import absolutize, anchor_hrefs, strip_trailing_slash

_TRADE = """
per_order AS (
  SELECT l.l_orderkey, s.s_nationkey, sum(l.l_extendedprice) AS rev
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY l.l_orderkey, s.s_nationkey),
rev AS (
  SELECT p.s_nationkey AS src, c.c_nationkey AS dst, sum(p.rev) AS revenue
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE p.s_nationkey <> c.c_nationkey
  GROUP BY p.s_nationkey, c.c_nationkey),
edges AS (SELECT DISTINCT src, dst FROM rev WHERE revenue > (SELECT avg(revenue) FROM rev)),
v AS (SELECT DISTINCT n_nationkey AS id FROM nation),
nn AS (SELECT count(*) AS n FROM v)"""

OUT_DEGREE_TRADE = "WITH " + _TRADE + """
SELECT src, count(*) AS out_degree FROM edges GROUP BY src
"""


def _pagerank_chain(steps: int, graph: str = _TRADE) -> str:
    """Rank vectors r0..r<steps> of the tables ``v`` (id), ``nn`` (n) and ``edges`` (src, dst) that ``graph`` makes."""
    ctes = [graph,
            "deg AS (SELECT src, count(*) AS deg FROM edges GROUP BY src)",
            "w AS (SELECT e.src, e.dst, 1.0::DOUBLE / d.deg AS w FROM edges e JOIN deg d ON e.src = d.src)",
            "dang AS (SELECT id FROM v WHERE id NOT IN (SELECT src FROM deg))",
            "r0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM nn) AS rank FROM v)"]
    for i in range(1, steps + 1):
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT v.id, 0.85 * coalesce(c.c, 0.0) "
            f"+ 0.85 * (SELECT coalesce(sum(rank), 0.0) FROM r{i - 1} WHERE id IN (SELECT id FROM dang)) "
            f"/ (SELECT n FROM nn) + 0.15 / (SELECT n FROM nn) AS rank "
            f"FROM v LEFT JOIN (SELECT w.dst, sum(r.rank * w.w) AS c FROM r{i - 1} r "
            f"JOIN w ON r.id = w.src GROUP BY w.dst) c ON v.id = c.dst)")
    return "WITH " + ",\n".join(ctes)


PAGERANK_TRADE = _pagerank_chain(PAGERANK_STEPS) + f"""
SELECT id AS n_nationkey, round(rank, 6) AS rank FROM r{PAGERANK_STEPS}
"""

# The converged listing is compared at 3 decimals against 100 unrolled steps.
PAGERANK_REPORT = _pagerank_chain(100) + """
SELECT n.n_name AS node, printf('%.3f', r.rank) AS rank_text,
       n.n_name || ' : ' || printf('%.3f', r.rank) AS line
FROM r100 r JOIN nation n ON r.id = n.n_nationkey
"""


def _hits_chain(steps: int) -> str:
    ctes = [_TRADE, "h0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM nn) AS hub FROM v)"]
    for i in range(1, steps + 1):
        ctes.append(
            f"a{i}raw AS (SELECT v.id, coalesce(x.a, 0.0) AS a FROM v LEFT JOIN "
            f"(SELECT e.dst, sum(h.hub) AS a FROM h{i - 1} h JOIN edges e ON h.id = e.src GROUP BY e.dst) x "
            f"ON v.id = x.dst)")
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT id, a / nullif((SELECT max(a) FROM a{i}raw), 0) AS authority "
            f"FROM a{i}raw)")
        ctes.append(
            f"h{i}raw AS (SELECT v.id, coalesce(x.h, 0.0) AS h FROM v LEFT JOIN "
            f"(SELECT e.src, sum(a.authority) AS h FROM a{i} a JOIN edges e ON a.id = e.dst GROUP BY e.src) x "
            f"ON v.id = x.src)")
        ctes.append(
            f"h{i} AS MATERIALIZED (SELECT id, h / nullif((SELECT max(h) FROM h{i}raw), 0) AS hub "
            f"FROM h{i}raw)")
    return "WITH " + ",\n".join(ctes)


HITS_TRADE = _hits_chain(HITS_STEPS) + f"""
SELECT h.id AS n_nationkey,
       round(h.hub / (SELECT sum(hub) FROM h{HITS_STEPS}), 6) AS hub,
       round(a.authority / (SELECT sum(authority) FROM a{HITS_STEPS}), 6) AS authority
FROM h{HITS_STEPS} h JOIN a{HITS_STEPS} a ON h.id = a.id
"""

_HREFS = f"SELECT page_id, url, unnest({anchor_hrefs('html')}) AS href FROM pages"

PAGE_OUT_DEGREE = f"""
SELECT src, count(*) AS out_degree FROM (
  SELECT DISTINCT page_id AS src, {strip_trailing_slash(absolutize('href', 'url'))} AS dst
  FROM ({_HREFS}))
GROUP BY src
"""


def _last_segment(expr: str) -> str:
    return f"list_extract(string_split({strip_trailing_slash(expr)}, '/'), -1)"


LINK_GRAPH_IN_SET = f"""
WITH l AS (SELECT url AS src, {absolutize('href', 'url')} AS dst FROM ({_HREFS})),
shared AS (SELECT dst FROM l GROUP BY dst HAVING count(DISTINCT src) >= 2),
known AS (SELECT url AS id FROM pages UNION SELECT dst FROM shared UNION SELECT {strip_trailing_slash('dst')} FROM shared),
e AS (SELECT src, {strip_trailing_slash('dst')} AS dst FROM l WHERE dst IN (SELECT id FROM known) AND src <> dst)
SELECT DISTINCT {_last_segment('src')} AS src_node, {_last_segment('dst')} AS dst_node FROM e
WHERE dst IN (SELECT id FROM known) AND src <> dst
"""

_PAGE_GRAPH = f"""
e2 AS ({LINK_GRAPH_IN_SET}),
edges AS (SELECT src_node AS src, dst_node AS dst FROM e2),
v AS (SELECT DISTINCT id FROM (SELECT {_last_segment('url')} AS id FROM pages UNION ALL SELECT src FROM edges UNION ALL SELECT dst FROM edges) WHERE id IS NOT NULL),
nn AS (SELECT count(*) AS n FROM v)"""

PAGERANK_PAGES = _pagerank_chain(PAGE_RANK_STEPS, _PAGE_GRAPH) + f"""
SELECT id AS node, round(rank, {PAGE_RANK_DECIMALS}) AS rank, printf('%.3f', rank) AS rank_text FROM r{PAGE_RANK_STEPS}
"""

SQL = {
    "pagerank_pages": PAGERANK_PAGES,
    "out_degree_trade": OUT_DEGREE_TRADE,
    "pagerank_trade": PAGERANK_TRADE,
    "pagerank_report": PAGERANK_REPORT,
    "hits_trade": HITS_TRADE,
    "page_out_degree": PAGE_OUT_DEGREE,
    "link_graph_in_set": LINK_GRAPH_IN_SET,
}
