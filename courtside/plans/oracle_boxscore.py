"""DuckDB SQL for the box-score queries (the correctness oracle).

Each string runs against views named after the driver tables and returns the
same columns (names and types) as the matching Spark query.
"""

from __future__ import annotations

from courtside.plans.boxscore import H2H_SEASONS, H2H_TEAM1, H2H_TEAM2, PLAYER_NAME

_LAST3 = """
WITH last3 AS (
  SELECT o_custkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
  QUALIFY rn <= 3
), per_cust AS (
  SELECT o_custkey,
         max(CASE WHEN rn = 1 THEN o_totalprice END) AS g1,
         max(CASE WHEN rn = 2 THEN o_totalprice END) AS g2,
         max(CASE WHEN rn = 3 THEN o_totalprice END) AS g3,
         avg(o_totalprice) AS avg_price,
         count(o_totalprice) AS n_games
  FROM last3 GROUP BY o_custkey
), s AS (
  SELECT c.c_custkey, c.c_name, p.g1, p.g2, p.g3, p.avg_price, p.n_games
  FROM per_cust p JOIN customer c ON p.o_custkey = c.c_custkey
)
"""

TOPK_AVG_LAST_N = _LAST3 + """
SELECT CAST(row_number() OVER (ORDER BY s.avg_price DESC, c_custkey) AS INTEGER) AS rank,
       c_custkey, c_name, g1, g2, g3, round(avg_price, 6) AS avg_price, n_games
FROM s ORDER BY s.avg_price DESC, c_custkey LIMIT 5
"""

RANKED_AVG_LAST_N = _LAST3 + """
SELECT CAST(row_number() OVER (ORDER BY s.avg_price DESC, c_custkey) AS BIGINT) AS rank,
       c_custkey, c_name, g1, g2, g3, round(avg_price, 6) AS avg_price, n_games
FROM s
"""

LAST_N_VALUES_WIDE = """
WITH last3 AS (
  SELECT o_custkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
  QUALIFY rn <= 3
)
SELECT o_custkey,
       max(CASE WHEN rn = 1 THEN o_totalprice END) AS g1,
       max(CASE WHEN rn = 2 THEN o_totalprice END) AS g2,
       max(CASE WHEN rn = 3 THEN o_totalprice END) AS g3
FROM last3 GROUP BY o_custkey
"""

_LAST10 = """
WITH per_order AS (
  SELECT l_orderkey,
         CAST(sum(l_quantity) AS INTEGER) AS points,
         CAST(count(*) AS INTEGER) AS rebounds,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS assists
  FROM lineitem GROUP BY l_orderkey
), recent AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS seq
  FROM orders WHERE o_custkey IS NOT NULL QUALIFY seq <= 10
), last10 AS (
  SELECT r.*, p.points, p.rebounds, p.assists FROM recent r JOIN per_order p ON r.o_orderkey = p.l_orderkey
), means AS (
  SELECT o_custkey, avg(points) AS points, avg(rebounds) AS rebounds, avg(assists) AS assists
  FROM last10 GROUP BY o_custkey
)
"""

_LAST10_ROWS = """
SELECT o_custkey AS c_custkey, seq,
       strftime(o_orderdate, '%b %d, %Y') || ' - #' || CAST(o_orderkey AS VARCHAR) AS game,
       CAST(points AS DOUBLE) AS points, CAST(rebounds AS DOUBLE) AS rebounds,
       CAST(assists AS DOUBLE) AS assists
FROM last10
UNION ALL
SELECT c.c_custkey, CAST(NULL AS INTEGER) AS seq, 'Averages' AS game,
       round_even(coalesce(m.points, 0.0), 2) AS points,
       round_even(coalesce(m.rebounds, 0.0), 2) AS rebounds,
       round_even(coalesce(m.assists, 0.0), 2) AS assists
FROM customer c LEFT JOIN means m ON c.c_custkey = m.o_custkey
"""

LAST10_AVG_WITH_SUMMARY = _LAST10 + _LAST10_ROWS

PLAYER_REPORT = _LAST10 + f"""
, wanted AS (SELECT min(c_custkey) AS k FROM customer WHERE c_name = '{PLAYER_NAME}')
SELECT * FROM ({_LAST10_ROWS}) WHERE c_custkey = (SELECT k FROM wanted)
"""

HEAD_TO_HEAD_OPPONENT = f"""
WITH games AS (
  SELECT n.n_name AS team, CAST(year(o.o_orderdate) AS INTEGER) AS season, o.o_orderdate, o.o_orderkey,
         CAST(floor(sum(l.l_extendedprice) / 1000) AS BIGINT) AS points,
         strftime(o.o_orderdate, '%b %d, %Y') || ' - {H2H_TEAM1} vs. {H2H_TEAM2}' AS game_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation m ON s.s_nationkey = m.n_nationkey
  WHERE n.n_name IN ('{H2H_TEAM1}', '{H2H_TEAM2}') AND m.n_name IN ('{H2H_TEAM1}', '{H2H_TEAM2}') AND n.n_name <> m.n_name
    AND year(o.o_orderdate) BETWEEN {H2H_SEASONS[0]} AND {H2H_SEASONS[1]}
  GROUP BY n.n_name, o.o_orderkey, o.o_orderdate
), numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY team, season ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS pos FROM games
), z AS (
  SELECT a.season, a.pos, a.game_date AS matchup, a.points AS pts1, b.points AS pts2
  FROM numbered a JOIN numbered b ON a.season = b.season AND a.pos = b.pos
  WHERE a.team = '{H2H_TEAM1}' AND b.team = '{H2H_TEAM2}'
)
SELECT CAST(row_number() OVER (ORDER BY season DESC, pos) AS INTEGER) AS rank, season,
       CAST(season AS VARCHAR) || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season_label,
       pos, matchup, pts1, pts2,
       CASE WHEN pts1 > pts2 THEN '{H2H_TEAM1}' ELSE '{H2H_TEAM2}' END AS winner,
       printf('%s %d - %s %d', '{H2H_TEAM1}', pts1, '{H2H_TEAM2}', pts2) AS score
FROM z ORDER BY season DESC, pos LIMIT 5
"""

HEAD_TO_HEAD_RECENT5 = f"""
WITH games AS (
  SELECT n.n_name AS team, CAST(year(o.o_orderdate) AS INTEGER) AS season,
         o.o_orderdate, o.o_orderkey,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS points,
         strftime(o.o_orderdate, '%b %d, %Y') || ' - {H2H_TEAM1} vs. {H2H_TEAM2}' AS game_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_name IN ('{H2H_TEAM1}', '{H2H_TEAM2}')
), numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY team, season
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS pos
  FROM games
), z AS (
  SELECT a.season, a.pos, a.game_date AS matchup, a.points AS pts1, b.points AS pts2
  FROM numbered a JOIN numbered b ON a.season = b.season AND a.pos = b.pos
  WHERE a.team = '{H2H_TEAM1}' AND b.team = '{H2H_TEAM2}'
)
SELECT CAST(row_number() OVER (ORDER BY season DESC, pos) AS INTEGER) AS rank,
       season,
       CAST(season AS VARCHAR) || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season_label,
       pos, matchup, pts1, pts2,
       CASE WHEN pts1 > pts2 THEN '{H2H_TEAM1}' ELSE '{H2H_TEAM2}' END AS winner,
       printf('%s %d - %s %d', '{H2H_TEAM1}', pts1, '{H2H_TEAM2}', pts2) AS score
FROM z ORDER BY season DESC, pos LIMIT 5
"""

MATCHUP_VALIDATION = """
WITH trades AS (
  SELECT c.c_nationkey, s.s_nationkey, count(*) AS n_trades
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY c.c_nationkey, s.s_nationkey
), named AS (
  SELECT team1, team2, CAST(sum(n_trades) AS BIGINT) AS n_trades FROM (
    SELECT n1.n_name AS team1, unnest([n2.n_name, g.r_name]) AS team2, t.n_trades
    FROM trades t JOIN nation n1 ON t.c_nationkey = n1.n_nationkey
    JOIN nation n2 ON t.s_nationkey = n2.n_nationkey JOIN region g ON n2.n_regionkey = g.r_regionkey)
  GROUP BY team1, team2
)
SELECT r.team1, r.team2, r.n_trades, d1.n_nationkey AS id1, d2.n_nationkey AS id2,
       CASE WHEN r.team1 = r.team2 THEN 'same_team'
            WHEN d1.n_nationkey IS NULL OR d2.n_nationkey IS NULL THEN 'unknown_team'
            ELSE 'ok' END AS status
FROM named r LEFT JOIN nation d1 ON r.team1 = d1.n_name
LEFT JOIN nation d2 ON r.team2 = d2.n_name
"""

CELLS_GUARDED_CAST = r"""
WITH r AS (
  SELECT user_id, ts, event_id,
         [strftime(ts, '%Y-%m-%d'), event_type, CAST(user_id AS VARCHAR),
          CASE WHEN event_type = 'error' THEN 'DNP'
               ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END,
          CASE WHEN event_type = 'view' THEN ' '
               ELSE regexp_extract(props, '"k":\s*(\d+)', 1) || '%' END][1:CASE WHEN event_id % 7 = 0 THEN 3 ELSE 5 END] AS cells
  FROM events
), last10 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM r QUALIFY rn <= 10
), cellv AS (
  SELECT user_id, trim(cells[4]) AS p,
         trim(regexp_replace(trim(cells[5]), '^%+|%+$', '', 'g')) AS q
  FROM last10 WHERE len(cells) > 3
), parsed AS (
  SELECT user_id,
         CASE WHEN regexp_matches(p, '^[+-]?[0-9]+$') THEN TRY_CAST(p AS INTEGER) END AS points,
         CASE WHEN regexp_matches(q, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$')
              THEN TRY_CAST(q AS DOUBLE) END AS pct
  FROM cellv
)
SELECT user_id, count(*) AS n_rows, count(points) AS n_valid,
       round(coalesce(avg(points), 0.0), 6) AS avg_points,
       count(pct) AS n_pct, round(avg(pct), 6) AS avg_pct
FROM parsed GROUP BY user_id
"""

ORDER_TABLE_ROWS = """
SELECT l_orderkey, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS line_sum,
       count(*) FILTER (WHERE l_returnflag <> 'R') AS n_valid,
       CAST(sum(CAST(l_quantity AS INTEGER)) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS quantity,
       round(avg(round(l_discount * 100)), 6) AS avg_discount
FROM lineitem WHERE NOT l_tax > 0.07 GROUP BY l_orderkey
"""

ENTITY_SEARCH_FIRST_HIT = r"""
WITH hit AS (
  SELECT lang, min(doc_id) AS doc_id FROM documents GROUP BY lang
), req AS (
  SELECT page_id,
         regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) AS lang,
         regexp_extract(url, '/[a-z]{2}/(\d+)', 1) AS url_num
  FROM pages
)
SELECT req.page_id, req.lang, req.url_num, hit.doc_id
FROM req LEFT JOIN hit ON req.lang = hit.lang
"""

_TRADE_GAMES = """
WITH per_order AS (
  SELECT l.l_orderkey, s.s_nationkey, sum(l.l_extendedprice) AS total
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY l.l_orderkey, s.s_nationkey
), games AS (
  SELECT o.o_orderkey, o.o_orderdate, CAST(year(o.o_orderdate) AS INTEGER) AS season, n.n_name AS team, m.n_name AS opponent,
         CAST(floor(p.total / 1000) AS BIGINT) AS points
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN nation m ON p.s_nationkey = m.n_nationkey
)"""

_PAIR_LABELS = """
       CAST(season AS VARCHAR) || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season_label,
       pts1, pts2, CASE WHEN pts1 > pts2 THEN team1 ELSE team2 END AS winner, printf('%s %d - %s %d', team1, pts1, team2, pts2) AS score"""

ALL_PAIRS_H2H = _TRADE_GAMES + f""", numbered AS (
  SELECT *, least(team, opponent) AS team1, greatest(team, opponent) AS team2,
         CAST(row_number() OVER (PARTITION BY team, opponent, season ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS pos
  FROM games WHERE team <> opponent
), z AS (
  SELECT a.team1, a.team2, a.season, a.pos, strftime(a.o_orderdate, '%b %d, %Y') || ' - ' || a.team1 || ' vs. ' || a.team2 AS matchup, a.points AS pts1, b.points AS pts2
  FROM numbered a JOIN numbered b ON a.team = b.opponent AND a.opponent = b.team AND a.season = b.season AND a.pos = b.pos WHERE a.team = a.team1
)
SELECT team1, team2, CAST(row_number() OVER (PARTITION BY team1, team2 ORDER BY season DESC, pos) AS INTEGER) AS rank, season, pos, matchup,{_PAIR_LABELS}
FROM z QUALIFY rank <= 5
"""

ALL_PAIRS_H2H_BY_GAME = _TRADE_GAMES + f""", z AS (
  SELECT a.opponent AS team1, b.opponent AS team2, a.season, a.o_orderkey AS game, a.o_orderdate, a.points AS pts1, b.points AS pts2
  FROM games a JOIN games b ON a.o_orderkey = b.o_orderkey AND a.opponent < b.opponent
)
SELECT team1, team2, CAST(row_number() OVER (PARTITION BY team1, team2 ORDER BY season DESC, o_orderdate DESC, game) AS INTEGER) AS rank, season, game, strftime(o_orderdate, '%b %d, %Y') AS game_date,{_PAIR_LABELS}
FROM z QUALIFY rank <= 5
"""

NAME_SEARCH = r"""
WITH entities AS (
  SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'part', p_partkey, p_name FROM part
), held AS (
  SELECT kind, id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(name), '[^\p{L}\p{N}]+'), lambda t: t <> ''))) AS token FROM entities
), asked AS (
  SELECT 'Customer' AS first_name, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS last_name FROM orders
  UNION SELECT string_split(p_name, ' ')[1], string_split(p_name, ' ')[2] FROM part
  UNION SELECT string_split(p_name, ' ')[2], string_split(p_name, ' ')[1] FROM part
  UNION SELECT string_split(p_name, ' ')[1], p_type FROM part
  UNION SELECT p_brand, string_split(p_name, ' ')[2] FROM part
), words AS (
  SELECT first_name, last_name, list_distinct(list_filter(regexp_split_to_array(lower(concat_ws(' ', first_name, last_name)), '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS w FROM asked
), met AS (
  SELECT first_name, last_name, kind, id FROM (SELECT first_name, last_name, len(w) AS n, unnest(w) AS token FROM words) x JOIN held USING (token)
  GROUP BY first_name, last_name, n, kind, id HAVING count(*) = n
), best AS (SELECT first_name, last_name, count(*) AS n_hits, min(struct_pack(kind := kind, id := id)) AS k FROM met GROUP BY first_name, last_name)
SELECT a.first_name, a.last_name, coalesce(b.n_hits, 0) AS n_hits, b.k.kind AS kind, b.k.id AS id,
       CASE WHEN b.n_hits IS NULL THEN 'unknown' WHEN b.n_hits = 1 THEN 'found' ELSE 'ambiguous' END AS status
FROM asked a LEFT JOIN best b ON a.first_name IS NOT DISTINCT FROM b.first_name AND a.last_name IS NOT DISTINCT FROM b.last_name
"""

SQL = {
    "last10_rollup_summary": LAST10_AVG_WITH_SUMMARY,
    "all_pairs_head_to_head": ALL_PAIRS_H2H,
    "all_pairs_by_game": ALL_PAIRS_H2H_BY_GAME,
    "name_search": NAME_SEARCH,
    "topk_avg_last_n": TOPK_AVG_LAST_N,
    "ranked_avg_last_n": RANKED_AVG_LAST_N,
    "last_n_values_wide": LAST_N_VALUES_WIDE,
    "last10_avg_with_summary": LAST10_AVG_WITH_SUMMARY,
    "player_report": PLAYER_REPORT,
    "head_to_head_opponent": HEAD_TO_HEAD_OPPONENT,
    "head_to_head_recent5": HEAD_TO_HEAD_RECENT5,
    "matchup_validation": MATCHUP_VALIDATION,
    "cells_guarded_cast": CELLS_GUARDED_CAST,
    "order_table_rows": ORDER_TABLE_ROWS,
    "entity_search_first_hit": ENTITY_SEARCH_FIRST_HIT,
}
