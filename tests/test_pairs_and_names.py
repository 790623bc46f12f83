"""All-pairs head-to-head, name search and the grouping-set summary against plain Python."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from courtside.operators.h2h import all_pairs_by_game, all_pairs_head_to_head, head_to_head, head_to_head_by_game
from courtside.operators.lastn import rollup_summary
from courtside.operators.lookup import name_index, name_tokens, search_names
from courtside.plans.boxscore import all_pairs_h2h_by_game
from courtside.sources.tables import row_bounded
from tests.conftest import SF_SMALL

GAMES = "side string, opponent string, season int, day int, points long, label string"


def trade(n, seed):
    r = random.Random(seed)
    teams = ["A", "B", "C", "D"]
    rows = []
    for k in range(n):
        a, b = r.choices(teams, [5, 3, 2, 1], k=2)
        rows.append((a, b, 2000 + r.randint(0, 3), k, r.randint(80, 130), f"game {k}"))
    return rows + [("A", None, 2001, n, 1, "x"), (None, "A", 2001, n + 1, 1, "x")]


def test_zip_equals_the_single_pair_query(spark):
    rows = trade(400, 1)
    games = spark.createDataFrame(rows, GAMES)
    got = all_pairs_head_to_head(games, "side", "opponent", "season", [F.col("day").desc()], "points", "label").collect()
    found = defaultdict(list)
    for x in got:
        found[x.team1, x.team2].append(tuple(x)[2:])
    want = {}
    for a, b in [(a, b) for a in "ABCD" for b in "ABCD" if a < b]:
        own = games.where(f"(side = '{a}' and opponent = '{b}') or (side = '{b}' and opponent = '{a}')")
        one = head_to_head(own, "side", "season", [F.col("day").desc()], "points", "label", a, b, a, b)
        cols = ["rank", "season", "season_label", "pos", "matchup", "pts1", "pts2", "winner", "score"]
        if rows_ := sorted(tuple(x[c] for c in cols) for x in one.collect()):
            want[a, b] = rows_
    assert {k: sorted(v) for k, v in found.items()} == want and all(len(v) <= 5 for v in want.values())


def test_by_game_equals_the_single_pair_query(spark):
    r = random.Random(2)
    rows = [(g, s, 2000 + g % 3, g // 4, r.randint(1, 50)) for g in range(120) for s in r.sample("ABCDE", r.randint(0, 4))]
    rows += [(5, "A", 2002, 1, 7), (9, None, 2000, 2, 3)]
    games = spark.createDataFrame(rows, "game long, side string, season int, day int, points long")
    got = defaultdict(list)
    for x in all_pairs_by_game(games, "side", "game", "season", "day", "points").collect():
        got[x.team1, x.team2].append((x.rank, x.season, x.game, x.pts1, x.pts2, x.winner, x.score))
    once = games.groupBy("game", "side", "season", "day").agg(F.sum("points").alias("points")).withColumn("label", F.lit(""))
    want = {}
    for a, b in [(a, b) for a in "ABCDE" for b in "ABCDE" if a < b]:
        one = head_to_head_by_game(once, "side", "game", "season", "day", "points", "label", a, b, a, b)
        if rows_ := sorted((x["rank"], x.season, x.game, x.pts1, x.pts2, x.winner, x.score) for x in one.collect()):
            want[a, b] = rows_
    assert {k: sorted(v) for k, v in got.items()} == want


def test_pairs_expand_in_bounded_partitions(spark):
    rnd = random.Random(4)
    rows = [(g, s, 2000 + g % 3, g // 4, rnd.randint(0, 50)) for g in range(200) for s in rnd.sample("ABCDE", 3)]
    games = spark.createDataFrame(rows, "game long, side string, season int, day int, points long")
    plain, bounded = (all_pairs_by_game(games, "side", "game", "season", "day", "points", partitions=p) for p in (None, 9))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("explode(slice"):]  # one shuffle, by game, and its number stays
    assert below.count("Exchange hashpartitioning") == 1 and ", 9), REPARTITION_BY_NUM" in below
    assert sorted(map(tuple, bounded.collect())) == sorted(map(tuple, plain.collect()))


def test_partitions_grow_with_the_rows(spark):
    assert [row_bounded(spark.range(n), 10) for n in (0, 35, 1000, 1001)] == [spark.sparkContext.defaultParallelism] * 2 + [100, 101]
    plan = all_pairs_h2h_by_game(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_no_games(spark):
    games = spark.createDataFrame([], GAMES)
    assert all_pairs_head_to_head(games, "side", "opponent", "season", [F.col("day").desc()], "points", "label").collect() == []


def test_pairs_are_limited_before_the_shuffle(spark):
    games = spark.createDataFrame(trade(10, 1), GAMES)
    plan = all_pairs_head_to_head(games, "side", "opponent", "season", [F.col("day").desc()], "points", "label")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "Cartesian" not in plan and "NestedLoop" not in plan


ENTITIES = [(3, "LeBron James"), (1, "James Harden"), (2, "Mike James"), (7, "James, Mike"), (8, "Łukasz O'Neal-Smith"), (9, None), (None, "Mike James"), (10, "")] + [(k, f"Player {k}") for k in range(100, 160)]
REQUESTS = [("Mike", "James"), ("james", "HARDEN"), ("Mike", "Harden"), ("Nobody", "James"), ("James", None), (None, None), ("", " "), ("O'Neal", "Łukasz"), ("Player", "120"), ("Player", "99"), ("Mike", "James")]


def words(name):
    return {w for w in re.split(r"[\W_]+", (name or "").lower()) if w}


def test_names_equal_plain_search(spark):
    entities = spark.createDataFrame(ENTITIES, "id long, name string")
    asked = spark.createDataFrame(REQUESTS, "first string, last string")
    got = {(r.first_, r.last): (r.n_hits, r.key, r.status) for r in
           search_names(asked.withColumnRenamed("first", "first_"), name_index(entities, F.col("id"), "name"), ["first_", "last"]).collect()}
    want = {}
    for a, b in REQUESTS:
        need = words(f"{a or ''} {b or ''}")
        hits = sorted(i for i, n in ENTITIES if i is not None and need and need <= words(n))
        want[a, b] = (len(hits), hits[0] if hits else None, "unknown" if not hits else "found" if len(hits) == 1 else "ambiguous")
    assert got == want
    assert want["Mike", "James"] == (2, 2, "ambiguous") and want["Mike", "Harden"][2] == "unknown"


def test_name_tokens(spark):
    got = spark.createDataFrame([("Jean-Luc  jean PICARD_2",), (None,), ("--",)], "n string").select(name_tokens("n")).collect()
    assert [r[0] for r in got] == [["jean", "luc", "picard", "2"], [], []]


@pytest.mark.parametrize("rows, want", [
    ([], []),
    ([(1, None, None, None)], [(1, None, "Averages", 0.0)]),
    ([(1, 1, "g", 3), (1, 2, "g", 4), (2, 1, "Averages", 5), (3, None, None, None)],
     [(1, 1, "g", 3.0), (1, 2, "g", 4.0), (1, None, "Averages", 3.5), (2, 1, "Averages", 5.0), (2, None, "Averages", 5.0), (3, None, "Averages", 0.0)]),
    ([(1, 1, "g", 1), (1, 2, None, 2), (1, 3, "h", 2)], [(1, 1, "g", 1.0), (1, 2, None, 2.0), (1, 3, "h", 2.0), (1, None, "Averages", 1.67)])])
def test_rollup_summary(spark, rows, want):
    df = spark.createDataFrame(rows, "p int, seq int, game string, points int")
    got = [tuple(r) for r in rollup_summary(df, ["p"], "seq", "game", ["points"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "Expand" in rollup_summary(df, ["p"], "seq", "game", ["points"])._jdf.queryExecution().executedPlan().toString()
