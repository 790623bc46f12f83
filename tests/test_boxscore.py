"""Box-score operators on literal goldens."""

from pyspark.sql import functions as F

from courtside.functions import cells as C
from courtside.operators.h2h import head_to_head
from courtside.operators.lastn import last_n, mean_or_zero, values_list, values_wide, with_summary
from courtside.operators.lookup import first_hit, lookup_id, matchup_status
from courtside.operators.ranking import global_row_number, top_k
from courtside.sources.params import dimension_frame

# Golden player log: game order (most recent first), points, rebounds, assists.
LOG = [(19, 10, 4), (17, 7, 2), (21, 5, 5), (27, 8, 6), (19, 6, 3),
       (7, 6, 4), (19, 2, 1), (17, 7, 3), (19, 5, 4), (13, 4, 2)]


def _cells(pts, reb, ast, n=17):
    cells = ["Game"] + [""] * (n - 1)
    cells[3], cells[15], cells[16] = str(pts), str(reb), str(ast)
    return cells


def _rows(spark, log, extra=()):
    rows = [("p1", i, _cells(*r)) for i, r in enumerate(log)] + list(extra)
    return spark.createDataFrame(rows, "player string, seq int, cells array<string>")


def _averages(spark, raw):
    last10 = last_n(raw, ["player"], [F.col("seq").asc()], 10)
    parsed = last10.where(C.has_cells("cells", 16)).select(
        "player", C.guarded_int(C.cell("cells", 3)).alias("pts"),
        C.guarded_int(C.cell("cells", 15)).alias("reb"),
        C.guarded_int(C.cell("cells", 16)).alias("ast")).dropna()
    players = spark.createDataFrame([("p1",), ("p2",)], "player string")
    out = mean_or_zero(players, parsed, ["player"], {"pts": "pts", "reb": "reb", "ast": "ast"})
    return {r.player: (r.n_rows, round(r.pts, 2), round(r.reb, 2), round(r.ast, 2))
            for r in out.select("player", "n_rows", *[C.half_even(c, 2).alias(c) for c in ("pts", "reb", "ast")]).collect()}


def test_last10_averages_golden(spark):
    res = _averages(spark, _rows(spark, LOG + [(40, 40, 40)]))
    assert res["p1"] == (10, 17.8, 6.0, 3.4)
    assert res["p2"] == (0, 0.0, 0.0, 0.0)  # no rows: zeros, row still present


def test_limit_is_taken_before_the_guarded_cast(spark):
    bad = ("p1", 3, _cells("DNP", 1, 1))
    log = LOG[:3] + LOG[4:] + [(40, 40, 40)]
    rows = [("p1", i if i < 3 else i + 1, _cells(*r)) for i, r in enumerate(log)] + [bad]
    raw = spark.createDataFrame(rows, "player string, seq int, cells array<string>")
    res = _averages(spark, raw)
    # 10 rows taken, the bad one dropped afterwards (not replaced by game 11)
    assert res["p1"][0] == 9
    short = spark.createDataFrame([("p1", 0, ["a", "b"])], "player string, seq int, cells array<string>")
    assert _averages(spark, short)["p1"][0] == 0  # arity guard


def test_summary_row_widens_types(spark):
    detail = spark.createDataFrame([("p1", "g1", 19), ("p1", "g2", 17)], "player string, game string, pts int")
    summary = spark.createDataFrame([("p1", 18.0)], "player string, pts double")
    out = with_summary(detail, summary, "game").orderBy("game").collect()
    assert [r.game for r in out] == ["Averages", "g1", "g2"]
    assert dict(with_summary(detail, summary, "game").dtypes)["pts"] == "double"


FT = [("Chicago Bulls", [86.7, 94.4, 78.6]), ("New Orleans Pelicans", [90.0, 81.8, 86.4]),
      ("Los Angeles Lakers", [82.1, 80.0, 92.9]), ("Sacramento Kings", [76.9, 90.9, 82.6]),
      ("Utah Jazz", [88.9, 81.3, 80.0]), ("Denver Nuggets", [78.3, 68.8, 100.0]),
      ("Dallas Mavericks", [73.3, 80.0, 50.0])]


def test_free_throw_ranking_golden(spark):
    rows = [(t, g, "%s%%" % v) for t, vals in FT for g, v in enumerate(vals)]
    rows += [("Milwaukee Bucks", 0, ""), ("Boston Celtics", 0, "87.5"), ("Boston Celtics", 1, " "),
             ("Boston Celtics", 2, ""), ("Boston Celtics", 3, "10.0")]
    games = spark.createDataFrame(rows, "team string, g int, ft string")
    last3 = last_n(games, ["team"], [F.col("g").asc()], 3)
    vals = last3.select("team", "rn", C.percent_value("ft").alias("v"))
    avg = vals.where(F.col("v").isNotNull()).groupBy("team").agg(F.avg("v").alias("avg"))
    wide = values_wide(vals, ["team"], "v", "rn", 3)
    lists = values_list(vals.where(F.col("v").isNotNull()), ["team"], "v", "rn")
    dim = dimension_frame(spark, [(t, str(i)) for i, (t, _) in enumerate(FT)]
                          + [("Milwaukee Bucks", "m"), ("Boston Celtics", "b")])
    s = avg.join(wide, "team").join(lists, "team").join(dim, "team")
    order = [F.col("avg").desc(), F.col("dim_order").asc()]
    top = top_k(s, 5, order).select("rank", "team", C.fixed("avg", 2).alias("a")).collect()
    assert [(r.rank, r.team, r.a) for r in top] == [
        (1, "Boston Celtics", "87.50"), (2, "Chicago Bulls", "86.57"),
        (3, "New Orleans Pelicans", "86.07"), (4, "Los Angeles Lakers", "85.00"),
        (5, "Sacramento Kings", "83.47")]
    ranked = {r.team: r.rank for r in global_row_number(s, order, "rank", num_partitions=3).collect()}
    assert "Milwaukee Bucks" not in ranked  # no values: dropped
    assert ranked["Boston Celtics"] == 1 and ranked["Chicago Bulls"] == 2
    assert sorted(ranked.values()) == list(range(1, len(ranked) + 1))
    boston = s.where("team = 'Boston Celtics'").first()
    assert (boston.g1, boston.g2, boston.g3, boston.values) == (87.5, None, None, [87.5])


def test_head_to_head_zip_golden(spark):
    # (team, season, order in season, points)
    a = [("LAL", 2024, 1, 114), ("LAL", 2024, 2, 107), ("LAL", 2023, 1, 134), ("LAL", 2023, 2, 107),
         ("LAL", 2023, 3, 116), ("LAL", 2023, 4, 99), ("LAL", 2022, 1, 100)]
    b = [("POR", 2024, 1, 106), ("POR", 2024, 2, 98), ("POR", 2023, 1, 110), ("POR", 2023, 2, 95),
         ("POR", 2023, 3, 110), ("POR", 2022, 1, 100)]
    games = spark.createDataFrame(a + b, "team string, season int, k int, pts int") \
        .withColumn("label", F.concat(F.lit("g"), F.col("season"), F.lit("-"), F.col("k")))
    out = head_to_head(games, "team", "season", [F.col("k").asc()], "pts", "label",
                       "LAL", "POR", "Los Angeles Lakers", "Portland Trail Blazers").orderBy("rank").collect()
    assert [r.score for r in out] == [
        "Los Angeles Lakers 114 - Portland Trail Blazers 106",
        "Los Angeles Lakers 107 - Portland Trail Blazers 98",
        "Los Angeles Lakers 134 - Portland Trail Blazers 110",
        "Los Angeles Lakers 107 - Portland Trail Blazers 95",
        "Los Angeles Lakers 116 - Portland Trail Blazers 110"]
    assert [r.season_label for r in out] == ["2024-25"] * 2 + ["2023-24"] * 3
    assert {r.winner for r in out} == {"Los Angeles Lakers"}
    # zip cut at the shorter side: LAL's 4th 2023 game has no partner
    both = head_to_head(games, "team", "season", [F.col("k").asc()], "pts", "label",
                        "LAL", "POR", "A", "B", n=10).collect()
    assert len(both) == 6
    tie = [r for r in both if r.season == 2022][0]
    assert tie.winner == "B"  # a tie goes to the second team


def test_cells_rules(spark):
    df = spark.createDataFrame([(" 86.7% ", "12", "x", 1999)], "p string, i string, bad string, y int")
    r = df.select(C.percent_value("p").alias("p"), C.guarded_int("i").alias("i"),
                  C.guarded_int("bad").alias("b"), C.season_label("y").alias("s"),
                  C.half_even(F.lit(1.125), 2).alias("h")).first()
    assert (r.p, r.i, r.b, r.s, r.h) == (86.7, 12, None, "1999-00", 1.12)


def test_lookup_guard_and_first_hit(spark):
    dim = dimension_frame(spark, [("Atlanta Hawks", "1"), ("Boston Celtics", "2")])
    req = spark.createDataFrame([("Atlanta Hawks", "Boston Celtics"), ("Atlanta Hawks", "Atlanta Hawks"),
                                 ("Atlanta Hawks", "Nowhere")], "t1 string, t2 string")
    req = lookup_id(req, "t1", dim, "team", "team_id", "id1")
    req = lookup_id(req, "t2", dim, "team", "team_id", "id2")
    st = {(r.t1, r.t2): r.s for r in req.select("t1", "t2", matchup_status("t1", "t2", "id1", "id2").alias("s")).collect()}
    assert st == {("Atlanta Hawks", "Boston Celtics"): "ok", ("Atlanta Hawks", "Atlanta Hawks"): "same_team",
                  ("Atlanta Hawks", "Nowhere"): "unknown_team"}
    cands = spark.createDataFrame([("lebron", 3, "u3"), ("lebron", 1, "u1"), ("luka", 2, "u2")],
                                  "q string, pos int, url string")
    hits = {r.q: r.url for r in first_hit(cands, ["q"], [F.col("pos").asc()]).collect()}
    assert hits == {"lebron": "u1", "luka": "u2"}


def test_global_row_number_matches_window(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 20)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v int")
    order = [F.col("v").desc(), F.col("k").asc()]
    got = {r.k: r.rank for r in global_row_number(df, order, "rank", num_partitions=7).collect()}
    want = {k: i + 1 for i, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want


def test_head_to_head_by_game_key(spark):
    from courtside.operators.h2h import head_to_head_by_game
    rows = [("LAL", 10, 2024, 5, 114), ("POR", 10, 2024, 5, 106), ("LAL", 9, 2024, 4, 100),
            ("POR", 9, 2024, 4, 100), ("LAL", 8, 2024, 3, 90), ("POR", 7, 2024, 2, 80)]
    games = spark.createDataFrame(rows, "team string, game int, season int, day int, pts int") \
        .withColumn("label", F.concat(F.lit("game "), F.col("game")))
    out = head_to_head_by_game(games, "team", "game", "season", "day", "pts", "label",
                               "LAL", "POR", "A", "B").orderBy("rank").collect()
    assert [(r.game, r.winner) for r in out] == [(10, "A"), (9, "B")]


def test_html_table_rows(spark):
    from courtside.sources.html_table import html_table_rows
    html = ("<table><thead><tr><th>Game</th></tr></thead><tbody>"
            "<tr><td>Jan 02, 2025 - POR @ LAL</td><td>W</td><td>36</td><td><b>19</b></td></tr>"
            "<tr><td>Dec 30, 2024 - POR vs. PHI</td><td>L</td><td>30</td><td>&nbsp;17 </td></tr>"
            "</tbody></table>")
    df = spark.createDataFrame([(1, html), (2, "<p>no table</p>")], "page_id int, html string")
    rows = html_table_rows(df, ["page_id"]).orderBy("page_id", "row_no").collect()
    assert [(r.page_id, r.row_no) for r in rows] == [(1, 0), (1, 1)]
    assert rows[0].cells == ["Jan 02, 2025 - POR @ LAL", "W", "36", "19"]
    assert C.guarded_int(F.lit(rows[1].cells[3])) is not None
    assert spark.range(1).select(C.guarded_int(F.lit(rows[1].cells[3].strip("\xa0 "))).alias("x")).first().x == 17


def test_bounded_season_scan(spark):
    rows = [("A", 2024, 1, 10), ("B", 2024, 1, 9), ("A", 2022, 1, 5), ("B", 2022, 1, 7),
            ("A", 1999, 1, 1), ("B", 1999, 1, 2)]
    games = spark.createDataFrame(rows, "team string, season int, k int, pts int").withColumn("label", F.lit("g"))
    out = head_to_head(games, "team", "season", [F.col("k").asc()], "pts", "label", "A", "B", "A", "B",
                       n=5, min_season=2000, max_season=2024).collect()
    assert sorted(r.season for r in out) == [2022, 2024]


def test_season_partitions_are_pruned(spark):
    import os
    import tempfile
    from courtside.sinks import write_parquet
    out = os.path.join(tempfile.mkdtemp(prefix="courtside-season-"), "games")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet") \
        .select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    write_parquet(orders, out, partition_by=["season"])
    q = spark.read.parquet(out).where(F.col("season") == 1996)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season#" in plan
    assert q.count() == orders.where("season = 1996").count()


def test_rounding_is_that_of_the_binary_value(spark):
    import random
    rnd = random.Random(5)
    values = [2.675, 0.125, 0.285, 1.125, 0.375, -2.675, -0.125, 1.005, 17.8, 0.0, 1e15, 123456.785] + [rnd.randint(0, 10 ** 6) / 1000 for _ in range(500)] \
        + [rnd.uniform(-100, 100) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    rows = df.select("x", C.half_even("x", 2).alias("r"), C.fixed("x", 2).alias("f")).collect()
    assert [r.r for r in rows] == [round(r.x, 2) for r in rows]
    assert [float(r.f) for r in rows] == [float("%.2f" % r.x) for r in rows]
    shown = {r.x: r.f for r in rows}
    assert (shown[2.675], shown[0.125], shown[0.285]) == ("2.67", "0.12", "0.28")


def test_a_game_without_lines_uses_up_its_place(spark, tmp_path):
    from courtside.plans.boxscore import last10_avg_with_summary
    orders = [(k, 1, f"1995-01-{k:02d} 00:00:00") for k in range(1, 13)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string") \
        .withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(k, float(k), "R") for k in range(1, 13) if k != 7]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1,)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    df = last10_avg_with_summary(spark, str(tmp_path))
    rows = df.collect()
    assert sorted(r.points for r in rows if r.game != "Averages") == [3.0, 4.0, 5.0, 6.0, 8.0, 9.0, 10.0, 11.0, 12.0]
    assert [r.points for r in rows if r.game == "Averages"] == [round(68 / 9, 2)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("WindowGroupLimit") if "WindowGroupLimit" in plan else True


def test_lines_meet_games_in_bounded_partitions(spark):
    from courtside.plans.boxscore import last10_avg_with_summary, player_report
    from tests.conftest import SF_SMALL
    plans = [q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString() for q in (last10_avg_with_summary, player_report)]
    assert ["REPARTITION_BY_NUM" in p for p in plans] == [True, False]


def test_games_with_one_label_stay_apart(spark):
    rows = spark.createDataFrame([("p", "g", 10), ("p", "g", 20)], "player string, game string, pts int")
    means = rows.groupBy("player").agg(F.avg("pts").alias("pts"))
    got = sorted((r.game, r.pts) for r in with_summary(rows, means, "game").collect())
    assert got == [("Averages", 15.0), ("g", 10.0), ("g", 20.0)]
