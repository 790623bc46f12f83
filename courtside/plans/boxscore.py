"""Box-score questions over the driver tables.

Mapping: an entity (player / team) is a customer or a nation, a game is an
order, recency is ``(o_orderdate desc, o_orderkey desc)`` and a season is the
order year.  Each function takes ``(spark, sf_dir)`` and returns a lazy
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions import cells as C
from courtside.operators.h2h import all_pairs_by_game, all_pairs_head_to_head, head_to_head
from courtside.operators.lastn import last_n, rollup_summary, values_wide, with_summary
from courtside.operators.lookup import first_hit, lookup_id, matchup_status, name_index, search_names
from courtside.operators.ranking import global_row_number, top_k
from courtside.plans.graph import trade_pairs
from courtside.sources.html_table import html_table_rows
from courtside.sources.tables import row_bounded, table

def recent_first() -> list:
    """Recency order of games: latest date first, then the higher order key."""
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]

# Parameters of the head-to-head question (two team names).
H2H_TEAM1 = "NATION_1"
H2H_TEAM2 = "NATION_2"
H2H_SEASONS = (1994, 1997)
# Name asked for in the one-player question.
PLAYER_NAME = "Customer#000000007"


def _last3_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: last 3 order prices (g1..g3) and their mean."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    last3 = last_n(orders, ["o_custkey"], recent_first(), 3)
    per_cust = last3.groupBy("o_custkey").agg(
        *[F.max(F.when(F.col("rn") == i, F.col("o_totalprice"))).alias(f"g{i}") for i in (1, 2, 3)],
        F.avg("o_totalprice").alias("avg_price"),
        F.count("o_totalprice").alias("n_games"))
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return per_cust.join(cust, per_cust.o_custkey == cust.c_custkey).drop("o_custkey")


def _rounded(ranked: DataFrame) -> DataFrame:
    """The ranking was by the full mean; the mean shown has 6 decimals."""
    return ranked.select("rank", "c_custkey", "c_name", "g1", "g2", "g3", F.round("avg_price", 6).alias("avg_price"), "n_games")


def topk_avg_last_n(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Top-k customers by mean price of their last 3 orders, ranked 1..k."""
    s = _last3_summary(spark, sf_dir)
    return _rounded(top_k(s, k, [F.col("avg_price").desc(), F.col("c_custkey").asc()], "rank"))


def ranked_avg_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in descending mean order with their position."""
    s = _last3_summary(spark, sf_dir)
    return _rounded(global_row_number(s, [F.col("avg_price").desc(), F.col("c_custkey").asc()], "rank"))


def last_n_values_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last 3 order prices per customer as columns; ragged rows get nulls."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    last3 = last_n(orders, ["o_custkey"], recent_first(), 3)
    return values_wide(last3, ["o_custkey"], "o_totalprice", "rn", 3)


def _last_box_scores(spark: SparkSession, sf_dir: str, n: int, cust_key=None) -> DataFrame:
    """Box scores (points, rebounds, assists) of each player's last ``n`` games, ``seq`` from 1.

    The limit is taken on the games; only their lines are read on, reduced to
    one row per game before they join back.  A game without lines has no box
    score: it uses up its place and shows no row.  ``cust_key`` (a Column,
    e.g. a scalar subquery) restricts the games to one player first.  For all
    players, lines and games meet in partitions of a bounded number of lines.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_returnflag")
    # A game without a player key belongs to no one.
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate") \
        .where(F.col("o_custkey").isNotNull())
    if cust_key is not None:
        orders = orders.where(F.col("o_custkey") == cust_key)
    games = last_n(orders, ["o_custkey"], recent_first(), n, rn_col="seq")
    if cust_key is None:
        parts = row_bounded(li)
        li, games = li.repartition(parts, "l_orderkey"), games.repartition(parts, "o_orderkey")
    per_order = li.join(games.select("o_orderkey"), li.l_orderkey == games.o_orderkey, "left_semi") \
        .groupBy("l_orderkey").agg(
            F.sum("l_quantity").cast("int").alias("points"),
            F.count(F.lit(1)).cast("int").alias("rebounds"),
            F.count_if(F.col("l_returnflag") == "R").cast("int").alias("assists"))
    return games.join(per_order, games.o_orderkey == per_order.l_orderkey).drop("l_orderkey")


def last10_avg_with_summary(spark: SparkSession, sf_dir: str, cust_key=None) -> DataFrame:
    """Per customer: last 10 games, then an "Averages" row.

    Averages are rounded half-to-even to 2 places and are 0 for a customer
    without games (the summary row is always there).
    """
    last10 = _last_box_scores(spark, sf_dir, 10, cust_key)
    detail = last10.select(
        F.col("o_custkey").alias("c_custkey"), "seq",
        F.concat(F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(" - #"),
                 F.col("o_orderkey").cast("string")).alias("game"),
        "points", "rebounds", "assists")
    means = last10.groupBy("o_custkey").agg(
        *[F.avg(c).alias(c) for c in ("points", "rebounds", "assists")])
    cust = table(spark, sf_dir, "customer", "c_custkey")
    if cust_key is not None:
        cust = cust.where(F.col("c_custkey") == cust_key)
    summary = cust.join(means, cust.c_custkey == means.o_custkey, "left").select(
        "c_custkey", F.lit(None).cast("int").alias("seq"),
        *[C.half_even(F.coalesce(F.col(c), F.lit(0.0)), 2).alias(c)
          for c in ("points", "rebounds", "assists")])
    return with_summary(detail, summary, "game")


def last10_rollup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``last10_avg_with_summary`` from one aggregate over grouping sets."""
    last10 = _last_box_scores(spark, sf_dir, 10)
    game = F.concat(F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(" - #"), F.col("o_orderkey").cast("string"))
    cust = table(spark, sf_dir, "customer", "c_custkey")
    rows = cust.join(last10, cust.c_custkey == last10.o_custkey, "left").select("c_custkey", "seq", game.alias("game"), "points", "rebounds", "assists")
    return rollup_summary(rows, ["c_custkey"], "seq", "game", ["points", "rebounds", "assists"])


def player_report(spark: SparkSession, sf_dir: str, name: str = PLAYER_NAME) -> DataFrame:
    """Last 10 games and an "Averages" row for one player found by name.

    The first customer whose name matches (lowest key) wins, as a search
    returning several hits takes the first; an unknown name gives no rows.
    The key is a scalar subquery, so orders and lines are cut to that one
    player before the window runs.
    """
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name").where(F.col("c_name") == name)
    key = cust.select(F.min("c_custkey")).scalar()
    return last10_avg_with_summary(spark, sf_dir, cust_key=key)


def _nation_games(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Orders as games of the customer's nation (the 'team'), for the named teams.

    The names are resolved through the nation dimension (D1); the filter on
    the 25-row dimension reaches the customer scan through the join.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name").where(F.col("n_name").isin(*names))
    teams = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    return orders.join(teams, orders.o_custkey == teams.c_custkey).select(
        F.col("n_name").alias("team"),
        F.year("o_orderdate").alias("season"),
        "o_orderdate", "o_orderkey",
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("points"),
        F.date_format("o_orderdate", "MMM dd, yyyy").alias("game_date"))


def head_to_head_recent5(spark: SparkSession, sf_dir: str,
                         team1: str = H2H_TEAM1, team2: str = H2H_TEAM2) -> DataFrame:
    """Five most recent meetings of two nations, looked up by name.

    The same name twice gives an empty result (C27); an unknown name has no
    games, so the zip is empty too.
    """
    games = _nation_games(spark, sf_dir, [team1, team2]).withColumn(
        "game_date", F.concat("game_date", F.lit(f" - {team1} vs. {team2}")))
    if team1 == team2:
        games = games.where(F.lit(False))
    return head_to_head(games, "team", "season", recent_first(), "points", "game_date",
                        team1, team2, team1, team2)


def _opponent_games(spark: SparkSession, sf_dir: str, team1: str, team2: str, low: int, high: int) -> DataFrame:
    """Games of either nation against the other: one row per (order, supplier nation).

    The customer's nation is the team, the supplier's nation its opponent, the
    order year the season; the season bounds reach the scan as order dates.
    """
    pair = F.col("n_name").isin(team1, team2)
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name").where(pair)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").where(
        F.col("o_orderdate").between(F.lit(f"{low:04d}-01-01 00:00:00").cast("timestamp_ntz"), F.lit(f"{high:04d}-12-31 23:59:59.999999").cast("timestamp_ntz")))
    teams = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("team"))
    opponents = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", F.col("n_name").alias("opponent"))
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice")
    games = orders.join(teams, F.col("o_custkey") == F.col("c_custkey"))
    met = li.join(opponents, F.col("l_suppkey") == F.col("s_suppkey")).join(games, F.col("l_orderkey") == F.col("o_orderkey")) \
        .where(F.col("team") != F.col("opponent"))
    return met.groupBy("team", "opponent", "o_orderkey", "o_orderdate").agg(F.sum("l_extendedprice").alias("total")).select(
        "team", "opponent", F.year("o_orderdate").alias("season"), "o_orderdate", "o_orderkey",
        F.floor(F.col("total") / 1000).cast("long").alias("points"),
        F.concat(F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(f" - {team1} vs. {team2}")).alias("game_date"))


def head_to_head_opponent(spark: SparkSession, sf_dir: str, team1: str = H2H_TEAM1, team2: str = H2H_TEAM2,
                          low: int = H2H_SEASONS[0], high: int = H2H_SEASONS[1]) -> DataFrame:
    """Five most recent meetings of two nations within season bounds.

    A meeting is an order of one nation's customer with lines of the other
    nation's suppliers; the two sides' lists are zipped per season.
    """
    games = _opponent_games(spark, sf_dir, team1, team2, low, high)
    return head_to_head(games, "team", "season", recent_first(), "points", "game_date",
                        team1, team2, team1, team2, min_season=low, max_season=high)


def _trade_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, o_orderdate, team, opponent, points`` of all orders: customer's nation against each supplier nation in it."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    names = {c: nation.select(F.col("n_nationkey").alias(f"{c}_key"), F.col("n_name").alias(c)) for c in ("team", "opponent")}
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    per_order = li.join(supp, li.l_suppkey == supp.s_suppkey).groupBy("l_orderkey", "s_nationkey").agg(F.sum("l_extendedprice").alias("total"))
    games = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    games = games.join(names["team"], F.col("c_nationkey") == F.col("team_key")).join(names["opponent"], F.col("s_nationkey") == F.col("opponent_key"))
    return games.select("o_orderkey", "o_orderdate", "team", "opponent", F.floor(F.col("total") / 1000).cast("long").alias("points"))


def all_pairs_h2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five most recent meetings of every two nations that met, each side's lists zipped per season."""
    games = _trade_games(spark, sf_dir).withColumns({
        "season": F.year("o_orderdate"),
        "game_date": F.concat(F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(" - "), F.least("team", "opponent"), F.lit(" vs. "), F.greatest("team", "opponent"))})
    return all_pairs_head_to_head(games, "team", "opponent", "season", recent_first(), "points", "game_date")


def all_pairs_h2h_by_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five most recent orders that two nations both supplied, for every two nations (D3 by game id, F3)."""
    games = _trade_games(spark, sf_dir).withColumn("season", F.year("o_orderdate"))
    parts = row_bounded(table(spark, sf_dir, "lineitem", "l_orderkey"))
    met = all_pairs_by_game(games, "opponent", "o_orderkey", "season", "o_orderdate", "points", partitions=parts)
    return met.withColumn("game_date", F.date_format("recency", "MMM dd, yyyy")).drop("recency")


def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and parts searched by first and last name, all requests at once.

    Asked for are each ordering customer by its number (``customer`` is a word
    of every customer's name), each part's words in either order, the first
    word with a part type and the brand with the last word (mostly unknown).
    """
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    index = name_index(cust.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
                       .union(part.select(F.lit("part"), "p_partkey", "p_name")), F.struct("kind", "id"), "name")
    orders = table(spark, sf_dir, "orders", "o_custkey")
    words = F.split("p_name", " ")
    asked = orders.select(F.lit("Customer").alias("first_name"), F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("last_name")).union(
        part.select(F.explode(F.array(*[F.struct(a.alias("first_name"), b.alias("last_name")) for a, b in (
            (F.get(words, 0), F.get(words, 1)), (F.get(words, 1), F.get(words, 0)), (F.get(words, 0), F.col("p_type")), (F.col("p_brand"), F.get(words, 1)))])).alias("x"))
        .select("x.first_name", "x.last_name"))
    found = search_names(asked, index, ["first_name", "last_name"])
    return found.select("first_name", "last_name", "n_hits", F.col("key.kind").alias("kind"), F.col("key.id").alias("id"), "status")


def matchup_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade match-ups requested by *name*, resolved and guarded.

    A request names the customer's nation, and the supplier's nation or its
    region (of several nations one request); a region is no known team.  Ids
    are looked up in the nation dimension by name.
    """
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    trades = trade_pairs(spark, sf_dir).select("src", "dst", "n_lines")
    customers = nation.select(F.col("n_nationkey").alias("dst"), F.col("n_name").alias("team1"))
    suppliers = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("src"), F.explode(F.array("n_name", "r_name")).alias("team2"))
    req = trades.join(customers, "dst").join(suppliers, "src").groupBy("team1", "team2").agg(F.sum("n_lines").alias("n_trades"))
    req = lookup_id(req, "team1", nation, "n_name", "n_nationkey", "id1")
    req = lookup_id(req, "team2", nation, "n_name", "n_nationkey", "id2")
    return req.withColumn("status", matchup_status("team1", "team2", "id1", "id2"))


def cells_guarded_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as box-score cells, parsed with guards.

    Cell layout: 0 date, 1 type, 2 user, 3 points (``'DNP'`` for an error
    event), 4 percent (blank for a view event); every seventh event is cut
    short after its third cell.  Per user the last 10 events are taken first;
    short rows and rows whose points do not parse are dropped afterwards,
    blank percents are skipped.
    """
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    rendered = ev.select(
        "user_id", "ts", "event_id",
        F.array(F.date_format("ts", "yyyy-MM-dd"), F.col("event_type"),
                F.col("user_id").cast("string"),
                F.when(F.col("event_type") == "error", F.lit("DNP"))
                 .otherwise(F.floor("value").cast("long").cast("string")),
                F.when(F.col("event_type") == "view", F.lit(" "))
                 .otherwise(F.concat(k, F.lit("%")))).alias("cells")) \
        .withColumn("cells", F.when(F.col("event_id") % 7 == 0, F.slice("cells", 1, 3)).otherwise(F.col("cells")))
    last10 = last_n(rendered, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 10)
    parsed = last10.where(C.has_cells("cells", 3)).select(
        "user_id",
        C.guarded_int(C.cell("cells", 3)).alias("points"),
        C.percent_value(C.cell("cells", 4)).alias("pct"))
    return parsed.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("points").alias("n_valid"),
        F.round(F.coalesce(F.avg("points"), F.lit(0.0)), 6).alias("avg_points"),
        F.count("pct").alias("n_pct"),
        F.round(F.avg("pct"), 6).alias("avg_pct"))


def order_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-score tables as HTML, one per order, read back into rows.

    A line is ``<tr>`` of line number, flag, quantity and discount percent; a
    returned line has ``-`` for its quantity, a line of full tax stops after
    its flag.  Rows short of cells are dropped, quantities parse guarded, line
    numbers strictly.  An order's lines are few, so its page is one small row.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag")

    def td(c):
        return F.concat(F.lit("<td> "), c, F.lit(" </td>"))

    head = F.concat(td(F.col("l_linenumber").cast("string")), td(F.concat(F.lit("<b>"), "l_returnflag", F.lit("</b>"))))
    tail = F.concat(td(F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(F.col("l_quantity").cast("int").cast("string"))),
                    td(F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))))
    row = F.concat(F.lit("<tr>"), head, F.when(F.col("l_tax") > 0.07, F.lit("")).otherwise(tail), F.lit("</tr>"))
    pages = li.select("l_orderkey", F.struct("l_linenumber", row.alias("tr")).alias("r")).groupBy("l_orderkey").agg(
        F.concat(F.lit("<table><thead><tr><th>#</th></tr></thead><tbody>"),
                 F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["tr"]), "\n"), F.lit("</tbody></table>")).alias("html"))
    rows = html_table_rows(pages, ["l_orderkey"]).where(C.has_cells("cells", 3))
    return rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(C.strict_int(C.cell("cells", 0)).cast("long")).alias("line_sum"),
        F.count(C.guarded_int(C.cell("cells", 2))).alias("n_valid"), F.sum(C.guarded_int(C.cell("cells", 2)).cast("long")).alias("quantity"),
        F.round(F.avg(C.percent_value(C.cell("cells", 3))), 6).alias("avg_discount"))


def entity_search_first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each page, the first document in the page's language (D7, C25-like).

    The language is the first path segment of the page URL; "first" is the
    lowest ``doc_id``.  The per-language limit runs before the join, so the
    join sees one candidate per language.
    """
    pg = table(spark, sf_dir, "pages", "page_id", "url")
    docs = table(spark, sf_dir, "documents", "doc_id", "lang")
    hit = first_hit(docs, ["lang"], [F.col("doc_id").asc()])
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1)
    num = F.regexp_extract("url", r"/[a-z]{2}/(\d+)", 1)
    req = pg.select("page_id", lang.alias("lang"), num.alias("url_num"))
    return req.join(hit, "lang", "left").select("page_id", "lang", "url_num", "doc_id")
