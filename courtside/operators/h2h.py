"""Head-to-head history of two entities.

Each side lists its own games per season, most recent first.  The reference
pairs the two lists by position (a zip, cut at the shorter list) and keeps
the 5 most recent pairs, latest season first.

Only the first ``n`` positions of each season can reach the result, so the
per-(side, season) numbering is a ``row_number() <= n`` window limit: Spark
applies it on the map side before the shuffle, and a side with a huge season
ships at most ``n`` rows per task.  The zip is then a conditional aggregate
on ``(season, position)``: both sides come from one scan, and a position is
kept only when both sides have a game there (the cut at the shorter list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.cells import score_label, season_label, winner
from courtside.operators.lastn import last_n
from courtside.operators.ranking import top_k


def head_to_head(games: DataFrame, side_col: str, season_col: str, order_by: list[Column],
                 points_col: str, label_col: str, side1, side2, name1: str, name2: str,
                 n: int = 5, min_season: int | None = None,
                 max_season: int | None = None) -> DataFrame:
    """Last ``n`` meetings of ``side1`` and ``side2`` by positional zip.

    ``games`` holds one row per (side, game) with a season, a recency order,
    the side's points and a label.  ``min_season``/``max_season`` bound the
    backward season scan (A6); both are optional.
    """
    g = games.where(F.col(side_col).isin(side1, side2))
    if min_season is not None:
        g = g.where(F.col(season_col) >= min_season)
    if max_season is not None:
        g = g.where(F.col(season_col) <= max_season)
    g = last_n(g, [side_col, season_col], order_by, n, rn_col="pos")
    is1 = F.col(side_col) == side1
    is2 = F.col(side_col) == side2
    zipped = (g.groupBy(season_col, "pos")
               .agg(F.max(F.when(is1, F.col(label_col))).alias("matchup"),
                    F.max(F.when(is1, F.col(points_col))).alias("pts1"),
                    F.max(F.when(is2, F.col(points_col))).alias("pts2"),
                    F.count_if(is1).alias("n1"), F.count_if(is2).alias("n2"))
               .where((F.col("n1") > 0) & (F.col("n2") > 0)))
    out = zipped.select(
        F.col(season_col).alias("season"),
        season_label(F.col(season_col)).alias("season_label"),
        "pos", "matchup", "pts1", "pts2",
        winner(F.lit(name1), "pts1", F.lit(name2), "pts2").alias("winner"),
        score_label(F.lit(name1), "pts1", F.lit(name2), "pts2").alias("score"))
    return top_k(out, n, [F.col("season").desc(), F.col("pos").asc()], rank_col="rank")


def head_to_head_by_game(games: DataFrame, side_col: str, game_col: str, season_col: str,
                         recency_col: str, points_col: str, label_col: str,
                         side1, side2, name1: str, name2: str, n: int = 5) -> DataFrame:
    """Last ``n`` meetings paired on a shared game id (D3, key-based variant).

    When both sides' rows carry the game they belong to, pairing by key is
    exact even if the two lists are not in the same order.  Only games both
    sides played are kept, most recent (``recency_col`` descending) first.
    The pairing is one aggregate per game: at most two rows per group.
    """
    g = games.where(F.col(side_col).isin(side1, side2))
    is1 = F.col(side_col) == side1
    is2 = F.col(side_col) == side2
    paired = (g.groupBy(game_col, season_col)
               .agg(F.max(F.when(is1, F.col(label_col))).alias("matchup"),
                    F.max(F.when(is1, F.col(points_col))).alias("pts1"),
                    F.max(F.when(is2, F.col(points_col))).alias("pts2"),
                    F.max(F.col(recency_col)).alias("recency"),
                    F.count_if(is1).alias("n1"), F.count_if(is2).alias("n2"))
               .where((F.col("n1") > 0) & (F.col("n2") > 0)))
    out = paired.select(
        F.col(season_col).alias("season"), season_label(F.col(season_col)).alias("season_label"),
        F.col(game_col).alias("game"), "recency", "matchup", "pts1", "pts2",
        winner(F.lit(name1), "pts1", F.lit(name2), "pts2").alias("winner"),
        score_label(F.lit(name1), "pts1", F.lit(name2), "pts2").alias("score"))
    order = [F.col("season").desc(), F.col("recency").desc(), F.col("game").asc()]
    return top_k(out, n, order, rank_col="rank").drop("recency")


def _labelled(paired: DataFrame, n: int, order_by: list[Column], *shown: str) -> DataFrame:
    """The first ``n`` meetings of every pair in ``order_by`` with their labels; ``paired`` has ``team1, team2, season, pts1, pts2``."""
    ranked = last_n(paired, ["team1", "team2"], order_by, n, rn_col="rank")
    return ranked.select(
        "team1", "team2", "rank", "season", season_label(F.col("season")).alias("season_label"), *shown, "pts1", "pts2",
        winner(F.col("team1"), "pts1", F.col("team2"), "pts2").alias("winner"),
        score_label(F.col("team1"), "pts1", F.col("team2"), "pts2").alias("score"))


def all_pairs_head_to_head(games: DataFrame, side_col: str, opponent_col: str, season_col: str, order_by: list[Column],
                           points_col: str, label_col: str, n: int = 5) -> DataFrame:
    """Last ``n`` meetings of every pair that met, by positional zip.

    ``games`` holds one row per (side, game) that also names the opponent, so
    pairs come from games played and are never enumerated.  Each side's list
    against one opponent is numbered per season with a window limit, which
    runs before the shuffle: a pair with a huge season sends ``n`` rows per
    side and task.  Of the two names the lesser is ``team1``.  A game of a side
    against itself, or with an unknown name, is no meeting.
    """
    low, high = F.least(side_col, opponent_col), F.greatest(side_col, opponent_col)
    g = games.where(F.col(side_col) != F.col(opponent_col)).withColumns({"team1": low, "team2": high})
    g = last_n(g, ["team1", "team2", side_col, season_col], order_by, n, rn_col="pos")
    is1 = F.col(side_col) == F.col("team1")
    zipped = (g.groupBy("team1", "team2", F.col(season_col).alias("season"), "pos")
               .agg(F.max(F.when(is1, F.col(label_col))).alias("matchup"),
                    F.max(F.when(is1, F.col(points_col))).alias("pts1"),
                    F.max(F.when(~is1, F.col(points_col))).alias("pts2"),
                    F.count_if(is1).alias("n1"), F.count_if(~is1).alias("n2"))
               .where((F.col("n1") > 0) & (F.col("n2") > 0)))
    return _labelled(zipped, n, [F.col("season").desc(), F.col("pos").asc()], "pos", "matchup")


def all_pairs_by_game(games: DataFrame, side_col: str, game_col: str, season_col: str, recency_col: str,
                      points_col: str, n: int = 5, partitions: int | None = None) -> DataFrame:
    """Last ``n`` meetings of every pair of sides that share a game id (D3, key-based variant, F3).

    One aggregate per game gathers its sides (a game has few), and its pairs
    come from that row, so the rows are shuffled once by game.  A pair's
    meetings are cut to ``n`` per season, then to ``n``, both before their
    shuffles.  A side counts once per game, with its points added up.

    A task expands its games to all pairs and sorts these for the first cut;
    ``partitions`` (by game, kept as given) bounds the games of a task.
    """
    if partitions:
        games = games.repartition(partitions, game_col)
    sides = games.where(F.col(side_col).isNotNull()).groupBy(game_col, season_col, recency_col, side_col).agg(F.sum(points_col).alias("pts"))
    met = sides.groupBy(F.col(game_col).alias("game"), F.col(season_col).alias("season"), F.col(recency_col).alias("recency")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(side_col).alias("side"), "pts"))).alias("sides"))
    one = met.select("game", "season", "recency", "sides", F.posexplode("sides").alias("at", "a"))
    pairs = one.select("game", "season", "recency", "a", F.explode(F.slice("sides", F.col("at") + 2, F.size("sides"))).alias("b")).select(
        F.col("a.side").alias("team1"), F.col("b.side").alias("team2"), "game", "season", "recency", F.col("a.pts").alias("pts1"), F.col("b.pts").alias("pts2"))
    recent = [F.col("recency").desc(), F.col("game").asc()]
    pairs = last_n(pairs, ["team1", "team2", "season"], recent, n, rn_col="pos")
    return _labelled(pairs, n, [F.col("season").desc(), F.col("pos").asc()], "game", "recency")
