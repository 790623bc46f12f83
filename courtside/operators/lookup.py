"""Dimension lookups, request guards and first-hit search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_id(requests: DataFrame, name_col: str, dim: DataFrame, dim_name: str,
              dim_id: str, out_col: str) -> DataFrame:
    """Left-join ``dim`` on name; ``out_col`` is null for unknown names.

    Whether the dimension is small enough to broadcast is left to
    ``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution.
    """
    d = dim.select(F.col(dim_name).alias("__cs_name"), F.col(dim_id).alias(out_col))
    return requests.join(d, F.col(name_col) == F.col("__cs_name"), "left").drop("__cs_name")


def matchup_status(team1: Column | str, team2: Column | str,
                   id1: Column | str, id2: Column | str) -> Column:
    """Request guard (C27): same team, unknown team, or ok."""
    t1, t2, i1, i2 = (F.col(c) if isinstance(c, str) else c for c in (team1, team2, id1, id2))
    return (F.when(t1 == t2, F.lit("same_team"))
             .when(i1.isNull() | i2.isNull(), F.lit("unknown_team"))
             .otherwise(F.lit("ok")))


def first_hit(candidates: DataFrame, key_cols: list[str], order_by: list[Column]) -> DataFrame:
    """One candidate per key: the first in ``order_by``.

    Written as ``row_number() <= 1`` so Spark applies the per-key limit on
    the map side before the shuffle (WindowGroupLimit); a key with a huge
    number of candidates ships one row per task.
    """
    w = Window.partitionBy(*key_cols).orderBy(*order_by)
    return (candidates.withColumn("__cs_rn", F.row_number().over(w))
                      .where(F.col("__cs_rn") <= 1).drop("__cs_rn"))


def name_tokens(name: Column | str) -> Column:
    """Distinct lower-case words of a name; anything but letters and digits separates them."""
    c = F.col(name) if isinstance(name, str) else name
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def name_index(entities: DataFrame, key: Column, name: Column | str) -> DataFrame:
    """``token, key``: the token postings of the entities' names; entities without a key are left out."""
    return entities.select(key.alias("key"), F.explode(name_tokens(name)).alias("token")).where(F.col("key").isNotNull())


def search_names(requests: DataFrame, index: DataFrame, names: list[str]) -> DataFrame:
    """Entities whose name holds every word of a request; the first hit wins.

    ``requests`` are rows of ``names`` columns (first name, last name, ...),
    all searched at once; equal requests once.  The word with the fewest
    entities names the candidates and the other words only check them, on
    (key, word), so a word that every entity has costs no more than the
    candidates of the rarer one.

    Result: ``names, n_hits, key, status``; ``key`` is the least one of the
    hits, null when ``status`` is ``unknown`` (some word is unknown, no entity
    has all, or the request has no words); ``ambiguous`` means several hits.
    """
    asked = requests.select(*names).distinct()
    words = asked.withColumn("words", name_tokens(F.concat_ws(" ", *names)))
    sizes = index.groupBy("token").agg(F.count(F.lit(1)).alias("entities"))
    each = words.select(*names, "words", F.explode("words").alias("token")).join(sizes, "token", "left")
    rarest = each.groupBy(*names, "words").agg(F.min(F.struct(F.coalesce("entities", F.lit(0)).alias("entities"), "token")).alias("r")).where("r.entities > 0")
    found = rarest.select(*names, F.col("r.token").alias("token"), F.array_remove("words", F.col("r.token")).alias("others")).join(index, "token")
    checked = found.select(*names, "key", F.size("others").alias("many"), F.explode_outer("others").alias("token"))
    held = index.withColumn("has", F.lit(1))
    hits = checked.join(held, ["key", "token"], "left").groupBy(*names, "key", "many").agg(F.count("has").alias("n")).where("n = many")
    best = hits.groupBy(*[F.col(c).alias(f"__cs_{c}") for c in names]).agg(F.count(F.lit(1)).alias("hits"), F.min("key").alias("key"))
    n = F.coalesce("hits", F.lit(0))
    # Names can be null, and a null name is a request of its own.
    on = [F.col(c).eqNullSafe(F.col(f"__cs_{c}")) for c in names]
    return asked.join(best, on, "left").select(
        *names, n.alias("n_hits"), "key",
        F.when(n == 0, F.lit("unknown")).when(n == 1, F.lit("found")).otherwise(F.lit("ambiguous")).alias("status"))
