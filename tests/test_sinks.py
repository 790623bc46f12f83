"""Writers round-trip."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from courtside import sinks


def _tmp():
    return tempfile.mkdtemp(prefix="courtside-sink-")


def test_csv_roundtrip_and_partitioned(spark):
    df = spark.createDataFrame([("Jan 02, 2025 - LAL vs. POR", "A", 114), ("x", "B", 1)],
                               "matchup string, team string, pts int")
    out = _tmp()
    sinks.write_csv(df, os.path.join(out, "h2h"))
    back = spark.read.option("header", True).csv(os.path.join(out, "h2h"))
    assert sorted(r.matchup for r in back.collect()) == sorted(r.matchup for r in df.collect())
    sinks.write_per_entity(df, os.path.join(out, "per"), ["team"])
    dirs = sorted(d for d in os.listdir(os.path.join(out, "per")) if d.startswith("team="))
    assert dirs == ["team=A", "team=B"]


def test_index_export_order_and_report(spark):
    idx = spark.createDataFrame([(2, "b", 0, "3, 10"), (1, "a", 0, "1, 2")],
                                "rank int, word string, block long, document_ids string")
    out = _tmp()
    sinks.export_inverted_index(idx, os.path.join(out, "idx"))
    back = spark.read.option("header", True).csv(os.path.join(out, "idx")).collect()
    assert [(r.Word, r["Document IDs"]) for r in back] == [("a", "1, 2"), ("b", "3, 10")]
    sinks.export_two_section_report(idx, idx.where("rank = 1"), os.path.join(out, "rep"))
    assert spark.read.option("header", True).csv(os.path.join(out, "rep", "top")).count() == 1
    lines = sinks.rank_lines(spark.createDataFrame([("lebron", 0.12345)], "id string, rank double")).first()
    assert lines.line == "lebron : 0.123"
    wide = spark.createDataFrame([(1, "u1", 3, 0)], "page_id int, url string, Player int, Games int")
    sinks.export_term_counts(wide, os.path.join(out, "wc"))
    assert spark.read.option("header", True).csv(os.path.join(out, "wc")).columns == ["URL", "Player", "Games"]


def test_entities_are_replaced_alone(spark):
    path = os.path.join(_tmp(), "per")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "team string, pts int")
    sinks.write_per_entity(rows, path, ["team"])
    sinks.write_per_entity(spark.createDataFrame([("b", 9), ("c", 4)], "team string, pts int"), path, ["team"], keep_others=True)
    back = sinks.read_per_entity(spark, path, "pts int, team string")
    assert sorted((r.team, r.pts) for r in back.collect()) == [("a", 1), ("b", 9), ("c", 4)]
    assert os.path.exists(os.path.join(path, "_SUCCESS"))
    failing = rows.withColumn("pts", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        sinks.write_per_entity(failing, path, ["team"], keep_others=True)
    assert sorted((r.team, r.pts) for r in sinks.read_per_entity(spark, path, "pts int, team string").collect()) == [("a", 1), ("b", 9), ("c", 4)]
    sinks.write_per_entity(rows.where("pts = 1"), path, ["team"])
    assert [(r.team, r.pts) for r in sinks.read_per_entity(spark, path, "pts int, team string").collect()] == [("a", 1)]


def test_file_order_is_kept_over_many_files(spark):
    path = os.path.join(_tmp(), "idx")
    rows = spark.createDataFrame([(k, f"w{k * 7 % 40}", 0, ", ".join(map(str, range(k)))) for k in range(1, 41)], "rank int, word string, block long, document_ids string")
    out = rows.repartitionByRange(6, "rank").sortWithinPartitions("rank").select(F.col("word").alias("Word"), F.col("block").alias("Block"), F.col("document_ids").alias("Document IDs"))
    sinks.write_csv(out, path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 6
    back = sinks.read_in_order(spark, path, "Word string, Block long, `Document IDs` string").orderBy("position").collect()
    assert [(r.position, r.Word) for r in back] == [(k, f"w{k * 7 % 40}") for k in range(1, 41)]


def test_csv_with_another_header_is_refused(spark):
    path = os.path.join(_tmp(), "x")
    sinks.write_csv(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    with pytest.raises(Exception):
        sinks.read_csv(spark, path, "a int, c int").collect()
