"""The command line runs a registered query and writes its result."""

import os
import tempfile

from courtside.cli import main
from tests.conftest import SF_SMALL


def test_cli_run_and_h2h(spark, capsys):
    assert main(["list"]) == 0
    assert "top15_terms" in capsys.readouterr().out
    out = tempfile.mkdtemp(prefix="courtside-cli-")
    assert main(["run", "top15_terms", "--tables", SF_SMALL, "--out", os.path.join(out, "top")]) == 0
    assert spark.read.option("header", True).csv(os.path.join(out, "top")).count() == 15
    assert main(["h2h", "--team1", "NATION_3", "--team2", "NATION_4", "--tables", SF_SMALL,
                 "--out", os.path.join(out, "h2h"), "--format", "parquet"]) == 0
    rows = spark.read.parquet(os.path.join(out, "h2h")).collect()
    assert 0 < len(rows) <= 5 and all("NATION_3" in r.score for r in rows)
    assert main(["run", "nope", "--tables", SF_SMALL, "--out", out]) == 2


def test_player_report(spark):
    from courtside.plans.boxscore import player_report
    name = spark.read.parquet(f"{SF_SMALL}/customer.parquet").orderBy("c_custkey").first().c_name
    rows = player_report(spark, SF_SMALL, name).collect()
    summary = [r for r in rows if r.game == "Averages"]
    assert len(summary) == 1 and 1 <= len(rows) <= 11
    detail = [r for r in rows if r.game != "Averages"]
    if detail:
        assert abs(summary[0].points - round(sum(r.points for r in detail) / len(detail), 2)) < 1e-9
    assert player_report(spark, SF_SMALL, "nobody").count() == 0


def test_cli_reports(spark):
    out = tempfile.mkdtemp(prefix="courtside-cli-")
    assert main(["ranking-report", "--k", "3", "--tables", SF_SMALL, "--out", os.path.join(out, "rank")]) == 0
    top = spark.read.option("header", True).csv(os.path.join(out, "rank", "top"))
    every = spark.read.option("header", True).csv(os.path.join(out, "rank", "all"))
    assert top.count() == 3 and every.count() > 3
    assert main(["term-counts", "--terms", "The", "Of", "--tables", SF_SMALL, "--out", os.path.join(out, "wc")]) == 0
    wc = spark.read.option("header", True).csv(os.path.join(out, "wc"))
    assert wc.columns == ["URL", "The", "Of"] and wc.count() == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
