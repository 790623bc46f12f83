"""Command line: run a registered query over a table folder and write the result.

    python -m courtside list
    python -m courtside run top15_terms --tables /data/sf1 --out /out/top15 [--format csv|parquet]
    python -m courtside h2h --team1 NATION_1 --team2 NATION_2 --tables /data/sf1 --out /out/h2h
    python -m courtside player --name "Customer#000000001" --tables /data/sf1 --out /out/p1
    python -m courtside ranking-report --k 5 --tables /data/sf1 --out /out/ranking
    python -m courtside term-counts --terms Player Games Points --tables /data/sf1 --out /out/counts

``--master`` is only for local runs; on a cluster, submit with spark-submit
and let the cluster provide the master and ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from courtside import sinks
from courtside.functions.text import html_raw_text
from courtside.operators.tfidf import term_counts_wide
from courtside.plans import registry
from courtside.plans.boxscore import head_to_head_recent5, player_report, ranked_avg_last_n, topk_avg_last_n
from courtside.sources.params import QUERY_TERMS
from courtside.sources.tables import pages


def _session(master: str | None):
    from courtside.session import build_session
    return build_session(master)


def _write(df, out: str, fmt: str, partition_by: list[str] | None = None) -> None:
    if fmt == "parquet":
        sinks.write_parquet(df, out, partition_by=partition_by)
    elif partition_by:
        sinks.write_per_entity(df, out, partition_by)
    else:
        sinks.write_csv(df, out)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="courtside")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run a registered query")
    run.add_argument("query")
    h2h = sub.add_parser("h2h", help="head-to-head of two named teams")
    h2h.add_argument("--team1", required=True)
    h2h.add_argument("--team2", required=True)
    player = sub.add_parser("player", help="last 10 games and averages of one named player")
    player.add_argument("--name", required=True)
    ranking = sub.add_parser("ranking-report", help="all entities ranked, plus the top k (two sections)")
    ranking.add_argument("--k", type=int, default=5)
    counts = sub.add_parser("term-counts", help="per-page counts of query terms (wide, header as written)")
    counts.add_argument("--terms", nargs="+", default=QUERY_TERMS)
    for p in (run, h2h, player, ranking, counts):
        p.add_argument("--tables", required=True, help="folder with <table>.parquet")
        p.add_argument("--out", required=True)
        p.add_argument("--format", choices=("csv", "parquet"), default="csv")
        p.add_argument("--partition-by", nargs="*", default=None)
        p.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in registry.QUERIES:
            print(name)
        return 0
    spark = _session(args.master)
    if args.cmd == "run":
        if args.query not in registry.QUERIES:
            print(f"unknown query {args.query!r}; see `courtside list`", file=sys.stderr)
            return 2
        df = registry.QUERIES[args.query](spark, args.tables)
    elif args.cmd == "player":
        df = player_report(spark, args.tables, args.name)
    elif args.cmd == "ranking-report":
        sinks.export_two_section_report(ranked_avg_last_n(spark, args.tables),
                                        topk_avg_last_n(spark, args.tables, args.k), args.out)
        return 0
    elif args.cmd == "term-counts":
        wide = term_counts_wide(pages(spark, args.tables), ["page_id", "url"],
                                html_raw_text("html"), args.terms)
        sinks.export_term_counts(wide, args.out, terms=args.terms)
        return 0
    else:
        df = head_to_head_recent5(spark, args.tables, args.team1, args.team2)
    _write(df, args.out, args.format, args.partition_by)
    return 0


if __name__ == "__main__":
    sys.exit(main())
