"""Command line: ``python -m endweave run FOLDER OUT [--step S ...] [--from S] [--stop S] [--force]
[--dry-run]``, ``status OUT``, ``show QUERY FOLDER``, ``list``."""

from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="endweave", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="write the tables of steps and of those they need")
    run.add_argument("folder")
    run.add_argument("out")
    run.add_argument("--step", action="append")
    run.add_argument("--from", dest="first", help="leave out the steps before this one")
    run.add_argument("--stop", dest="last", help="leave out the steps behind this one")
    run.add_argument("--force", action="store_true")
    run.add_argument("--dry-run", action="store_true")
    status = sub.add_parser("status", help="print what is written of each step")
    status.add_argument("out")
    show = sub.add_parser("show", help="print the first rows of a query")
    show.add_argument("query")
    show.add_argument("folder")
    sub.add_parser("list", help="print the names of all queries")
    return p


def main(args: list[str] | None = None) -> int:
    chosen = parser().parse_args(args)
    from endweave.plans import registry, workflow

    if chosen.command == "list":
        print("\n".join(sorted(registry.queries())))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("endweave").getOrCreate()
    if chosen.command == "show":
        registry.queries()[chosen.query](spark, chosen.folder).show(20, truncate=False)
        return 0
    if chosen.command == "status":
        lines = workflow.status(spark, chosen.out)
    else:
        lines = workflow.run(spark, chosen.folder, chosen.out, chosen.step or list(workflow.STEPS), chosen.force, chosen.dry_run, chosen.first, chosen.last)
    for line in lines:
        print(*line, sep="\t")
    return 0


if __name__ == "__main__":
    sys.exit(main())
