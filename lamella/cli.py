"""Command line: ``python -m lamella.cli list`` and ``python -m lamella.cli run NAME --data DIR --out DIR``."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable, Sequence

#: Modules of queries, in the order of the README.
PLANS = ("change", "nested", "quality", "reference_check", "hierarchy", "analytics", "spec", "family", "ast", "stream")


def known() -> dict[str, Callable]:
    out: dict[str, Callable] = {}
    for p in PLANS:
        out |= importlib.import_module(f"lamella.plans.{p}_queries").QUERIES
    return out


def parse(argv: Sequence[str]) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="lamella", allow_abbrev=False)
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("list", allow_abbrev=False)
    run = sub.add_parser("run", allow_abbrev=False)
    run.add_argument("name")
    run.add_argument("--data", required=True, help="folder of the tables")
    run.add_argument("--out", required=True, help="folder of the result")
    run.add_argument("--format", default="parquet", choices=("parquet", "json", "csv", "orc"))
    return top.parse_args(argv)


def main(argv: Sequence[str]) -> int:
    args = parse(argv)
    queries = known()
    if args.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if args.name not in queries:
        print(f"no query {args.name!r}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    queries[args.name](spark, args.data).write.mode("overwrite").format(args.format).save(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
