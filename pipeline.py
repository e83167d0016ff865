"""The whole pipeline as one job: load new files, rebuild layers and marts, check the result.

    spark-submit pipeline.py --landing /landing --raw /lake/bronze_casos \
        --checkpoint /lake/_checkpoints/bronze --database cases --flavour confirmed
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from casemart.operators import run_checks
from casemart.plans.checks import CHECKS, named_as_checked
from casemart.plans.marts import build, mart_names
from casemart.schema import Flavour
from casemart.session import TEXT_TO_SHUFFLE, get_session, size_shuffles
from casemart.sources import file_version
from casemart.streaming import ingest_new_files, rejected_lines
from casemart.streaming.ingest import BATCH_BYTES


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--landing", required=True, help="folder of the delivered CSV files")
    parser.add_argument("--raw", required=True, help="folder of the raw table")
    parser.add_argument("--checkpoint", required=True, help="memory of the loaded files")
    parser.add_argument("--pattern", default="*.csv", help="names of the files to load")
    parser.add_argument("--database", default="default", help="where the tables go")
    parser.add_argument("--flavour", default="confirmed", choices=[f.value for f in Flavour])
    parser.add_argument("--marts", nargs="*", help="marts to build; all by default")
    parser.add_argument("--batch-bytes", type=int, default=BATCH_BYTES, help="text per batch")
    parser.add_argument("--archive", help="folder that loaded files are moved to")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    """Returns the number of failed checks, so that a scheduler sees them."""
    args = parse(argv)
    flavour = Flavour(args.flavour)
    spark = get_session("casemart")
    raw = ingest_new_files(
        spark, args.landing, args.raw, args.checkpoint, args.pattern, args.batch_bytes,
        args.archive,
    )
    # The raw table is compressed columns of the same text that the shuffles move in rows.
    _, stored, _ = file_version(spark, [args.raw])
    size_shuffles(spark, stored * TEXT_TO_SHUFFLE)
    print(f"{rejected_lines(spark, args.raw).count()} lines rejected, kept in {args.raw}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
    names = args.marts if args.marts is not None else mart_names(flavour)
    tables = build(spark, raw, flavour, names, "table", args.database)
    report = run_checks(named_as_checked(tables), CHECKS).collect()  # one row per check
    for row in report:
        state = "ok  " if row.passed else "FAIL"
        print(f"{state} {row.check:8s} {row.table}.{row.column}: {row.violations} violations")
    return sum(not row.passed for row in report)


if __name__ == "__main__":
    sys.exit(min(main(), 125))
