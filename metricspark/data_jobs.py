"""The data path as spark-submit jobs.

    spark-submit metricspark/data_jobs.py convert --source <csv>... --target <dir> --columns a,b,c --zone-col zone
                 [--select name=expression]... [--where expression] [--sort-by ts]
    spark-submit metricspark/data_jobs.py land --source <dir> --target <dir> --marks <dir> --columns a,b,c
                 [--zone-col zone] [--merge-above N] [--interval "5 minutes"] [--select ...] [--where ...]
    spark-submit metricspark/data_jobs.py judge --source <csv>... --target <dir> --columns a,b,c --rule name=expression...
    spark-submit metricspark/data_jobs.py export --source <dir> --target <dir>
    spark-submit metricspark/data_jobs.py consolidate --source <dir> --target <csv dir>

``convert`` writes CSV as Parquet by zone, ``land`` does so for files that keep arriving, ``judge``
keeps the records that follow all rules apart from the others, ``export`` collects all result
files under a folder and writes each as text, ``consolidate`` makes one table of all run
statistics under it. A job that fails ends with its error.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from metricspark.operators.runlog import RUN_SUMMARY_PREFIX, consolidate_runs  # noqa: E402
from metricspark.session import build_session  # noqa: E402
from metricspark.sinks import collect_results, export_results, write_result  # noqa: E402
from metricspark.sources import csv_to_parquet, split_records  # noqa: E402
from metricspark.sources.ingest import read_text_csv  # noqa: E402
from metricspark.streaming import land_csv  # noqa: E402


def _named(pairs: Sequence[str]) -> dict[str, str] | None:
    return dict(p.split("=", 1) for p in pairs) or None


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    csv_to_parquet(
        spark, args.source, args.target, args.columns, zone_col=args.zone_col, select=_named(args.select), where=args.where, sort_by=args.sort_by
    )


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    (source,) = args.source
    land_csv(
        spark, source, args.target, args.marks, args.columns, select=_named(args.select), where=args.where,
        partition_by=args.zone_col, merge_above=args.merge_above, interval=args.interval,
    ).awaitTermination()


def judge(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_text_csv(spark, args.source, args.columns)
    for name, rows in split_records(raw, args.target, rules=_named(args.rule) or {}, select=_named(args.select)).items():
        print(f"{name}: {rows}")


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run statistics are left out: ``consolidate`` takes those."""
    (source,) = args.source
    lines = collect_results(spark, source)
    export_results(lines.where(~F.col("result").startswith(RUN_SUMMARY_PREFIX)), args.target)


def consolidate(spark: SparkSession, args: argparse.Namespace) -> None:
    (source,) = args.source
    write_result(consolidate_runs(collect_results(spark, source)), args.target, single_file=True)


JOBS = {f.__name__: f for f in (convert, land, judge, export, consolidate)}
NEEDS = {"convert": ("columns", "zone_col"), "land": ("columns", "marks"), "judge": ("columns", "rule")}


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--source", action="append", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--columns", type=lambda text: text.split(","), help="the files' header")
    parser.add_argument("--zone-col")
    parser.add_argument("--sort-by", action="append", default=[])
    parser.add_argument("--select", action="append", default=[], metavar="NAME=SQL")
    parser.add_argument("--rule", action="append", default=[], metavar="NAME=SQL")
    parser.add_argument("--where", metavar="SQL")
    parser.add_argument("--marks", help="checkpoint of what has landed, on shared storage")
    parser.add_argument("--merge-above", type=int)
    parser.add_argument("--interval")
    args = parser.parse_args(argv)
    for option in NEEDS.get(args.job, ()):
        if not getattr(args, option):
            parser.error(f"{args.job} needs --{option.replace('_', '-')}")
    JOBS[args.job](build_session(f"metricspark-{args.job}"), args)


if __name__ == "__main__":
    main()
