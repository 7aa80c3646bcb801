"""The reports as spark-submit jobs.

    spark-submit metricspark/jobs.py yearly  --zone IT=<parquet> --zone SE=<parquet> --output <dir>
    spark-submit metricspark/jobs.py monthly --zone IT=<parquet> --output <dir> [--sql]
    spark-submit metricspark/jobs.py diurnal --zone IT=<parquet> --zone SE=<parquet> --output <dir> [--sql]
    spark-submit metricspark/jobs.py clusters --points <csv> --output <dir>

``--runs N``, for N above 1, runs the report once to warm up and then N times;
``--run-log`` appends the times to a Parquet log (see ``run_summary``). A report
that fails fails the job.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time
from collections.abc import Callable, Sequence

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from metricspark.operators.runlog import append_runs, run_log  # noqa: E402
from metricspark.plans import reports, sql  # noqa: E402
from metricspark.session import build_session  # noqa: E402
from metricspark.sinks import write_result  # noqa: E402
from metricspark.sources import read_points, read_series  # noqa: E402
from metricspark.spec import ELECTRICITY_HOURLY, ELECTRICITY_YEARLY  # noqa: E402

SERIES_REPORTS = {
    "yearly": reports.yearly_report,
    "monthly": reports.monthly_extremes_report,
    "diurnal": reports.diurnal_report,
}
SQL_REPORTS = {
    "yearly": lambda zones: reports.as_yearly(
        sql.period_stats_sql(zones, ELECTRICITY_HOURLY, ["year"], name="{metric}-{stat}")
    ),
    "monthly": lambda zones: reports.as_monthly(
        sql.ranked_extremes_sql(zones, ELECTRICITY_HOURLY, name="{metric}-avg")
    ),
    "diurnal": lambda zones: reports.as_diurnal(sql.diurnal_quantiles_sql(zones, ELECTRICITY_HOURLY)),
}


def build_report(spark: SparkSession, name: str, *, zones: dict[str, str], points: str | None, as_sql: bool) -> DataFrame:
    if name == "clusters":
        if as_sql or not points:
            raise ValueError("the clusters report takes --points and has no SQL form")
        return reports.cluster_report(read_points(spark, points, ELECTRICITY_YEARLY))
    if not zones:
        raise ValueError(f"the {name} report takes at least one --zone")
    if as_sql:
        return SQL_REPORTS[name]({zone: spark.read.parquet(path) for zone, path in zones.items()})
    return SERIES_REPORTS[name](read_series(spark, zones, ELECTRICITY_HOURLY))


def run(
    spark: SparkSession,
    name: str,
    kind: str,
    output: str,
    make: Callable[[], DataFrame],
    runs: int,
    log: str | None,
    single_file: bool = False,
) -> None:
    """Each run is logged when it ends, a failed one before its error goes on."""
    for i in range(runs + 1 if runs > 1 else 1):
        entry = {"query_id": name, "query_type": kind, "run_id": i, "started_at": dt.datetime.now(), "succeeded": False}
        clock = time.perf_counter()
        try:
            write_result(
                make(),
                output,
                order_by=reports.REPORT_ORDER[name],
                columns=reports.REPORT_COLUMNS[name],
                single_file=single_file,
            )
            entry["succeeded"] = True
        finally:
            if log:
                append_runs(run_log(spark, [entry | {"seconds": time.perf_counter() - clock}]), log)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("report", choices=sorted(reports.REPORT_ORDER))
    parser.add_argument("--zone", action="append", default=[], metavar="NAME=PATH")
    parser.add_argument("--points", metavar="PATH")
    parser.add_argument("--output", required=True)
    parser.add_argument("--sql", action="store_true")
    parser.add_argument("--runs", type=int, default=1)
    parser.add_argument("--run-log")
    parser.add_argument(
        "--single-file", action=argparse.BooleanOptionalAction, help="default: on for reports of fixed size, off for clusters"
    )
    args = parser.parse_args(argv)
    single = args.report != "clusters" if args.single_file is None else args.single_file
    zones = dict(z.split("=", 1) for z in args.zone)
    spark = build_session(f"metricspark-{args.report}")

    def make() -> DataFrame:
        return build_report(spark, args.report, zones=zones, points=args.points, as_sql=args.sql)

    run(spark, args.report, "SQL" if args.sql else "DF", args.output, make, args.runs, args.run_log, single)


if __name__ == "__main__":
    main()
