"""Benchmark run logs: one row per run, summed up per query."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.functions.columns import null_safe_join, quote

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType(), False),
        T.StructField("query_type", T.StringType(), False),
        T.StructField("run_id", T.LongType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("seconds", T.DoubleType(), True),
        T.StructField("succeeded", T.BooleanType(), False),
    ]
)

# Header and types of the published run statistics, and how their
# result folders are named.
RUN_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("query-id", T.StringType()),
        T.StructField("query-type", T.StringType()),
        T.StructField("num-runs", T.IntegerType()),
        T.StructField("time-avg (s)", T.FloatType()),
        T.StructField("time-min (s)", T.FloatType()),
        T.StructField("time-max (s)", T.FloatType()),
        T.StructField("std-dev (s)", T.FloatType()),
    ]
)
RUN_SUMMARY_PREFIX = "evaluation_"


def run_log(spark: SparkSession, runs: Iterable[Mapping]) -> DataFrame:
    """Runs measured on the driver as a frame with the fixed log schema."""
    return spark.createDataFrame([dict(r) for r in runs], RUN_LOG_SCHEMA)


def append_runs(log: DataFrame, path: str) -> None:
    """Add runs to a Parquet log, which is best kept apart from the results it times."""
    log.write.mode("append").parquet(path)


def run_summary(log: DataFrame, *, digits: int = 4) -> DataFrame:
    """Number of runs and mean, min, max and sample deviation of the times per query.

    Only runs that succeeded count, and the first of them is left out as warm-up
    when there are others. The deviation of a single run is null. The warm-up is
    found by an aggregate and taken out by a join, so that no task has to sort all
    the runs of a query.
    """
    keys = ["query_id", "query_type"]
    # Start and run number as one number: unlike a pair, it can be aggregated by
    # hash, without sorting the runs of each task first.
    micros = F.unix_micros(F.col("started_at").cast("timestamp")).cast("decimal(18,0)")
    order = (micros * F.lit(Decimal(10**19)) + F.col("run_id")).cast("decimal(38,0)")
    done = log.where("succeeded").withColumn("_order", order)
    warm_up = done.groupBy(*keys).agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_runs"))
    is_warm_up = (F.col("_order") == F.col("_first")) & (F.col("_runs") > 1)
    kept = null_safe_join(done, warm_up, keys).where(~is_warm_up).select(*keys, "seconds")
    return kept.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("num_runs"),
        F.round(F.avg("seconds"), digits).alias("time_avg"),
        F.round(F.min("seconds"), digits).alias("time_min"),
        F.round(F.max("seconds"), digits).alias("time_max"),
        F.round(F.stddev_samp("seconds"), digits).alias("std_dev"),
    )


def published_summary(summary: DataFrame) -> DataFrame:
    """``run_summary`` under the published header and types."""
    return summary.select(
        *(
            F.col(c).cast(field.dataType).alias(field.name)
            for c, field in zip(summary.columns, RUN_SUMMARY_SCHEMA, strict=True)
        )
    )


def consolidate_runs(lines: DataFrame) -> DataFrame:
    """One table out of every collected run-statistics file (see ``collect_results``).

    A file counts when its result name starts with ``evaluation_`` and its first
    line is exactly the published header; empty files and other headers are left
    out. The check is one small aggregate per file.
    """
    lines = lines.where(F.col("result").startswith(RUN_SUMMARY_PREFIX))
    header = ",".join(RUN_SUMMARY_SCHEMA.names)
    ddl = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in RUN_SUMMARY_SCHEMA)
    heads = lines.groupBy("part").agg(
        F.min_by("line", "position").alias("_head"), F.min("position").alias("_top")
    )
    fitting = heads.where(F.col("_head") == header).drop("_head")
    rows = (
        lines.join(fitting, "part")
        .where((F.col("position") > F.col("_top")) & (F.trim("line") != ""))
        .select(F.from_csv("line", ddl, {"mode": "FAILFAST"}).alias("_row"))
    )
    return rows.select("_row.*")
