"""Cleaning raw records and converting CSV to Parquet."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.functions.columns import col, quote

KEPT, REJECTED = "kept", "rejected"


def normalise_name(name: str) -> str:
    """Each character outside ``[A-Za-z0-9_]`` becomes one ``_``."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name)


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename every column by ``normalise_name``; two columns may not fall together."""
    names = [normalise_name(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names fall together after normalisation: {clashes}")
    return df.toDF(*names)


def clean(
    df: DataFrame,
    *,
    select: Mapping[str, str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """Normalise names, then keep the rows where ``where`` holds and the columns of ``select``.

    Both are Spark SQL expressions over the normalised names: which records are
    fit to keep is the caller's to say.
    """
    df = normalise_names(df)
    if where is not None:
        df = df.where(where)
    if select is not None:
        df = df.select(*(F.expr(e).alias(name) for name, e in select.items()))
    return df


def split_records(
    df: DataFrame,
    path: str,
    *,
    rules: Mapping[str, str],
    select: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Write the records that keep all ``rules``, and apart from them the others with the reason, in one pass.

    ``rules`` are named Spark SQL conditions over the normalised names; a record is rejected
    for the first that does not hold (null counts as not holding). Kept records have the columns of
    ``select``, rejected ones their own. Returns how many were kept, and how many rejected for
    each reason, counted while they are written.
    """
    df = normalise_names(df)
    reason = F.coalesce(*(F.when(~F.coalesce(F.expr(rule), F.lit(False)), name) for name, rule in rules.items()), F.lit(None).cast("string"))
    columns = {name: F.expr(e) for name, e in (select or {c: quote(c) for c in df.columns}).items()}
    judged = df.select(reason.alias("reason"), F.struct(*(quote(c) for c in df.columns)).alias("raw"), F.struct(*(e.alias(n) for n, e in columns.items())).alias("record"))
    ok = F.col("reason").isNull()
    counted = Observation()
    outcome = judged.select(
        "reason",
        F.when(~ok, F.col("raw")).alias("raw"),
        F.when(ok, F.col("record")).alias("record"),
        F.when(ok, KEPT).otherwise(REJECTED).alias("outcome"),
    ).observe(counted, F.count_if(ok).alias(KEPT), *(F.count_if(F.col("reason") == name).alias(f"rule_{i}") for i, name in enumerate(rules)))
    outcome.write.mode("overwrite").partitionBy("outcome").parquet(path)
    found = counted.get
    return {KEPT: found[KEPT], **{name: found[f"rule_{i}"] for i, name in enumerate(rules)}}


def kept_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("outcome") == KEPT).select("record.*")


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """The rejected records as they came, and ``reason``."""
    return spark.read.parquet(path).where(F.col("outcome") == REJECTED).select("raw.*", "reason")


def merge_latest(frames: Sequence[DataFrame], keys: Sequence[str], *, version: str | None = None) -> DataFrame:
    """One record for each ``keys`` of datasets that overlap: the latest.

    The record with the greatest ``version`` (a whole number below 2^53) counts, a null being the
    least; among equals that of the last dataset, then the one whose values hash highest. All
    columns come from that record, its nulls too. Order is one decimal number, so the aggregate
    of columns of fixed width goes by hash. Each task's rows are reduced before they are exchanged,
    and the keys, not the zone alone, deal them, so a zone with most rows is spread over all tasks.
    """
    names = merge(frames).columns
    values = [c for c in names if c not in keys]
    place = F.col("_dataset") if version is None else F.coalesce(col(version).cast("decimal(20,0)"), F.lit(-(2**53))) * len(frames) + F.col("_dataset")
    unsigned = F.xxhash64(*map(quote, values)).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    order = (place.cast("decimal(18,0)") * F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(38,0)") + unsigned
    united = merge(f.withColumn("_dataset", F.lit(i)) for i, f in enumerate(frames)).withColumn("_order", order.cast("decimal(38,0)"))
    latest = united.groupBy(*map(col, keys)).agg(*(F.max_by(col(c), "_order").alias(c) for c in values))
    return latest.select(*map(col, names))


def merge(frames: Iterable[DataFrame]) -> DataFrame:
    """Records of several datasets as one; a column a dataset lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_text_csv(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """Header CSV with a known header, all columns text, header checked per file."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_zoned(
    df: DataFrame, path: str, *, zone_col: str = "zone", sort_by: Iterable[str] = (), mode: str = "overwrite"
) -> None:
    """Write Parquet in one folder per zone, sorted inside each file.

    The rebalance sends a zone's rows together, so that small zones make few
    files, and adaptive execution splits a zone that is too large for one task.
    Sorting by time gives row groups that a time filter can skip.
    """
    (
        df.hint("rebalance", zone_col)
        .sortWithinPartitions(zone_col, *sort_by)
        .write.mode(mode)
        .partitionBy(zone_col)
        .parquet(path)
    )


def read_zoned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read Parquet that may lie in folders by zone, with ``schema`` or the one found.

    Without a schema, folder names are text, as a zone is: ``007`` stays ``007`` and
    does not become the number 7.
    """
    if schema is None:
        key = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(key)
        spark.conf.set(key, "false")
        try:
            return spark.read.parquet(path)
        finally:
            spark.conf.set(key, before)
    return spark.read.schema(schema).parquet(path)


def csv_to_parquet(
    spark: SparkSession,
    sources: str | list[str],
    target: str,
    columns: list[str],
    *,
    zone_col: str,
    select: Mapping[str, str] | None = None,
    where: str | None = None,
    sort_by: Iterable[str] = (),
) -> DataFrame:
    """Merge CSV datasets with one header, clean them, write Parquet by zone and read it back.

    ``zone_col`` and ``sort_by`` name output columns.
    """
    records = clean(read_text_csv(spark, sources, columns), select=select, where=where)
    write_zoned(records, target, zone_col=zone_col, sort_by=sort_by)
    return read_zoned(spark, target, records.schema)
