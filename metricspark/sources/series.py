"""Reading metric series from Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions.columns import col
from metricspark.functions.parsing import parse_time, to_double
from metricspark.sources.ingest import read_zoned
from metricspark.spec import SeriesSpec


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail at once, before any job, when ``df`` lacks one of ``names``."""
    present = set(df.columns)
    missing = [n for n in names if n not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def series_of(raw: DataFrame, spec: SeriesSpec, zone: str | None = None) -> DataFrame:
    """Project a raw table to ``(zone, ts, <metrics...>)``.

    A projection only, so that the scan below it reads just these columns.
    """
    require_columns(raw, spec.required)
    if zone is not None:
        zone_value = F.lit(zone)
    elif spec.zone_col is not None:
        zone_value = col(spec.zone_col)
    else:
        raise ValueError("the zone must come from spec.zone_col or be given by name")
    return raw.select(
        zone_value.alias("zone"),
        parse_time(col(spec.time_col), spec.time_format, spec.mode).alias("ts"),
        *(to_double(col(c), spec.mode).alias(name) for name, c in spec.metrics.items()),
    )


def union_zones(zones: Iterable[DataFrame]) -> DataFrame:
    """All zones as one bag of rows, so that one aggregate serves every zone."""
    return reduce(lambda a, b: a.unionByName(b), zones)


def read_series(
    spark: SparkSession,
    source: str | Mapping[str, str],
    spec: SeriesSpec | Mapping[str, SeriesSpec],
    *,
    zones: Iterable[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Read one dataset with a zone column, or one dataset per zone.

    ``source`` is a path (zone taken from ``spec.zone_col``; best written with
    ``write_zoned``, so that a zone filter prunes folders) or ``{zone: path}``,
    where ``spec`` may differ per zone. ``zones``, ``start`` (inclusive) and
    ``end`` (exclusive) are filters that reach the scan.
    """
    if isinstance(source, str):
        if not isinstance(spec, SeriesSpec):
            raise ValueError("one dataset takes one spec")
        series = series_of(read_zoned(spark, source), spec)
    else:
        spec_of = spec.__getitem__ if isinstance(spec, Mapping) else lambda _zone: spec
        series = union_zones(
            series_of(read_zoned(spark, path), spec_of(zone), zone) for zone, path in source.items()
        )
    if zones is not None:
        series = series.where(F.col("zone").isin(list(zones)))
    if start is not None:
        series = series.where(F.col("ts") >= F.lit(start).cast(series.schema["ts"].dataType))
    if end is not None:
        series = series.where(F.col("ts") < F.lit(end).cast(series.schema["ts"].dataType))
    return series


def register_view(df: DataFrame, name: str) -> str:
    """Name ``df`` for SQL text; the view is a plan, nothing is computed."""
    df.createOrReplaceTempView(name)
    return name
