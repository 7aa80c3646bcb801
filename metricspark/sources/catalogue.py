"""Enumerating and reading a catalogue of per-zone, per-year CSV datasets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.functions.columns import quote

# What the published electricity datasets cover.
GRANULARITIES = ("hourly", "daily", "monthly", "yearly")
HOURLY_ZONES = ("IT", "SE")
HOURLY_YEARS = (2021, 2022, 2023, 2024)
YEARLY_ZONES = (
    "AT", "BE", "FR", "FI", "DE", "GB", "IE", "IT", "NO", "PL", "CZ", "SI", "ES", "SE", "CH",
    "US", "AE", "CN", "IN", "JP", "BR", "MX", "CA", "AU", "ZA", "KR", "ID", "SG", "AR", "EG",
)
YEARLY_YEARS = (2024,)

def dataset_names(zones: Iterable[str], years: Iterable[int], granularity: str = "hourly") -> list[str]:
    """File names ``{zone}_{year}_{granularity}.csv``, zone by zone."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"unknown granularity {granularity!r}; have {GRANULARITIES}")
    years = list(years)
    return [f"{zone}_{year}_{granularity}.csv" for zone in zones for year in years]


def published_names(granularity: str = "hourly") -> list[str]:
    """Every published dataset: the series at ``granularity``, then the yearly points."""
    return [
        *dataset_names(HOURLY_ZONES, HOURLY_YEARS, granularity),
        *dataset_names(YEARLY_ZONES, YEARLY_YEARS, "yearly"),
    ]


def read_catalogue(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    columns: list[str],
    *,
    prefix: str = "",
    allow_missing: bool = False,
) -> DataFrame:
    """Read the named datasets in one scan; zone, year and granularity come from the path.

    ``columns`` is the common header, checked against every file. A name that does
    not exist is an error unless ``allow_missing``, which looks the names up as one
    glob. ``prefix`` is put before each name (``dataset=`` for a folder layout
    written with ``partitionBy("dataset")``).
    """
    files = [prefix + name for name in names]
    path = f"{base}/{{{','.join(files)}}}" if allow_missing else [f"{base}/{f}" for f in files]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    zone, year, granularity = _from_path(F.col("_metadata.file_path"))
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
        .select(
            zone.alias("zone"),
            year.alias("year"),
            granularity.alias("granularity"),
            *(F.col(quote(c)) for c in columns),
        )
    )


def _from_path(path: Column) -> tuple[Column, Column, Column]:
    """Zone, year and granularity of a dataset that is a file, or a folder of part files.

    Cut out with plain string functions: this runs for every row, and a regular
    expression over the whole path would cost more than reading the row.
    """
    tail = F.substring_index(path, "/", -2)
    folder_or_file = F.when(F.instr(tail, ".csv/") > 0, tail).otherwise(F.substring_index(tail, "/", -1))
    name = F.substring_index(F.substring_index(folder_or_file, ".csv", 1), "=", -1)
    last_two = F.substring_index(name, "_", -2)
    zone = F.substring(name, F.lit(1), F.length(name) - F.length(last_two) - 1)
    return zone, F.substring_index(last_two, "_", 1).try_cast("int"), F.substring_index(last_two, "_", -1)
