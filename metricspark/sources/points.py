"""Reading per-entity points from header CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metricspark.functions.columns import col
from metricspark.functions.parsing import to_double
from metricspark.sources.series import require_columns
from metricspark.spec import PointSpec


def points_of(raw: DataFrame, spec: PointSpec) -> DataFrame:
    require_columns(raw, spec.required)
    return raw.select(
        col(spec.key_col).alias(spec.key_name),
        *(to_double(col(c), spec.mode).alias(name) for name, c in spec.features.items()),
    )


def read_points(
    spark: SparkSession, path: str | list[str], spec: PointSpec, columns: list[str] | None = None
) -> DataFrame:
    """Read header CSV as text and cast the features.

    Giving the file's ``columns`` in order spares the pass that looks up the
    header; either way every file's header is checked against them, and no types
    are guessed.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return points_of(reader.csv(path), spec)
