"""Labelled top-k and bottom-k lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.functions.columns import col

DIRECTIONS = ("highest", "lowest")


def ranked_extremes(
    df: DataFrame,
    metrics: Sequence[str],
    *,
    k: int = 5,
    by: Sequence[str] = (),
    ties: Sequence[str] = ("year", "month"),
    nulls: str = "last",
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows by each metric, over all rows or per ``by`` group.

    Adds ``label`` (``highest_<metric>`` and so on; ``labels`` renames a metric in
    it) and ``rank`` from 1. Equal values rank by the ``ties`` columns. A null
    ranks last; ``nulls="spark"`` puts it first in the ``lowest`` lists, as a plain
    ascending sort does.

    Each row is set out once for every list, and all lists are ranked in one window
    over (group, label). The rank filter is pushed below its exchange, which keeps
    ``k`` rows per group, list and task: a group of any size stays cheap. Values keep
    their types: a type has one key column that sorts upwards and one that sorts
    downwards, and in each list all but one of them are null.
    """
    if nulls not in ("last", "spark"):
        raise ValueError(f"unknown null order {nulls!r}")
    kinds = {m: df.select(col(m)).schema[0].dataType for m in metrics}
    keys = {}
    for kind in kinds.values():
        for direction in DIRECTIONS:
            keys.setdefault((kind, direction), f"_key{len(keys)}")
    entries = []
    for metric in metrics:
        for direction in DIRECTIONS:
            null_place = -1 if nulls == "spark" and direction == "lowest" else 1
            values = (
                (col(metric) if at == (kinds[metric], direction) else F.lit(None).cast(at[0])).alias(key)
                for at, key in keys.items()
            )
            entries.append(
                F.struct(
                    F.lit(f"{direction}_{(labels or {}).get(metric, metric)}").alias("label"),
                    F.when(col(metric).isNull(), null_place).otherwise(0).alias("_first"),
                    *values,
                )
            )
    lists = df.select("*", F.inline(F.array(*entries)))
    order = Window.partitionBy(*(col(b) for b in by), "label").orderBy(
        "_first",
        *(F.desc(key) if direction == "highest" else F.asc(key) for (_, direction), key in keys.items()),
        *(col(t).asc_nulls_last() for t in ties),
    )
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(*(col(c) for c in df.columns), "label", "rank")
