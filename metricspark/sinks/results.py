"""Writing results, and collecting written results by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions.columns import col


def write_result(
    df: DataFrame,
    path: str,
    *,
    order_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    single_file: bool = False,
    fmt: str = "csv",
    mode: str = "overwrite",
) -> str:
    """Write ``df`` with a header and return ``path``.

    ``order_by`` may name columns that are not among the ``columns`` written.
    ``single_file`` is for results known to be small, such as reports: the finished
    rows are exchanged into one task and sorted there, so that the steps before
    stay parallel.
    """
    order = [col(c) for c in order_by]
    if single_file:
        df = df.repartition(1)
        df = df.sortWithinPartitions(*order) if order else df
    elif order:
        df = df.orderBy(*order)
    if columns is not None:
        df = df.select(*(col(c) for c in columns))
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def collect_results(spark: SparkSession, root: str, *, suffix: str = ".csv") -> DataFrame:
    """Every line of every result file under ``root``: ``(result, part, position, line)``.

    A result is named after the folder its files lie in; all of its files are
    kept. Files are read by lines, so they may be of any size and have any header;
    ``position`` orders the lines of one file.
    """
    where = F.col("_metadata.file_path")
    # Lines of one file split keep their order in the row id, and splits of one
    # file are ordered by where they start.
    position = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .text(root)
        .select(
            F.substring_index(F.substring_index(where, "/", -2), "/", 1).alias("result"),
            where.alias("part"),
            position.alias("position"),
            F.col("value").alias("line"),
        )
    )


def export_results(lines: DataFrame, path: str) -> None:
    """Write collected lines as text, one folder per result, lines in order.

    The sort is by ranges over all results, so a result with most of the lines is
    spread over many tasks; its files in name order give back its text.
    """
    (
        lines.sort("result", "part", "position")
        .select("result", "line")
        .write.mode("overwrite")
        .partitionBy("result")
        .text(path)
    )
