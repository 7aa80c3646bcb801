"""Incremental landing: CSV files that keep arriving, into one Parquet dataset.

With ``merge_above`` the dataset keeps few files however many batches arrive. Every batch
writes its own folder in each zone it has rows for, so a batch that is repeated
overwrites itself. A manifest, one small file a batch, names the folders that count. When a
zone has more than ``merge_above`` folders of one level, those are rewritten as one of the
next level, and only those: a row is rewritten once a level, and a zone holds at most
``merge_above`` folders a level. A folder is deleted one batch after the manifest let it go.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from metricspark.functions.columns import col
from metricspark.sources.ingest import clean, read_zoned

DATA, MANIFEST = "data", "manifest"
_ENTRY = "zone string, folder string, level int, live boolean, schema string"


def land_csv(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: list[str],
    *,
    select: Mapping[str, str] | None = None,
    where: str | None = None,
    partition_by: str | None = None,
    files_per_zone: int = 4,
    max_files: int | None = None,
    interval: str | None = None,
    merge_above: int | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Clean the CSV files new under ``source`` since the last run and append them to ``target``.

    ``columns`` is the header of the files. The ``checkpoint`` (on shared storage)
    records which files are done, so each is landed once, also when a run is
    broken off and started again. Without ``interval`` the query ends when all
    files present have been landed, in batches of ``max_files``; with it the query
    stays and looks for files at that interval.

    With ``partition_by`` a batch's rows are dealt by zone and a salt, so each zone
    gets at most ``files_per_zone`` files a batch. ``merge_above`` (with ``partition_by``)
    bounds the files of all batches; see the module. ``also`` is called with every
    batch's rows and number before they count as landed, and again if the batch is repeated.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = clean(reader.csv(source), select=select, where=where)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    if merge_above is not None:
        if partition_by is None or merge_above < 2:
            raise ValueError("merge_above needs partition_by and at least 2 folders")

        def land(batch: DataFrame, number: int) -> None:
            kept = batch.persist()
            try:
                if also is not None:
                    also(kept, number)
                _land_batch(kept, number, target, partition_by, files_per_zone, merge_above)
            finally:
                kept.unpersist()

        return records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if also is not None:
        raise ValueError("also needs merge_above")
    if partition_by is not None:
        records = _dealt(records, partition_by, files_per_zone)
    writer = records.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(**trigger).start(target)


def _dealt(records: DataFrame, zone: str, files_per_zone: int) -> DataFrame:
    salt = F.pmod(F.xxhash64(*records.columns), F.lit(files_per_zone))
    return records.repartition(col(zone), salt)


def _zone_key(zone: str) -> Column:
    """A folder name for any zone."""
    text = col(zone).cast("string")
    return F.when(text.isNull(), "n").otherwise(F.concat(F.lit("z"), F.hex(F.encode(text, "UTF-8"))))


def _write_folder(records: DataFrame, target: str, folder: str, zone: str, files_per_zone: int) -> None:
    """Writes a folder in every zone of ``records``, in place of what a broken-off try left there."""
    (
        _dealt(records, zone, files_per_zone)
        .withColumns({"_zone": _zone_key(zone), "_folder": F.lit(folder)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_zone", "_folder")
        .parquet(f"{target}/{DATA}")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _manifest(spark: SparkSession, target: str, before: int | None = None) -> list:
    """The newest manifest's rows (below batch ``before``); none when nothing has landed."""
    if not _exists(spark, f"{target}/{MANIFEST}"):
        return []
    rows = spark.read.schema(f"{_ENTRY}, batch long").parquet(f"{target}/{MANIFEST}")
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    newest = rows.agg(F.max("batch")).first()[0]
    return [] if newest is None else rows.where(F.col("batch") == newest).collect()


def _folders(spark: SparkSession, target: str, entries: list) -> DataFrame:
    """The rows of the folders that a manifest's ``entries`` name."""
    fields = T.StructType.fromJson(json.loads(entries[0]["schema"])).fields
    schema = T.StructType([*fields, T.StructField("_zone", T.StringType()), T.StructField("_folder", T.StringType())])
    found = spark.read.schema(schema).parquet(f"{target}/{DATA}").where(F.col("_folder").isin(sorted({e["folder"] for e in entries})))
    # as many rows as zones have folders, which merging bounds
    named = spark.createDataFrame([(e["zone"], e["folder"]) for e in entries], "_zone string, _folder string")
    return found.join(F.broadcast(named), ["_zone", "_folder"], "left_semi").drop("_zone", "_folder")


def _land_batch(batch: DataFrame, number: int, target: str, zone: str, files_per_zone: int, merge_above: int) -> None:
    spark = batch.sparkSession
    before = _manifest(spark, target, number)
    for entry in before:
        if not entry["live"]:  # let go by the batch before this one
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{DATA}/_zone={entry['zone']}/_folder={entry['folder']}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    schema = batch.schema.json()

    def entry_of(zone_key: str, folder: str, level: int, live: bool = True) -> dict:
        return {"zone": zone_key, "folder": folder, "level": level, "live": live, "schema": schema}

    live = [e.asDict() for e in before if e["live"]]
    _write_folder(batch, target, f"{number}-0", zone, files_per_zone)
    live += [entry_of(r[0], f"{number}-0", 0) for r in batch.select(_zone_key(zone)).distinct().collect()]
    dead, level = [], 0
    while any(e["level"] >= level for e in live):
        folders = Counter(e["zone"] for e in live if e["level"] == level)
        full = [e for e in live if e["level"] == level and folders[e["zone"]] > merge_above]
        if full:
            merged = f"{number}-{level + 1}"
            _write_folder(_folders(spark, target, full), target, merged, zone, files_per_zone)
            live = [e for e in live if e not in full]
            live += [entry_of(z, merged, level + 1) for z in sorted({e["zone"] for e in full})]
            dead += [entry_of(e["zone"], e["folder"], e["level"], live=False) for e in full]
        level += 1
    entries = [tuple(e[c] for c in ("zone", "folder", "level", "live", "schema")) for e in (*live, *dead)]
    # one file, which appears as a whole
    spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{target}/{MANIFEST}/batch={number}")


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The records landed so far; files of a broken-off batch are not seen."""
    live = [e for e in _manifest(spark, target) if e["live"]]
    return _folders(spark, target, live) if live else read_zoned(spark, target)
