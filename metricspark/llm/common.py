"""What several operators share: tokenizer files, table reading, a bounded word cache."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BPE = "word_bpe_49k.json"
# A word is a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def tokenizer_path(name: str = WORD_BPE) -> str:
    """Place of a public tokenizer file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def crc_bucket(column: str, buckets: int) -> Column:
    """``crc32(column as text) mod buckets``; 0 for a null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % buckets, F.lit(0)).cast("int")


def hash_sample(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows, chosen by their hash ``key``, the same in every run.

    Of ``total`` rows a share by the key's low bits goes on, so that the tasks
    together send few rows more than are wanted; of those the least keys are taken.
    """
    share = min(1.0, rows / max(total, 1))
    return df.where(F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(key).limit(rows)


def bounded_rows(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, one for each ``keys``: what may go to the driver however often ids repeat."""
    return df.dropDuplicates(keys).orderBy(*keys).limit(rows)


class Memo(dict):
    """A dict that computes what is missing; emptied when it holds ``limit`` entries.

    Memory stays bounded on any corpus, and an emptied memo only costs time.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._compute(key)
        return value


def release_memory() -> None:
    """Gives back what a finished task no longer uses; workers live on, and others share their memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own house
        pass


BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keeps what a Python worker holds at a time to a few megabytes of long texts."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = re.match(r"\d+", spark.conf.get(key, None) or "")
        if not now or not 0 < int(now[0]) <= most:
            spark.conf.set(key, str(most))


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` that also replaces columns whose names differ in case only."""
    bound_batches(df.sparkSession)
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


class PieceEncoder:
    """Ids of texts from those of the pieces between their blanks and line feeds.

    Arrow splits a batch and finds its distinct pieces; only those are looked up or
    encoded, and their ids are gathered for all texts. What is remembered is bounded.
    """

    SLICE = 500

    def __init__(self, encode: Callable[[list[str]], list[bytes]], dtype: str, limit: int = 150_000):
        self.encode, self.dtype, self.limit = encode, np.dtype(dtype), limit
        # two generations: what is met again moves to the young one, the old one is dropped
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def look(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        young, old = self.young, self.old
        got = list(map(young.get, words))
        new = []
        for i in [i for i, g in enumerate(got) if g is None]:
            known = old.get(words[i])
            if known is None:
                new.append(i)
            else:
                got[i] = young[words[i]] = known
        for start in range(0, len(new), 10_000):
            some = [words[i] for i in new[start : start + 10_000]]
            coded = self.encode(some)
            got_part = dict(zip(some, coded))
            for i, c in zip(new[start : start + 10_000], coded):
                got[i] = c
            young.update(got_part)
        if len(young) >= self.limit:
            self.old, self.young = young, {}
        return got

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an array of texts without nulls, and the place where each begins."""
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        got = self.look(coded.dictionary.to_pylist())
        ends = np.cumsum([0, *map(len, got)]) // self.dtype.itemsize
        ids = pa.array(np.frombuffer(b"".join(got), self.dtype))
        gathered = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), ids).take(coded.indices)
        at = np.asarray(pieces.offsets) - pieces.offsets[0].as_py()
        offsets = np.asarray(gathered.offsets)[at]
        return np.asarray(gathered.flatten()), offsets - (offsets[0] if len(offsets) else 0)
