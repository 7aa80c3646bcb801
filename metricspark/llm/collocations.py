"""Operator 12: phrase collocations from Rabin-Karp fingerprints.

A batch of texts is one buffer of bytes: letters A-Z lowered, runs of blanks made one,
piece ends marked. Prefix sums of ``byte * base^place`` modulo 2^64 give the fingerprint of
any word as a difference, and prefix sums over those give that of any run of words, so
numpy hashes every n-gram of the batch in a few passes, whatever its length.

1. Fingerprints of words are counted: by task first, then shuffled by ranges of fingerprints, as
   sorted arrays of the rest of their bits with counts, and added up range by range.
2. So are those of pairs whose words are both frequent, then those of three and four
   words whose pairs are all frequent: a phrase is never more frequent than its parts.
   What is frequent is passed on as a bit map of fixed size, and fingerprints are cut to
   the range's bits and 32 more, so a part may be taken for frequent wrongly, never the other way round.
3. The frequent fingerprints' occurrences are read from the text. In a batch each points
   at its place; it is compared, byte by byte, with the first occurrence of its fingerprint,
   and one that differs goes on by itself. So the phrase's text is the key of the final counts,
   which are exact; only frequent phrases are ever written out.
4. Cuts, scores, the removal of phrases inside longer ones and the ranking are joins and
   windows over the frequent phrases.

All languages go through the same steps; the language is part of the fingerprint. A
frequent word or phrase is one entry a task before any shuffle.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated
rows count as often as they occur; ties are ranked by the phrase's UTF-8 bytes; other
columns are not read; an empty table gives an empty result. Texts of any length are
read whole, in blocks that end where a piece ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from metricspark.llm.common import bound_batches, release_memory
from metricspark.session import work_path

LEAST, LONGEST, TOP = 30, 4, 2_000
SCORE_SCALE, INSIDE_PERCENT = 2_000_000, 80
NO_LANGUAGE = "und"
# Bits of the map of frequent fingerprints: 8 MB at most, whatever the input.
MAP_BITS = 26
# Bytes of text that are hashed at a time, and fingerprints that a task holds before it sends them on.
BLOCK = 4 << 20
HELD = 2 << 20
# Fingerprints of one range, about, and the most ranges.
RANGE_PRINTS, MOST_RANGES = 1 << 20, 1 << 16
BLANK, END = 0x20, 0x0A
# what separates words becomes a blank, what ends pieces a line feed
MARKS = bytes.maketrans(b"\x09.,;:!?\x0b\x0c\x0d", b"\x20" + b"\x0a" * 9)
EMPTY_AND_END = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(BASE, len(values)), dtype=np.uint64)))


class Block:
    """The words of some texts: their places, pieces, languages and fingerprints."""

    def __init__(self, marked: bytes, languages: np.ndarray, ends: np.ndarray):
        """``ends[i]`` is where text ``i`` ends, ``languages[i]`` the number of its language's hash."""
        raw = np.frombuffer(marked, np.uint8)
        gap = (raw == BLANK) | (raw == END)
        # of a run of separators the last byte stays, so a phrase is a range of bytes
        kept = ~gap
        kept[:-1] |= ~gap[1:]
        self.bytes = np.where(gap, np.uint8(BLANK), raw)[kept]
        gap = gap[kept]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
        self.start, self.end = edges[0::2], edges[1::2]
        places = np.flatnonzero(kept)[self.start]
        self.piece = np.cumsum(raw == END)[places] if len(raw) else np.zeros(0, np.int64)
        self.text = np.searchsorted(ends, places, side="right")
        sums = prefix_sums(BYTE_VALUES[self.bytes])
        words = mix((sums[self.end] - sums[self.start]) * powers(INVERSE, len(self.bytes) + 1)[self.start])
        self._seed = languages[self.text]
        self._sums, self._inverse = prefix_sums(words), powers(INVERSE, len(words))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first words of all runs of ``size`` words in a piece, and their fingerprints."""
        n = max(0, len(self.start) - size + 1)
        at = np.flatnonzero(self.piece[:n] == self.piece[size - 1 : size - 1 + n])
        values = (self._sums[at + size] - self._sums[at]) * self._inverse[at]
        return at, mix(values + self._seed[at] * np.uint64(2 * size + 1))

    def ranges(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        return self.start[at], self.end[at + size - 1]


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, np.ndarray, pa.Array]]:
    """Blocks of a batch of ``lang, text`` without nulls, the numbers of their texts' languages, and these."""
    lang = batch.column(0).dictionary_encode()
    codes = np.asarray(lang.indices)
    seeds = [xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) for name in lang.dictionary.to_pylist()]
    hashes = np.array(seeds, dtype=np.uint64)[codes]
    lowered = pc.binary_join_element_wise(pc.ascii_lower(batch.column(1).cast(pa.large_string())), *EMPTY_AND_END)
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
    marked = lowered.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]].translate(MARKS) if len(lowered) else b""
    ends, at = offsets[1:] - offsets[0], 0
    while at < len(marked):
        to = marked.rfind(b"\n", at, at + BLOCK) + 1 or marked.find(b"\n", at) + 1
        first = int(np.searchsorted(ends, at, side="right"))
        yield Block(marked[at:to], hashes[first:], ends[first:] - at), codes[first:], lang.dictionary
        at = to


def holds(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether a map of frequent fingerprints may hold each."""
    place = prints >> np.uint64(64 - MAP_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _texts(documents: DataFrame) -> DataFrame:
    bound_batches(documents.sparkSession)
    return documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _range_bits(texts: DataFrame) -> int:
    """Bits that pick the range: as many ranges as the texts' bytes ask for, at five bytes a word."""
    volume = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(64, volume // (5 * RANGE_PRINTS)))
    return (ranges - 1).bit_length()


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The parts of an array between ``cuts``, each as one value of bytes."""
    offsets = pa.py_buffer((cuts * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def frequent_map(texts: DataFrame, sizes: range, range_bits: int, parts: int = 0, bits: np.ndarray | None = None, least: int = LEAST) -> np.ndarray:
    """The bit map, by their first ``MAP_BITS`` bits, of fingerprints of ``sizes`` words that occur ``least`` times.

    Only runs count of which the map ``bits`` holds all runs of ``parts`` words. A count
    need not be known beyond ``least``. At most 2^(MAP_BITS - 6) rows of two numbers are
    read by the driver.
    """
    kind = np.dtype("<u1" if least < 256 else "<u4")
    shift = np.uint64(64 - range_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> pa.RecordBatch:
            prints, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            part = prints >> shift
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
            cuts = np.append(first, len(prints))
            rest = ((prints >> (shift - np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype("<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array(part[first].astype(np.int32)), _binaries(rest, cuts), _binaries(np.minimum(counts, least).astype(kind), cuts)],
                names=["part", "prints", "counts"],
            )

        for batch in batches:
            for block, _, _ in blocks(batch):
                if bits is not None:
                    places, prints = block.grams(parts)
                    frequent = np.zeros(len(block.start) + LONGEST, bool)
                    frequent[places[holds(bits, prints)]] = True
                for size in sizes:
                    at, prints = block.grams(size)
                    if bits is not None:
                        prints = prints[np.logical_and.reduce([frequent[at + k] for k in range(size - parts + 1)])]
                    held.append(prints)
                if sum(map(len, held)) >= HELD:
                    yield sent()
        if held:
            yield sent()
        release_memory()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, prints, counts, waiting = None, [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            rest, group = np.unique(np.concatenate(prints), return_inverse=True)
            return rest, np.minimum(np.bincount(group, np.concatenate(counts), len(rest)), least).astype(kind)

        def found() -> pa.RecordBatch:
            rest, times = merged()
            often = (np.uint64(current) << shift) | (rest[times >= least].astype(np.uint64) << (shift - np.uint64(32)))
            place = often >> np.uint64(64 - MAP_BITS)
            words, group = np.unique(place >> np.uint64(6), return_inverse=True)
            out = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(out, group, np.uint64(1) << (place & np.uint64(63)))
            return pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(out.view(np.int64))], names=["word", "bits"])

        for batch in batches:
            for part, some, times in zip(*(c.to_pylist() for c in batch.columns)):
                if part != current:
                    if current is not None:
                        yield found()
                    current, prints, counts, waiting = part, [], [], 0
                prints.append(np.frombuffer(some, "<u4"))
                counts.append(np.frombuffer(times, kind))
                waiting += len(prints[-1])
                if waiting >= 4 * RANGE_PRINTS:  # a range's parts are added up as they come
                    rest, times = merged()
                    prints, counts, waiting = [rest], [times], 0
        if current is not None:
            yield found()
        release_memory()

    sent = texts.mapInArrow(count, "part int, prints binary, counts binary")
    dealt = sent.repartition("part").sortWithinPartitions("part")
    words = dealt.mapInArrow(add_up, "word long, bits long").toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    np.bitwise_or.at(out, words.column("word").to_numpy(), words.column("bits").to_numpy().view(np.uint64))
    return out


def _differ(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Which byte ranges are not equal to their others."""
    differ = end - start != other_end - other
    rows = np.flatnonzero(~differ & (start != other))
    sizes = (end - start)[rows]
    steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    unlike = data[np.repeat(start[rows], sizes) + steps] != data[np.repeat(other[rows], sizes) + steps]
    differ[np.repeat(rows, sizes)[unlike]] = True
    return differ


def phrase_batches(batches: Iterator[pa.RecordBatch], maps: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``lang, size, phrase, n`` of each block; of size 0, the number of its words.

    ``maps`` are those of words, pairs and longer runs; a run is read if its parts are too.
    """
    for batch in batches:
        for block, codes, names in blocks(batch):
            lang, data = codes[block.text], block.bytes.tobytes()
            for size in range(LONGEST + 1):
                if not size:
                    of, counts = np.unique(lang, return_counts=True)
                    phrases = [""] * len(of)
                else:
                    at, prints = block.grams(size)
                    some = holds(maps[min(size, len(maps)) - 1], prints)
                    if size > 1:
                        some &= np.logical_and.reduce([read[at + k] for k in range(size - inner + 1)])
                    at, prints = at[some], prints[some]
                    if size <= 2:  # what longer runs must consist of
                        read, inner = np.zeros(len(block.start) + LONGEST, bool), size
                        read[at] = True
                    _, first, group = np.unique(prints, return_index=True, return_inverse=True)
                    start, end = block.ranges(at, size)
                    # what differs from the first occurrence of its fingerprint goes on alone
                    alone = _differ(block.bytes, start, end, start[first][group], end[first][group])
                    alone |= lang[at] != lang[at][first][group]
                    counts = np.concatenate((np.bincount(group[~alone], minlength=len(first)), np.ones(alone.sum(), np.int64)))
                    shown = np.concatenate((first, np.flatnonzero(alone)))
                    of = lang[at][shown]
                    phrases = [data[a:b].decode("utf-8", "replace") for a, b in zip(start[shown].tolist(), end[shown].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(of)), pa.array(np.full(len(of), size, np.int32)), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "size", "phrase", "n"],
                )


def phrase_counts(texts: DataFrame, maps: list[np.ndarray]) -> DataFrame:
    """``lang, size, phrase, n``: exact counts of the phrases that the maps may hold; of size 0, all words."""
    counted = texts.mapInArrow(lambda batches: phrase_batches(batches, maps), "lang string, size int, phrase string, n long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, size, phrase, n``: all phrases of one to four words that occur ``least`` times, and words in all as size 0."""
    texts = _texts(documents)
    spark = documents.sparkSession
    range_bits, maps = _range_bits(texts), []
    for sizes, parts in ((range(1, 2), 0), (range(2, 3), 1), (range(3, LONGEST + 1), 2)):
        maps.append(frequent_map(texts, sizes, range_bits, parts, maps[-1] if maps else None, least))
    path = work_path(spark, "phrases")
    counted = phrase_counts(texts, maps)
    counted.where((F.col("n") >= least) | (F.col("size") == 0)).write.parquet(path)
    return spark.read.parquet(path)


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of every language, by their weakest cut."""
    known = frequent_phrases(documents, least)
    words = F.split("phrase", " ")
    candidates = known.where(F.col("size") > 1)

    def run(first, n):
        return F.array_join(F.slice(words, first, n), " ")

    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("first"), run(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    part = known.where(F.col("size").between(1, LONGEST - 1))
    left = part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(f"cast((cast(a as decimal(20, 0)) * {SCORE_SCALE}) div (cast(l as decimal(20, 0)) + r) as bigint)")
    weakest = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )

    longer = candidates.where(F.col("size") > 2).select(
        "lang", F.col("n").alias("whole"), words.alias("w"), F.explode(F.expr("sequence(2, size - 1)")).alias("inner"), "size"
    )
    inside = (
        longer.select("lang", "whole", "w", "inner", F.explode(F.expr("sequence(1, size - inner + 1)")).alias("first"))
        .groupBy("lang", F.expr("array_join(slice(w, first, inner), ' ')").alias("phrase"))
        .agg(F.max("whole").alias("whole"))
    )
    kept = weakest.join(inside, ["lang", "phrase"], "left").where(
        F.col("whole").isNull() | (F.col("whole").cast("decimal(20, 0)") * 100 < F.col("a").cast("decimal(20, 0)") * INSIDE_PERCENT)
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    totals = known.where(F.col("size") == 0).select("lang", "n")
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
