"""Operator 4: n-gram Jaccard join by size-banded tiles with bitmap signatures.

A document's set is that of its hashed word 5-grams. Equal sets are folded first.
The exact links between the others come from tiles:

* A set of size n shows only its first n - ceil(t n) + 1 grams in one common order;
  two sets of likeness t or more share one of those, and meet in that gram's tile.
  The order puts frequent grams last. Frequency is counted over all documents in
  bounded memory: every task counts a window of grams at a time and reports what
  occurs ``REPORT`` times in it, so a gram that is frequent overall is missed by less
  than ``REPORT`` a window. The list of frequent grams has at most one entry for
  ``REPORT`` grams of one window, whatever the corpus, and only that is broadcast.
* In a tile, sets stand by size, and each is compared only with those of the size band
  that the threshold allows, if what follows the gram in both could suffice. Parity
  bitmaps of up to ``TILE_BITS`` bits bound the overlap from above: with d differing bits, two sets share at most (n + m - d) / 2 grams. Pairs
  left by that meet full bitmaps, which have a bit for every gram and fold to any
  smaller width; what is left then is decided exactly on the sorted arrays.
* Passes over the tiles unite families before all pairs are tried. In each pass a set takes the
  first partner of another component that the bounds leave open, one a tile; links found are
  contracted, and the next pass has only the sets of components that grew. A family of
  thousands of near copies gives as many pairs as its number, not its square. When a pass
  brings no link, all pairs that still lie in different components are tried, in blocks of
  ``BLOCK`` sets where a tile is larger. Two sets that stand together in a row of tiles are paired in the
  first of them only. A frequent gram's tile is dealt to several tasks by the
  sets' hashes from the start.

Components come from repeated contraction: every node goes to the neighbour (or itself) of least
hash, and only edges between what is left go on, so rounds shrink. Each is written
to the shared folder, and folders that nothing reads any more are deleted.

Defined cases: null, empty and wordless texts have the empty set, link with nothing
and are their own component; fewer than five words are one gram; texts of any length
are read whole; rows that share a ``doc_id`` count as one document for links and have
one component, whatever their texts; rows without one link with nothing and have a
null component; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from metricspark.llm.common import bound_batches, release_memory
from metricspark.session import discard, work_path

WORDS = 5
# likeness of at least 3/4: |a & b| * 7 >= 3 * (|a| + |b|)
BITS = 512  # of the narrowest bitmap
TILE_BITS = 2_048  # of the widest one in a tile
WINDOW = 1 << 22
REPORT = 8
FREQUENT = 64
BLOCK = 2_000

_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)

# ---- sets -------------------------------------------------------------------


def gram_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its word 5-grams (of the whole, with fewer words).

    Arrow cuts the words and finds the distinct ones of a batch; each is hashed once.
    """
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = cut.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    codes = np.asarray(coded.indices)
    filled = codes != (words.index(b"") if b"" in words else -1)  # blanks at an end leave an empty word
    before = np.concatenate([[0], np.cumsum(filled)])
    at = before[np.asarray(cut.offsets) - cut.offsets[0].as_py()]
    each = hashes[codes[filled]]
    gram = np.zeros(max(len(each) - WORDS + 1, 0), np.uint64)
    for j in range(WORDS):
        gram = (gram ^ each[j : j + len(gram)]) * _MIX[j]
        gram ^= gram >> np.uint64(29)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(gram[a : b - WORDS + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(each[a:b].tobytes())] if b > a else [], np.uint64))
    return out


def gram_set(text: str) -> np.ndarray:
    return gram_sets(pa.array([text]))[0]


def set_hash(grams: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(grams.tobytes()), np.uint64).astype(np.int64))


def bitmap(grams: np.ndarray) -> bytes:
    """Bit i: whether an odd number of grams falls on i. At least a bit for every gram."""
    width = max(BITS, 1 << (len(grams) - 1).bit_length()) if len(grams) else BITS
    counts = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of ``size`` bytes that the same grams have: parities add up."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def differing(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, size) ^ fold(b, size)).sum(dtype=np.int64))


def prefix(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The grams that a set shows: rare ones first, each group by hash."""
    n = len(grams)
    size = n - -(-3 * n // 4) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        often = frequent[at] == grams
        if often[: 4 * size].any():
            grams = np.concatenate([grams[~often], grams[often]])
    return grams[:size]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    return 7 * len(np.intersect1d(a, b, assume_unique=True)) >= 3 * (len(a) + len(b))


# ---- the scans of the texts -------------------------------------------------

_PROFILE = "doc_id long, n int, hash long, bits binary, gram long, times int"


def _profile(documents: DataFrame) -> DataFrame:
    """A row per document with its set's size, hash and bitmap; and reported grams."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, size, seen = np.empty(0, np.uint64), 0, set()

        def batch_of(doc_ids, sizes, hashes, bits, grams, times):
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
            n = max(len(doc_ids), len(grams))
            columns = [
                pa.array(c, k) if len(c) else pa.nulls(n, k)
                for c, k in zip((doc_ids, sizes, hashes, bits, grams, times), kinds)
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "hash", "bits", "gram", "times"])

        def report():
            """What occurs often in the window, which is sorted in place."""
            nonlocal size, seen
            window[:size].sort()
            first = np.flatnonzero(np.concatenate(([True], window[1:size] != window[: size - 1])))
            times = np.diff(np.append(first, size))
            often = times >= REPORT
            found = window[first[often]].astype(np.int64), times[often]
            size, seen = 0, set()
            return batch_of([], [], [], [], *found)

        for batch in batches:
            sizes, hashes, bits = [], [], []
            for grams in gram_sets(batch.column(1)):
                sizes.append(len(grams))
                hashes.append(set_hash(grams))
                bits.append(bitmap(grams))
                if len(grams) and hashes[-1] not in seen:  # copies don't make grams frequent
                    seen.add(hashes[-1])
                    if size and size + len(grams) > WINDOW:
                        yield report()
                    if size + len(grams) > len(window):  # grows with the input, to a window or one text
                        grown = np.empty(max(min(2 * len(window), WINDOW), size + len(grams)), np.uint64)
                        grown[:size] = window[:size]
                        window = grown
                    window[size : size + len(grams)] = grams
                    size += len(grams)
            yield batch_of(batch.column(0).to_pylist() if batch.num_rows else [], sizes, hashes, bits, [], [])
        if size:
            yield report()
        del window
        release_memory()

    return _narrow(documents).mapInArrow(scan, _PROFILE)


def _narrow(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _postings(documents: DataFrame, frequent: np.ndarray, parts: np.ndarray) -> DataFrame:
    """(gram, part, hash, size) of what every set shows; a frequent gram has several ``parts``.

    ``size`` holds the set's size in its upper and, in its lower 32 bits, how many of
    its grams stand at this one or later in the common order: two sets whose first
    common gram this is share no more than the lesser of these.
    """
    shared = documents.sparkSession.sparkContext.broadcast((frequent, parts))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, parts = shared.value
        for batch in batches:
            shown, hashes, sizes, done = [], [], [], set()
            for grams in gram_sets(batch.column(1)):
                own = set_hash(grams)
                if len(grams) and own not in done:
                    done.add(own)
                    shown.append(prefix(grams, frequent))
                    hashes.append(own)
                    sizes.append(len(grams))
            lengths = [len(s) for s in shown]
            gram = np.concatenate([np.zeros(0, np.uint64), *shown])
            hash_ = np.repeat(np.array(hashes, np.int64), lengths)
            part = np.full(len(gram), -1, np.int32)  # of grams that are not known as frequent
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, gram), len(frequent) - 1)
                often = frequent[at] == gram
                part[often] = (hash_[often].view(np.uint64) % parts[at[often]]).astype(np.int32)
            rest = [n - np.arange(k) for n, k in zip(sizes, lengths)]
            size = (np.repeat(np.array(sizes, np.int64), lengths) << 32) + np.concatenate([np.zeros(0, np.int64), *rest]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(part), pa.array(hash_), pa.array(size)], names=["gram", "part", "hash", "size"]
            )
        release_memory()

    return _narrow(documents.where(F.col("doc_id").isNotNull())).mapInArrow(scan, "gram long, part int, hash long, size long")


def _open(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can link, this being their first common gram."""
    n, m = size_a >> 32, size_b >> 32
    most = np.minimum(np.minimum(size_a & 0xFFFFFFFF, size_b & 0xFFFFFFFF), np.minimum(n, m))
    return 7 * most >= 3 * (n + m)


def _shared_postings(postings: DataFrame) -> DataFrame:
    """Postings whose gram another set shows too; those of frequent grams all stay.

    Rows arrive by gram, part, size and hash; one row is carried over, never a tile.
    """
    names = ["gram", "part", "hash", "size"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, joined = tuple(np.zeros(0, k) for k in (np.int64, np.int32, np.int64, np.int64)), False  # the last row, and whether it met its like

        def emit(columns, keep):
            return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=names)

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            columns = [np.concatenate(x) for x in zip(held, new)]
            gram, part, hash_, _ = columns
            tile = np.zeros(len(gram), bool)  # the same as in the row before
            tile[1:] = (gram[1:] == gram[:-1]) & (part[1:] == part[:-1])
            copy = tile.copy()
            copy[1:] &= hash_[1:] == hash_[:-1]
            # what a copy of the carried row repeats is its own meeting with its like
            columns = [c[~copy] for c in columns]
            gram, part = columns[:2]
            if not len(gram):
                continue
            same = np.zeros(len(gram) + 1, bool)
            same[1:-1] = (gram[1:] == gram[:-1]) & (part[1:] == part[:-1])
            same[0] = joined
            keep = same[:-1] | same[1:] | (part >= 0)
            keep[-1] = False  # waits for the row after it
            yield emit(columns, keep)
            held, joined = tuple(c[-1:] for c in columns), bool(same[-2])
        if len(held[0]) and (joined or held[1][0] >= 0):
            yield emit(held, np.ones(1, bool))

    ordered = postings.repartition("gram", "part").sortWithinPartitions("gram", "part", "size", "hash")
    return ordered.mapInArrow(scan, "gram long, part int, hash long, size long")


def _with_gram_before(shared: DataFrame) -> DataFrame:
    """Adds ``before``: the shared gram that the set shows just before this one, 0 where there is none.

    Two sets with the same one meet in that gram's tile too, with the same bounds or wider
    ones, so they need not be paired here again.
    """
    shown = Window.partitionBy("hash").orderBy(F.col("size").desc(), "gram")
    return shared.withColumn("before", F.coalesce(F.lag("gram").over(shown), F.lit(0)))


# ---- comparing and verifying ------------------------------------------------


@F.arrow_udf(T.IntegerType())
def _differing(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([differing(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


@F.arrow_udf(T.BinaryType())
def _folded(bits: pa.Array) -> pa.Array:
    return pa.array([fold(x, min(len(x), TILE_BITS // 8)).tobytes() for x in bits.to_pylist()], pa.binary())


@F.arrow_udf(T.BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(
        [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a.to_pylist(), b.to_pylist())],
        pa.bool_(),
    )


def _verify(pairs: DataFrame, documents: DataFrame, sets: DataFrame) -> DataFrame:
    """Of (a, b) set hashes those that link, as representatives (u, v); stored."""
    spark = documents.sparkSession
    stored = _stored(pairs, "pairs")
    if stored.isEmpty():
        return spark.createDataFrame([], "u long, v long")
    needed = stored.select(F.col("a").alias("hash")).union(stored.select("b")).distinct()
    holders = _stored(sets.join(needed, "hash").select("rep").distinct(), "holders")
    texts = _narrow(documents).join(holders, F.col("doc_id") == F.col("rep"), "left_semi")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = gram_sets(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(g) for g in found], pa.int64()), pa.array([g.tobytes() for g in found], pa.binary())],
                names=["hash", "grams"],
            )
        release_memory()

    held = _stored(texts.select("text").mapInArrow(arrays, "hash long, grams binary").dropDuplicates(["hash"]), "arrays")
    first = held.select(F.col("hash").alias("a"), F.col("grams").alias("ga"))
    second = held.select(F.col("hash").alias("b"), F.col("grams").alias("gb"))
    links = stored.join(first, "a").join(second, "b").where(_linked("ga", "gb")).select("a", "b")
    u = sets.select(F.col("hash").alias("a"), F.col("rep").alias("u"))
    v = sets.select(F.col("hash").alias("b"), F.col("rep").alias("v"))
    found = _stored(links.join(u, "a").join(v, "b").select("u", "v").where(F.col("u") != F.col("v")), "links")
    _dropped(stored, holders, held)
    return found


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, and safe from lost executors."""
    path = work_path(df.sparkSession, f"jaccard-{name}")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def _replaced(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``new`` stored, after which ``old``, that it was made from, is deleted."""
    stored = _stored(new, name)
    _dropped(old)
    return stored


def _dropped(*stored: DataFrame) -> None:
    """Deletes the folders of stored tables that nothing reads any more."""
    for df in stored:
        discard(df.sparkSession, df.stored_at)


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full bitmaps leave a link open."""
    a = sets.select(F.col("hash").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    b = sets.select(F.col("hash").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    met = pairs.distinct().join(a, "a").join(b, "b")
    most = (F.col("na") + F.col("nb") - _differing("bits_a", "bits_b")) / 2
    return met.where(7 * most >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def _first_partners(shared: DataFrame, named: DataFrame, turn: int) -> DataFrame:
    """Per set and tile one pair, the first of another component that sizes and bitmaps leave open.

    ``named`` is (hash, label, bits) of the sets that take part. Sets of one size stand in
    another order each ``turn``, so that they meet other partners.
    """
    met = shared.join(named, "hash").select(
        "gram", F.col("part").alias("low"), F.col("part").alias("high"), "size", "hash", F.lit(0).alias("own"), "label", "before", "bits"
    )
    return _compared(met, first_only=True, turn=turn)


def _all_pairs(shared: DataFrame, named: DataFrame) -> DataFrame:
    """All pairs of different components, from tiles, that sizes and bitmaps leave open."""
    rows = shared.join(named.select("hash", "label"), "hash").select("gram", "hash", "size", "label", "before")
    tiles = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("least"), F.max("label").alias("most"))
    open_ = tiles.where(F.col("least") < F.col("most")).select("gram", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    met = rows.join(open_, "gram").join(named.select("hash", "bits"), "hash")
    met = met.withColumn("own", F.pmod(F.xxhash64("hash"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "gram", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "size", "hash", "own", "label", "before", "bits"
    )
    return _compared(met, first_only=False)


def _compared(met: DataFrame, first_only: bool, turn: int = 0) -> DataFrame:
    """Pairs (a, b) of set hashes within the tiles (gram, low, high)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def run(table: pa.Table) -> pa.RecordBatch:
            gram, low, high, size, hash_, own, label, before = (np.asarray(table.column(i)).astype(np.int64) for i in range(8))
            begins = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
            several = np.minimum.reduceat(label, begins) < np.maximum.reduceat(label, begins)
            open_ = np.repeat(several, np.diff(np.append(begins, len(gram))))
            # tiles of one component are done
            gram, low, high, size, hash_, own, label, before = (c[open_] for c in (gram, low, high, size, hash_, own, label, before))
            bits = table.column(8).filter(pa.array(open_)).to_pylist()
            wide = np.array([len(x) for x in bits], np.int64)
            # at each width the bitmaps of all sets that have so many bits
            maps, w = {}, BITS // 8
            while w <= TILE_BITS // 8:
                have = np.flatnonzero(wide >= w)
                maps[w] = np.zeros((len(bits), w // 8), np.uint64)
                if len(have):
                    maps[w][have] = np.stack([fold(bits[i], w) for i in have.tolist()])
                w *= 2
            n = size >> 32
            found_a, found_b, done = [], [], np.zeros(len(gram), bool)
            here, k = np.arange(len(gram)), 1
            while len(here):
                here = here[here + k < len(gram)]
                there = here + k
                within = (gram[here] == gram[there]) & (low[here] == low[there]) & (high[here] == high[there])
                within &= 4 * n[here] >= 3 * n[there]  # sizes rise, so later ones are out as well
                here, there = here[within], there[within]
                tried = (label[here] != label[there]) & ((low[here] == high[here]) | (own[here] != own[there]))
                tried &= _open(size[here], size[there])
                fresh = (before[here] != before[there]) | (before[here] == 0)
                if not first_only:  # a set whose first partner it has met before is done here, so there it counts
                    tried &= fresh
                a, b, fresh = here[tried], there[tried], fresh[tried]
                widest = np.minimum(wide[a], wide[b])
                for w, held_bits in maps.items():
                    x, y, new = a[widest == w], b[widest == w], fresh[widest == w]
                    differing = np.bitwise_count(held_bits[x] ^ held_bits[y]).sum(1, dtype=np.int64)
                    both = n[x] + n[y]
                    left = 7 * (both - differing) >= 6 * both
                    found_a.append(hash_[x[left & new]])
                    found_b.append(hash_[y[left & new]])
                    if first_only:
                        done[x[left]] = True
                if first_only:
                    here = here[~done[here]]
                k += 1
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_a, found_b))
            pairs = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.column_stack([np.asarray(table.column(i)).astype(np.int64) for i in range(3)])
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            if len(ends):  # all tiles but the last are whole
                yield run(table.slice(0, ends[-1]))
                table = table.slice(ends[-1])
            held = table.to_batches()
        if held and sum(b.num_rows for b in held):
            yield run(pa.Table.from_batches(held).combine_chunks())
        del held
        release_memory()

    place = F.shiftright("size", 32), F.xxhash64("hash", F.lit(turn))
    dealt = met.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high", *place)
    return dealt.mapInArrow(compare, "a long, b long")


# ---- components -------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the smallest number that links (u, v) reach from every one in them."""
    spark = links.sparkSession
    both = links.select("u", "v").union(links.select("v", "u")).where(F.col("u") != F.col("v"))
    edges, moves = _stored(both.distinct(), "edges"), []
    while not moves or not edges.isEmpty():
        turn = F.lit(len(moves))
        near = edges.groupBy("u").agg(F.min(F.struct(F.xxhash64("v", turn).alias("h"), "v")).alias("near"))
        stays = F.xxhash64("u", turn) < F.col("near.h")
        moves.append(_stored(near.select(F.col("u").alias("node"), F.when(stays, F.col("u")).otherwise(F.col("near.v")).alias("to")), "moves"))
        of_u, of_v = (moves[-1].select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "uv")
        moved = edges.join(of_u, "u").select("v", "to_u").distinct().join(of_v, "v").select(F.col("to_u").alias("u"), F.col("to_v").alias("v"))
        edges = _replaced(edges, moved.where(F.col("u") != F.col("v")).distinct(), "edges")
    ends = moves.pop()
    while moves:
        after = ends.select(F.col("node").alias("to"), F.col("to").alias("end"))
        ends = moves.pop().join(after, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    ends = _stored(ends, "ends")
    least = ends.groupBy("to").agg(F.min("node").alias("label"))
    return ends.join(least, "to").select(F.col("node").alias("rep"), "label")


# ---- the operator -----------------------------------------------------------


def _same_document(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) from each ``doc_id`` with several sets to the representatives of those."""
    own = rows.where(F.col("doc_id").isNotNull()).select("doc_id", "n", "hash")
    several = own.groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where(F.col("low") < F.col("high"))
    met = own.where(F.col("n") > 0).join(several.select("doc_id"), "doc_id", "left_semi").join(sets.select("hash", "rep"), "hash")
    return met.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).where(F.col("u") != F.col("v")).distinct()


def jaccard_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    spark = documents.sparkSession
    bound_batches(spark)
    profile = _stored(_profile(documents), "profile")
    rows = profile.where(F.col("n").isNotNull())
    reported = profile.where(F.col("times").isNotNull()).groupBy("gram").agg(F.sum("times").alias("times"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, REPORT * (total // WINDOW))
    # grams this frequent are at most WINDOW / REPORT in number
    known = reported.where(F.col("times") >= least).toPandas().sort_values("gram", key=lambda g: g.to_numpy(np.int64).view(np.uint64))
    frequent = known["gram"].to_numpy(np.int64).view(np.uint64)
    parts = -(-known["times"].to_numpy(np.int64) // BLOCK).astype(np.uint64)
    sets = (
        rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("hash")
        .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("bits").alias("bits"))
    )
    sets = _stored(sets, "sets")
    maps = _stored(sets.select("hash", "rep", _folded("bits").alias("bits")), "maps")
    shared = _stored(_with_gram_before(_shared_postings(_postings(documents, frequent, parts))), "shared")
    same = _stored(_same_document(rows, sets), "same")
    labels = _stored(sets.select("rep").union(same.select("u")).distinct().withColumn("label", F.col("rep")), "labels")
    labels, grown = _contracted(labels, same)

    def named(of: DataFrame) -> DataFrame:
        return maps.join(of, "rep").select("hash", "label", "bits")

    active = labels
    for turn in itertools.count():
        links = _verify(_bounded(_first_partners(shared, named(active), turn), sets), documents, sets)
        labels, grown = _contracted(labels, links)
        if grown is None:
            break
        active = labels.join(grown, "label", "left_semi")
    labels, _ = _contracted(labels, _verify(_bounded(_all_pairs(shared, named(labels)), sets), documents, sets))
    _dropped(shared, maps)
    owners = _stored(sets.select("hash", "rep").join(labels, "rep").select(F.col("hash").alias("_hash"), F.col("label").alias("_label")), "named")
    filled = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    own = rows.where(filled).select("doc_id", "n", F.col("hash").alias("_hash")).join(owners, "_hash", "left")
    # rows without a set go with the other rows of their document
    others = rows.where(~filled).join(labels.select(F.col("rep").alias("doc_id"), F.col("label").alias("_label")), "doc_id", "left")
    both = own.select("doc_id", "n", "_label").unionByName(others.select("doc_id", "n", "_label"))
    return both.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("_label", "doc_id").alias("component_id"))


def _contracted(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Labels after links (u, v) between representatives, and the labels that grew, if any did."""
    of_u, of_v = (labels.select(F.col("rep").alias(c), F.col("label").alias(f"label_{c}")) for c in "uv")
    between = links.join(of_u, "u").join(of_v, "v").select(F.col("label_u").alias("u"), F.col("label_v").alias("v"))
    between = _stored(between.where(F.col("u") != F.col("v")).distinct(), "between")
    if between.isEmpty():
        return labels, None
    moved = _stored(components(between).select(F.col("rep").alias("label"), F.col("label").alias("new")), "moved")
    joined = labels.join(moved, "label", "left").select("rep", F.coalesce("new", "label").alias("label"))
    return _replaced(labels, joined, "labels"), moved.select(F.col("new").alias("label")).distinct()
