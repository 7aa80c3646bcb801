"""Operator 1: token ids in one wavelet-matrix file per shard.

A shard holds the ids of consecutive documents as bit planes, highest bit first.
Each plane is cut into blocks that are compressed on their own, with the number of
set bits before every block, so that access, counting and the search for
occurrences read a few blocks of one file (``WaveletFile``); reading all ids back
turns the planes into the sequence again.

Documents are sorted by ``doc_id`` through range partitions; a task closes a shard
at a document's end once it holds ``SHARD_TOKENS`` ids, so memory is bounded by that
and the longest document. Files are written under a name of the task's attempt and
listed in a manifest, which holds finished attempts only: a lost executor's files
are never read.

File: ``WMX1``, length of the JSON head, the head (ids, bits, documents, per plane
its zeros, block offsets and ranks, and the place of the document table), blocks.

Defined cases: null or empty texts give a document that holds the end id only; a
null ``doc_id`` sorts first; rows with equal ids keep one another's order by text;
an empty table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricspark.llm.common import Memo, PieceEncoder, bound_batches, release_memory, tokenizer_path
from metricspark.session import work_path

MAGIC = b"WMX1"
END_ID = 2
SHARD_TOKENS = 1 << 21
BLOCK_BITS = 1 << 16
SUB_WORDS = 8  # 64-bit words between two counts
REMEMBERED, REMEMBERED_WORDS = 150_000, 250_000  # pieces and words of a generation
JOINED = 64  # words that the library gets as one text
# Latin letters, each lowered to one letter, and marks behind them: no apostrophe, as the library's
# pattern looks for some letters after it, and nothing that a special token begins or ends with
WORD_AND_MARKS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")
GROUP_ROWS, GROUP_BYTES = 8_000, 32 << 20  # of texts encoded together

MANIFEST = "first_doc long, part int, seq int, path string, n_docs long, n_tokens long"
PER_DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


# ---- the file ---------------------------------------------------------------


def build_shard(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> bytes:
    """The bytes of a shard; ``ids`` are those of all its documents."""
    top = int(ids.max()) if len(ids) else 0
    bits = max(1, top.bit_length())
    squeeze = zstandard.ZstdCompressor(level=1)
    body, planes, at = io.BytesIO(), [], 0
    row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for shift in range(bits - 1, -1, -1):
        if shift == 7:  # the bits above are written
            row = row.astype(np.uint8)
        ones = (row & row.dtype.type(1 << shift)) != 0
        packed = np.packbits(ones, bitorder="little").tobytes()
        offsets, ranks, seen = [], [], 0
        for start in range(0, len(packed), BLOCK_BITS // 8):
            block = packed[start : start + BLOCK_BITS // 8]
            offsets.append(at)
            ranks.append(seen)
            seen += int(np.bitwise_count(np.frombuffer(block, np.uint8)).sum(dtype=np.int64))
            at += body.write(squeeze.compress(block))
        planes.append({"zeros": len(row) - seen, "offsets": [*offsets, at], "ranks": ranks})
        if shift:
            row = np.concatenate([row.take(np.flatnonzero(~ones)), row.take(np.flatnonzero(ones))])
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    docs = b"".join(
        (known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), lengths.astype("<i8").tobytes())
    )
    docs = squeeze.compress(docs)
    body.write(docs)
    head = json.dumps(
        {"n": len(ids), "bits": bits, "docs": len(doc_ids), "planes": planes, "table": [at, len(docs)]}
    ).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + body.getvalue()


class WaveletFile:
    """Random access to a shard through any seekable binary file."""

    def __init__(self, file):
        self.file = file
        if file.read(4) != MAGIC:
            raise ValueError("not a wavelet-matrix shard")
        (size,) = struct.unpack("<I", file.read(4))
        self.head = json.loads(file.read(size))
        self.base = 8 + size
        self.n, self.bits = self.head["n"], self.head["bits"]
        self.planes = self.head["planes"]
        self.blocks = Memo(self._load, 64)

    def _read(self, start: int, size: int) -> bytes:
        self.file.seek(self.base + start)
        return zstandard.ZstdDecompressor().decompress(self.file.read(size))

    def _load(self, key: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """A block's 64-bit words, and the set bits before every ``SUB_WORDS`` of them."""
        level, block = key
        offsets = self.planes[level]["offsets"]
        raw = self._read(offsets[block], offsets[block + 1] - offsets[block])
        words = np.frombuffer(raw + bytes(-len(raw) % 8), "<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return words, np.concatenate(([0], np.cumsum(np.add.reduceat(counts, np.arange(0, len(words), SUB_WORDS)))))

    def _bit(self, level: int, i: int) -> int:
        block, rest = divmod(i, BLOCK_BITS)
        return int(self.blocks[level, block][0][rest >> 6]) >> (rest & 63) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Set bits before position ``i`` of a plane: sums by block and sub-block, then at most ``SUB_WORDS`` words."""
        if i >= self.n:
            return self.n - self.planes[level]["zeros"]
        block, rest = divmod(i, BLOCK_BITS)
        before = self.planes[level]["ranks"][block]
        if not rest:
            return before
        words, counts = self.blocks[level, block]
        word, bits = divmod(rest, 64)
        sub = word // SUB_WORDS
        full = int(np.bitwise_count(words[sub * SUB_WORDS : word]).sum(dtype=np.int64))
        return before + int(counts[sub]) + full + (int(words[word]) & (1 << bits) - 1).bit_count()

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of that value in a plane."""
        ranks = self.planes[level]["ranks"]
        block = bisect.bisect_right(range(len(ranks)), k, key=lambda b: ranks[b] if bit else b * BLOCK_BITS - ranks[b]) - 1
        k -= ranks[block] if bit else block * BLOCK_BITS - ranks[block]
        words, counts = self.blocks[level, block]
        sub = bisect.bisect_right(range(len(counts)), k, key=lambda s: int(counts[s]) if bit else s * SUB_WORDS * 64 - int(counts[s])) - 1
        sub = min(sub, len(counts) - 2)
        k -= int(counts[sub]) if bit else sub * SUB_WORDS * 64 - int(counts[sub])
        raw = words[sub * SUB_WORDS : (sub + 1) * SUB_WORDS].tobytes()
        places = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little") == bit)
        return block * BLOCK_BITS + sub * SUB_WORDS * 64 + int(places[k])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            token = token << 1 | bit
            i = self.planes[level]["zeros"] + ones if bit else i - ones
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            ones = self._rank1(level, low), self._rank1(level, high)
            if token >> (self.bits - 1 - level) & 1:
                low, high = (self.planes[level]["zeros"] + x for x in ones)
            else:
                low, high = low - ones[0], high - ones[1]
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often the id occurs at positions ``low`` to ``high`` (exclusive)."""
        start, end = self._range(token, low, self.n if high is None else high)
        return end - start

    def occurrence(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of the id."""
        start, end = self._range(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = start + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select(level, bit, at - self.planes[level]["zeros"] if bit else at)
        return at

    def documents(self) -> tuple[list, np.ndarray]:
        """Ids of the documents (null as None), and their lengths in ids."""
        n = self.head["docs"]
        raw = self._read(*self.head["table"])
        known = np.frombuffer(raw, np.uint8, n)
        ids, lengths = np.frombuffer(raw, "<i8", 2 * n, n).reshape(2, n)
        return [int(d) if k else None for k, d in zip(known, ids)], lengths

    def read_all(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        row = np.zeros(self.n, np.uint8)
        for level in range(self.bits - 1, -1, -1):
            shift = self.bits - 1 - level
            if shift in (8, 16):  # the next bits need wider numbers
                row = row.astype(np.uint16 if shift == 8 else np.uint32)
            offsets = self.planes[level]["offsets"]
            self.file.seek(self.base + offsets[0])
            raw, unpack = self.file.read(offsets[-1] - offsets[0]), zstandard.ZstdDecompressor()
            packed = b"".join(
                unpack.decompress(raw[a - offsets[0] : b - offsets[0]]) for a, b in zip(offsets, offsets[1:])
            )
            ones = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            zeros = self.planes[level]["zeros"]
            up = np.empty_like(row)
            up[np.flatnonzero(~ones)] = row[:zeros]
            up[np.flatnonzero(ones)] = row[zeros:] | row.dtype.type(1 << shift)
            row = up
        return row


# ---- encoding with the tokenizers library -----------------------------------


class LibraryEncoder:
    """Ids by the tokenizers library, each distinct piece between blanks encoded once.

    Blanks and line feeds are dropped by this vocabulary's normaliser and never lie
    within a token, so the library's ids of a text are those of its pieces. The
    vocabulary has fewer than 65,536 ids, so 16 bits hold one.

    Its pattern cuts letters from marks, its normaliser lowers letters, and a run of letters
    has one id with the word-end suffix, its last. So a piece of Latin letters and marks has
    the ids of both, each distinct word is encoded once, and the library gets many words as
    one text, whose ids are cut after those with the suffix. Other pieces are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = PieceEncoder(self._encode, "<u2", limit=REMEMBERED)
        self.words = PieceEncoder(self._encode_words, "<u2", limit=REMEMBERED_WORDS)
        self.marks = Memo(lambda marks: self._encode_each([marks])[0], 10_000)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of all texts, and how many each has."""
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), "<u2"), list(map(len, coded))

    @staticmethod
    def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw, places = ids.tobytes(), (2 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *places], places)]

    def _encode_each(self, pieces: list[str]) -> list[bytes]:
        ids, sizes = self._ids(pieces)
        return self._cut(ids, np.cumsum(sizes))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        ids, _ = self._ids([" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # another vocabulary's pattern: each word has one at least
            return self._encode_each(words)
        return self._cut(ids, ends)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        words, marks, places, others = [], [], [], []
        for i, piece in enumerate(pieces):
            found = WORD_AND_MARKS.fullmatch(piece)
            if found:
                words.append(found[1].lower())
                marks.append(found[2])
                places.append(i)
            else:
                others.append(i)
        distinct = list(dict.fromkeys(words))
        known = dict(zip(distinct, self.words.look(distinct)))
        for i, word, mark in zip(places, words, marks):
            out[i] = known[word] + self.marks[mark] if mark else known[word]
        for i, ids in zip(others, self._encode_each([pieces[i] for i in others])):
            out[i] = ids
        return out


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


# ---- writing and reading shards ---------------------------------------------


def open_folder(url: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder given as URL or plain path."""
    return pafs.FileSystem.from_uri(url if ":" in url.split("/")[0] else f"file://{url}")


def write_shards(documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards and returns the manifest, itself stored in ``folder``."""
    bound_batches(documents.sparkSession)
    path = path or tokenizer_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex[:12]
        encoder = library_encoder(path)
        end = np.array([end_id], "<u2").tobytes()
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        seq, doc_ids, ids, size = 0, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal seq, doc_ids, ids, size
            data = np.frombuffer(b"".join(ids), "<u2")
            lengths = np.array([len(x) // 2 for x in ids], np.int64)
            name = f"shard-{part:06d}-{seq:05d}-{attempt}.wmx"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(build_shard(data, doc_ids, lengths))
            row = [[doc_ids[0]], [part], [seq], [f"{folder}/{name}"], [len(doc_ids)], [len(data)]]
            seq, doc_ids, ids, size = seq + 1, [], [], 0
            types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)],
                names=["first_doc", "part", "seq", "path", "n_docs", "n_tokens"],
            )

        def grouped() -> Iterator[pa.Table]:
            """Batches put together, so that a piece is looked up once for many texts."""
            some, rows, held = [], 0, 0
            for batch in batches:
                some.append(batch)
                rows, held = rows + batch.num_rows, held + batch.nbytes
                if rows >= GROUP_ROWS or held >= GROUP_BYTES:
                    yield pa.Table.from_batches(some).combine_chunks()
                    some, rows, held = [], 0, 0
            if some:
                yield pa.Table.from_batches(some).combine_chunks()

        for group in grouped():
            texts = group.column(1).combine_chunks().fill_null("")
            coded, at = encoder.pieces(texts)
            for doc_id, a, b in zip(group.column(0).to_pylist(), at, at[1:]):
                doc_ids.append(doc_id)
                ids.append(coded[a:b].tobytes() + end)
                size += len(ids[-1]) // 2
                if size >= shard_tokens:
                    yield close()
        if doc_ids:
            yield close()
        release_memory()

    narrow = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return documents.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, in the order of the files: doc_id, start, n_tokens, ids_crc32."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one row per file, a few numbers each
    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, base in zip(*(batch.column(c).to_pylist() for c in ("path", "base"))):
                files, name = open_folder(place)
                with files.open_input_file(name) as file:
                    shard = WaveletFile(file)
                    doc_ids, lengths = shard.documents()
                    ids = shard.read_all().astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(base + starts),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # a fixed number of tasks: these small rows stand for large files
    return based.select("path", "base").repartition(tasks, "path").mapInArrow(read, PER_DOCUMENT)


def _dealt_shards(spark: SparkSession, folder: str) -> DataFrame:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("path").repartition(tasks, "path")


def token_counts(spark: SparkSession, folder: str, tokens: Sequence[int]) -> DataFrame:
    """(token, n): how often each id occurs in all shards, from a few blocks of every plane."""
    wanted = sorted(set(tokens))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                files, name = open_folder(place)
                with files.open_input_file(name) as file:
                    shard = WaveletFile(file)
                    found = [shard.count(t) for t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(found, pa.int64())], names=["token", "n"])

    asked = spark.createDataFrame([(t,) for t in wanted], "token long")
    counted = _dealt_shards(spark, folder).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return asked.join(counted, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def token_places(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of an id, by its place among the document's ids."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = open_folder(path)
                with files.open_input_file(name) as file:
                    shard = WaveletFile(file)
                    doc_ids, lengths = shard.documents()
                    ends, n = np.cumsum(lengths), shard.count(token)
                    for start in range(0, n, 10_000):
                        at = np.array([shard.occurrence(token, k) for k in range(start, min(n, start + 10_000))], np.int64)
                        doc = np.searchsorted(ends, at, side="right")
                        places = at - (ends[doc] - lengths[doc])
                        ids = pa.array(doc_ids, pa.int64()).take(pa.array(doc))
                        yield pa.RecordBatch.from_arrays([ids, pa.array(places)], names=["doc_id", "place"])

    return _dealt_shards(spark, folder).mapInArrow(find, "doc_id long, place long")


def wavelet_result(documents: DataFrame) -> DataFrame:
    spark = documents.sparkSession
    folder = work_path(spark, "wavelet")
    write_shards(documents, folder)
    return read_shards(spark, folder)
