"""Operator 5: byte-pair encoding and decoding with a contiguous rank array.

The vocabulary file is that of a word-end BPE: text is NFC-normalised, white space
separates, letters are lowered, a pattern cuts words, and each word is merged from
the characters that stand for its UTF-8 bytes, the last one marked as word end.

A word's parts lie in one list and the ranks of adjacent parts in another. The
merge with the least rank (the leftmost of equals) is found by scanning the ranks,
the boundary is deleted from both lists and the two ranks beside it are looked up
again. Words longer than ``LONG_WORD`` parts use a heap in place of the scan, for
the same result in ``n log n``.

Defined cases: a null or empty text has no tokens and decodes to the empty string;
texts of any length are encoded whole; repeated rows are encoded alike; other
columns are kept, and those with an output's name are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import Memo, PieceEncoder, release_memory, replace_columns, tokenizer_path

LONG_WORD = 100
# Words remembered by each Python worker.
MEMO_ENTRIES = 50_000
NO_MERGE = 1 << 60


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(printable))
    shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [shown[b] for b in range(256)]


class WordBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # rank of a pair of ids, and by rank the id of the merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        shown = byte_characters()
        self.inner = [vocab.get(c) for c in shown]
        self.final = [vocab.get(c + self.end) for c in shown]
        self.words = regex.compile(
            next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in p)
            .replace(r"\s", r"\p{White_Space}")
        )
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.word_ids = Memo(self._merge_word, MEMO_ENTRIES)
        self.pieces = PieceEncoder(lambda pieces: list(map(self._encode_piece, pieces)), "<u4", limit=75_000)

    def _merge_word(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]] + [self.final[data[-1]]]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        rank = self.rank.get
        ranks = [rank(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NO_MERGE:
            at = ranks.index(least)
            ids[at] = self.merged[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), NO_MERGE)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), NO_MERGE)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (new := rank((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return tuple(i for i in ids if i >= 0)

    def _encode_piece(self, piece: str) -> bytes:
        ids: list[int] = []
        for part in self.specials.split(piece):
            if part in self.special:
                ids.append(self.special[part])
                continue
            text = unicodedata.normalize("NFC", part)
            # each letter by itself: the lower case of a whole string has a final sigma
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            for word in self.words.findall(text):
                ids.extend(self.word_ids[word])
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> list[int]:
        return self.pieces(pa.array([text]))[0].tolist()


class WordDecoder:
    """Texts of ids: their tokens, one blank between two."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        token_of = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.tokens = pa.array([token_of.get(i, "") for i in range(max(token_of) + 1)], pa.string())

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.tokens.take(pa.array(ids)))
        return pc.binary_join(tokens, " ")

    def decode(self, ids: list[int]) -> str:
        return self(np.array(ids, "<u4"), np.array([0, len(ids)]))[0].as_py()


@functools.lru_cache(maxsize=2)
def load_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@functools.lru_cache(maxsize=2)
def load_decoder(path: str) -> WordDecoder:
    return WordDecoder(path)


def encode_batch(bpe: WordBpe, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of a batch's texts and where each begins, for a bounded number of texts at a time."""
    for start in range(0, len(texts), PieceEncoder.SLICE):
        yield bpe.pieces(texts.slice(start, PieceEncoder.SLICE))


def _binary(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each text's ids as one value of bytes."""
    offsets = pa.py_buffer((at * 4).astype(np.int64))
    stored = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(ids))])
    return stored.cast(pa.binary())


def encode_text(df: DataFrame, text: str = "text", out: str = "token_ids", path: str | None = None) -> DataFrame:
    """Adds the ids of every text, as a binary of little-endian unsigned 32-bit integers."""
    path = path or tokenizer_path()

    @F.arrow_udf(T.BinaryType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load_bpe(path)
        for texts in batches:
            parts = [_binary(*coded) for coded in encode_batch(bpe, texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
        bpe.pieces.forget()
        release_memory()

    return replace_columns(df, {out: encode(F.coalesce(F.col(text).cast("string"), F.lit("")))})


def decode_ids(df: DataFrame, ids: str = "token_ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds the text of ids as ``encode_text`` gives them; null ids give the empty string."""
    path = path or tokenizer_path()

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = load_decoder(path)
        for batch in batches:
            out = []
            for start in range(0, len(batch), PieceEncoder.SLICE):
                some = batch.slice(start, PieceEncoder.SLICE).to_pylist()
                sizes = np.array([len(b) // 4 for b in some])
                ids = np.frombuffer(b"".join(some), "<u4")
                out.append(decoder(ids, np.cumsum([0, *sizes])).cast(pa.string()))
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())
        release_memory()

    return replace_columns(df, {out: decode(F.coalesce(F.col(ids), F.lit(b"")))})


_CODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())])


def code_text(df: DataFrame, text: str = "text", ids: str = "token_ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``encode_text`` and ``decode_ids`` in one go: one Python worker a task, and ids cross over once."""
    path = path or tokenizer_path()

    @F.arrow_udf(_CODED)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe, decoder = load_bpe(path), load_decoder(path)
        for texts in batches:
            coded = [(_binary(part, at), decoder(part, at).cast(pa.string())) for part, at in encode_batch(bpe, texts)]
            columns = [pa.concat_arrays(c) for c in zip(*coded)] or [pa.array([], pa.binary()), pa.array([], pa.string())]
            yield pa.StructArray.from_arrays(columns, names=["ids", "text"])
        bpe.pieces.forget()
        release_memory()

    both = df.withColumn("_coded", code(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return replace_columns(both, {ids: F.col("_coded.ids"), out: F.col("_coded.text")}).drop("_coded")


def bpe_digests(documents: DataFrame) -> DataFrame:
    """The query's columns, derived from the encoded and decoded documents."""
    return code_text(documents.select("doc_id", "text")).select(
        "doc_id",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
