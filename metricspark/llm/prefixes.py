"""Operator 13: exact token counts of every prefix by dynamic programming.

The vocabulary is a sentencepiece BPE model with byte fallback: a blank is put before
the text, blanks become ``▁``, and adjacent parts whose concatenation is a piece are
merged, the best score first, the leftmost of equals. Characters outside the
vocabulary never merge and count one token for each UTF-8 byte.

In such an encoding every two neighbouring tokens are what the two alone would give,
and a row of tokens with that property is the encoding. So the last token of a
prefix is the one piece that ends there and agrees with the last token of the prefix
before it; its count is that prefix's count and one. One pass over the text gives the
exact count of every prefix, where counting each anew takes a pass a prefix. No piece
holds ``▁`` after another character, so the pass starts anew at each run of blanks
and the states of a word's prefixes are shared by all words that begin alike.

``count_tokens`` gives the count of whole texts. ``prefix_counts`` stores the counts of
all prefixes (in code points) of a text as one compressed binary, from which
``tokens_within`` reads the count of a first part and ``longest_within`` the longest
first part of at most so many tokens, without encoding anything again. Counts can
fall when a character is added, so "longest" means the last place that fits.

Defined cases: a null or empty text has no tokens and one prefix, the empty one; texts
of any length are counted whole, in time and memory linear in the text; control
strings in a text are ordinary text; repeated rows are counted alike; other columns are
kept, and those with an output's name are replaced; a null length or budget gives
null, one below zero the empty prefix.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import Memo, replace_columns, tokenizer_path

PIECE_BPE = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
BLANK = "▁"
# Words longer than this are counted place by place, without remembering their prefixes.
LONG_WORD = 48
# Prefixes, words and pairs of tokens remembered by each Python worker.
MEMO_ENTRIES = 150_000
# Texts counted at a time.
SLICE = 1_000


class PrefixCounter:
    """Counts the tokens of all prefixes for one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        own = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
        self.score = {model.id_to_piece(i): model.get_score(i) for i in own}
        self.longest = max(map(len, self.score))
        # pieces that their own characters merge to; no other one is ever a token
        self.whole = {piece for piece in self.score if self._merged(piece) == [piece]}
        self.agree = Memo(lambda pair: self._merged(pair[0] + pair[1]) == list(pair), MEMO_ENTRIES)
        self.states: dict[str, tuple[str, int]] = {}
        self.words = Memo(self._count, MEMO_ENTRIES)

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while True:
            scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [s for s in scores if s is not None]
            if not known:
                return parts
            at = scores.index(max(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _last(self, text: str, end: int, before) -> tuple[str, int]:
        """The last token of ``text[:end]`` and its count; ``before(i)`` gives those of ``text[:i]``."""
        for start in range(max(0, end - self.longest), end):
            token = text[start:end]
            if end - start > 1 and token not in self.whole:
                continue
            last, count = before(start) if start else ("", 0)
            if not last or self.agree[last, token]:
                return token, count + (1 if token in self.score else len(token.encode("utf-8", "surrogatepass")))
        raise AssertionError("a single character always agrees with some token before it")

    def _state(self, prefix: str) -> tuple[str, int]:
        known = self.states.get(prefix)
        if known is None:
            known = self._last(prefix, len(prefix), lambda start: self._state(prefix[:start]))
            if len(self.states) >= MEMO_ENTRIES:
                self.states.clear()
            self.states[prefix] = known
        return known

    def _walk(self, word: str) -> list[int]:
        """Counts of the prefixes of 1, 2, ... characters of one word."""
        if len(word) <= LONG_WORD:
            return [self._state(word[:end])[1] for end in range(1, len(word) + 1)]
        known: list[tuple[str, int]] = [("", 0)]
        for end in range(1, len(word) + 1):
            known.append(self._last(word, end, known.__getitem__))
        return [count for _, count in known[1:]]

    def _count(self, word: str) -> int:
        word = word.replace(" ", BLANK)
        if len(word) <= LONG_WORD:
            return self._state(word)[1] if word else 0
        return self._walk(word)[-1]

    def prefixes(self, text: str) -> np.ndarray:
        """Counts of ``text[:0]``, ``text[:1]``, ..., the whole text."""
        counts, total = [0], 0
        # the blank put before the text belongs to its first character
        for word in re.findall(" +[^ ]*", f" {text}".replace(BLANK, " ") if text else ""):
            part = self._walk(word.replace(" ", BLANK))
            counts += [total + c for c in part]
            total += part[-1]
        return np.array([0, *counts[2:]], dtype=np.int32)

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Counts of whole texts without nulls: each distinct word of the batch once."""
        shown = pc.binary_join_element_wise(" ", pc.replace_substring(texts, BLANK, " "), "")
        # line feeds are outside the vocabulary: they merge with nothing and count one byte
        counts = np.asarray(pc.count_substring(shown, "\n")).astype(np.int64)
        runs = np.asarray(pc.match_substring(shown, "  "))
        for some, cut in (
            (~runs, lambda t: pc.replace_substring(t, " ", "\n ")),
            (runs, lambda t: pc.replace_substring_regex(t, "( +)", "\n\\1")),
        ):
            if not some.any():
                continue
            words = pc.split_pattern(cut(shown.filter(pa.array(some))), "\n")
            coded = words.flatten().dictionary_encode()
            known = np.array([self.words[w] for w in coded.dictionary.to_pylist()], dtype=np.int64)
            sums = np.concatenate(([0], np.cumsum(known[np.asarray(coded.indices)])))
            at = np.asarray(words.offsets) - words.offsets[0].as_py()
            counts[some] += np.diff(sums[at])
        counts[np.asarray(pc.equal(pc.binary_length(texts), 0))] = 0
        return counts


@functools.lru_cache(maxsize=1)
def load_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _texts(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Adds the exact number of tokens of every whole text."""
    path = path or tokenizer_path(PIECE_BPE)

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        counter = load_counter(path)
        parts = [counter.totals(texts.slice(start, SLICE)) for start in range(0, len(texts), SLICE)]
        return pa.array(np.concatenate(parts) if parts else [], pa.int64())

    return replace_columns(df, {out: count(_texts(text))})


def prefix_counts(df: DataFrame, text: str = "text", out: str = "prefix_tokens", path: str | None = None) -> DataFrame:
    """Adds the counts of all prefixes of every text: steps from one to the next, compressed."""
    path = path or tokenizer_path(PIECE_BPE)

    @F.arrow_udf(T.BinaryType())
    def store(texts: pa.Array) -> pa.Array:
        counter = load_counter(path)
        steps = (np.diff(counter.prefixes(t.as_py())).astype("<i4") for t in texts)
        return pa.array([zlib.compress(s.tobytes(), 1) for s in steps], pa.binary())

    return replace_columns(df, {out: store(_texts(text))})


def read_counts(stored: bytes) -> np.ndarray:
    """The counts of the prefixes of 0, 1, 2, ... code points."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(zlib.decompress(stored), "<i4"))))


def _answer(stored: Column, asked: Column, reply) -> Column:
    @F.arrow_udf(T.LongType())
    def ask(rows: pa.Array, values: pa.Array) -> pa.Array:
        return pa.array(
            [None if r is None or v is None else int(reply(read_counts(r), v)) for r, v in zip(rows.to_pylist(), values.to_pylist())],
            pa.int64(),
        )

    return ask(stored, asked.cast("long"))


def tokens_within(stored: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points; of the whole text, if it has no more."""
    return _answer(stored, n_chars, lambda counts, n: counts[min(max(n, 0), len(counts) - 1)])


def longest_within(stored: Column, budget: Column) -> Column:
    """Code points of the longest first part that has at most ``budget`` tokens."""
    return _answer(stored, budget, lambda counts, most: np.flatnonzero(counts <= max(most, 0))[-1])


def token_counts_result(documents: DataFrame) -> DataFrame:
    """The query's columns."""
    counted = count_tokens(documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    return counted.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )
