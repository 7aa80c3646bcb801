"""Operators 11 to 13 against brute force, the tokenizer's library and odd rows."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricspark.llm import collocations as phrases
from metricspark.llm import conversations as talk
from metricspark.llm import prefixes
from metricspark.llm.common import tokenizer_path
from metricspark.llm.queries import QUERIES

# ---- 13: token counts


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_path(prefixes.PIECE_BPE))


@functools.cache
def counter():
    return prefixes.PrefixCounter(tokenizer_path(prefixes.PIECE_BPE))


ODD_TEXTS = [
    "", " ", "   ", "a", "a  b   c ", "▁a▁▁b", "a\nb\n\n c", "<s> </s> <0x0A> <unk>", "日本語😀\x00x", "x" * 3000,
    "aaaa" * 50 + " " * 70 + "b", " " * 5000, "\t\tif x:\n    return y", "\u2028 \ufeff\ue000", "ab" * 2000,
]


def test_whole_texts_have_the_library_s_count(pieces):
    assert counter().totals(pa.array(ODD_TEXTS)).tolist() == [len(pieces.encode(t)) for t in ODD_TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab e  \n▁the<s>é日😀_0123.,ing", max_size=40))
def test_every_prefix_has_the_library_s_count(text):
    from sentencepiece import SentencePieceProcessor

    pieces = _library(SentencePieceProcessor)
    assert counter().prefixes(text).tolist() == [len(pieces.encode(text[:n])) for n in range(len(text) + 1)]


@functools.cache
def _library(kind):
    return kind(model_file=tokenizer_path(prefixes.PIECE_BPE))


def test_forgetting_changes_nothing(monkeypatch, pieces):
    monkeypatch.setattr(prefixes, "MEMO_ENTRIES", 3)
    text = "forgetting what was counted only costs time, it never changes a count"
    assert prefixes.PrefixCounter(tokenizer_path(prefixes.PIECE_BPE)).prefixes(text)[-1] == len(pieces.encode(text))


def test_counts_of_the_whole_table(spark, sf_dir, pieces):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op13_token_counts"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(pieces.encode(texts[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)


def test_truncation_and_budgets_without_encoding_again(spark, pieces):
    texts = ["The quick brown fox, internationalization.", "", None, "日本 and more  blanks"]
    rows = spark.createDataFrame([(t, n) for t in texts for n in (-1, 0, 3, 7, 1000, None)], "text string, asked long")
    stored = prefixes.prefix_counts(rows)
    for r in stored.select(
        "text", "asked", prefixes.tokens_within(F.col("prefix_tokens"), F.col("asked")).alias("tokens"),
        prefixes.longest_within(F.col("prefix_tokens"), F.col("asked")).alias("chars"),
    ).collect():
        text = r.text or ""
        counts = [len(pieces.encode(text[:n])) for n in range(len(text) + 1)]
        if r.asked is None:
            assert r.tokens is None and r.chars is None
        else:
            assert r.tokens == len(pieces.encode(text[: max(r.asked, 0)]))
            assert r.chars == max(n for n, c in enumerate(counts) if c <= max(r.asked, 0))


def test_odd_documents_have_counts(spark, odd_documents, no_documents, pieces):
    got = prefixes.count_tokens(odd_documents, out="token_ids")
    assert [c for c in got.columns if c.lower() == "token_ids"] == ["token_ids"] and "Score" in got.columns
    assert all(r.token_ids == len(pieces.encode(r.text or "")) for r in got.collect())
    assert got.count() == 12
    assert prefixes.token_counts_result(no_documents).count() == 0


# ---- 12: collocations


def brute_phrases(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    known = {k: n for k, n in counts.items() if n >= least}
    out = {}
    for (lang, words), a in known.items():
        if len(words) == 1:
            continue
        cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        hidden = any(
            other == lang and len(longer) > len(words) and 100 * f >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), f in known.items()
        )
        if not hidden:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["new", "York", "CITY", "of", "the", "Œuvre", "b\x00", "𝒳", "é"]
    rows = [
        (rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", "\n", " "]) for _ in range(rng.randint(0, 60))))
        for _ in range(60)
    ]
    return [*rows, *rows[:9], ("en", None), (None, ""), ("de", " \t\n"), ("en", "the city " * 400)]


@pytest.mark.parametrize("block", [4 << 20, 64])
def test_collocations_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK", block)
    rows = phrase_rows(5)
    table = spark.createDataFrame([(la, t, 1, "x") for la, t in rows], "lang string, text string, n int, phrase string").coalesce(2)
    got = phrases.collocations(table, least=4, top=25).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, 4, 25)


def test_colliding_fingerprints_are_told_apart_by_text(spark, monkeypatch):
    """With fingerprints of three bits nearly all phrases collide, and no count changes."""
    rows = phrase_rows(6)[:30]
    table = spark.createDataFrame(rows, "lang string, text string")
    texts = phrases._texts(table)
    all_bits = [np.full(1 << (phrases.MAP_BITS - 6), np.uint64(2**64 - 1))] * 3
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in texts.collect()])
    want = {tuple(r) for r in phrases.phrase_counts(texts, all_bits).collect()}
    strong, found = phrases.Block.grams, Counter()
    monkeypatch.setattr(phrases.Block, "grams", lambda self, size: (strong(self, size)[0], strong(self, size)[1] & np.uint64(7)))
    for part in phrases.phrase_batches(iter([batch]), all_bits):
        for r in part.to_pylist():
            found[r["lang"], r["size"], r["phrase"]] += r["n"]
    assert {(*k, n) for k, n in found.items()} == want


@pytest.mark.parametrize("held, range_prints", [(1, 1), (50, 4), (1 << 21, 1 << 20)])
def test_maps_hold_all_that_is_frequent(spark, monkeypatch, held, range_prints):
    """However the fingerprints are sent and added up; counts beyond a byte do not wrap."""
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "RANGE_PRINTS", range_prints)
    rows = [*phrase_rows(7), ("en", "one two three " * 700)]
    texts = phrases._texts(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in texts.collect()])
    for least in (5, 300):
        got = phrases.frequent_map(texts, range(1, 2), phrases._range_bits(texts), least=least)
        prints = np.concatenate([b.grams(1)[1] for b, _, _ in phrases.blocks(batch)])
        known, times = np.unique(prints, return_counts=True)
        assert phrases.holds(got, known).tolist() == (times >= least).tolist()


def test_no_documents_have_no_collocations(spark, no_documents, odd_documents):
    assert phrases.collocations(no_documents).count() == 0
    assert {r.lang for r in phrases.collocations(odd_documents, least=5, top=3).collect()} == {"la"}


# ---- 11: conversations


def brute_repair(rows):
    """Cheapest edits by trying all; rows are (role, text, fault)."""
    best = None
    roles = {"u": "user", "a": "assistant"}

    def walk(i, lines, initials, cost, audit):
        nonlocal best
        for k in range(3):
            for inserted in itertools.product("ua", repeat=k):
                now = initials + "".join(inserted)
                price = cost + 2 * k
                if not re.match("(s?(ua)*u?)?$", now) or (best is not None and price > best[0]):
                    continue
                some, letters = lines + [f"{roles[x]}:" for x in inserted], audit + "I" * k
                if i == len(rows):
                    if re.fullmatch("(s?(ua)+)?", now) and (best is None or (price, letters) < best[:2]):
                        best = price, letters, "\n".join(some)
                    continue
                role, text, fault = rows[i]
                walk(i + 1, some, now, price + 3, letters + "D")
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    for given in roles.values():
                        walk(i + 1, [*some, f"{given}:{text}"], now + given[0], price + 2 + more, letters + "R")
                    if role:
                        walk(i + 1, [*some, f"{role}:{text}"], now + role[0], price + more, letters + "K")

    walk(0, [], "", 0, "")
    return best


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_conversation(rows):
    """``rows`` of one conversation: (conv_id, turn, role, text)."""
    kept = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        kept += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marked = faults_of([r[1:] for r in kept])
    turns = {r[0] for r in kept} - {None}
    count = Counter(f for *_, f in marked)
    cost, audit, text = brute_repair(marked)
    initials = [r[1][:1] for r in kept]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_repairs_equal_trying_all_edits(monkeypatch, segment):
    monkeypatch.setattr(talk, "SEGMENT_ROWS", segment)
    rng, steps = random.Random(segment), talk.Steps()
    for _ in range(150):
        rows = faults_of([(rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", " "]), rng.choice(["a.", "b.", "c", "", "d!", "e?\n", " "])) for _ in range(rng.randint(0, 6))])
        repair = talk.Repair(steps)
        for turn, (role, text, fault) in enumerate(rows):
            repair.add(turn, role, text, fault == "duplicate")
        cost, audit, text = brute_repair(rows)
        assert repair.result()[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())


def test_conversations_of_odd_rows_equal_brute_force(spark):
    rng, rows = random.Random(11), []
    for conv in [*range(60), None, 2**60 + 1]:
        for _ in range(rng.randint(1, 5)):
            rows.append((conv, rng.choice([0, 1, 2, 3, 7, None]), rng.choice(["user", "assistant", "system", None, "", "Über"]), rng.choice(["Yes.", "no", None, "", " ", "Why?  ", "日本。"])))
    rows += rows[:20]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, COST int, audit string")
    got = {r.conv_id: tuple(r)[1:] for r in talk.conversation_result(table.repartition(3)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == brute_conversation([r for r in rows if r[0] == conv]), conv


def test_a_conversation_without_rows_left_has_zeros(spark):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "Hello.")], "conv_id int, turn int, role string, text string")
    assert tuple(talk.conversation_result(table).first()) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert talk.conversation_result(table.limit(0)).count() == 0


def test_a_giant_conversation_is_a_stream(spark, monkeypatch):
    """Many batches and segments; roles that leave both phases open to the end; the steps stay few."""
    monkeypatch.setattr(talk, "SEGMENT_ROWS", 100)
    repair = talk.Repair(steps := talk.Steps())
    for turn in range(20_000):
        repair.add(turn, "tool", f"text {turn}.", False)
        assert len(repair._segment) <= 100
    gaps, *_, cost, audit, _ = repair.result()
    assert (gaps, cost, audit) == (0, 40_000, "R" * 20_000) and len(steps.back) < 50
    table = spark.range(5_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("tool").alias("role"), F.lit("Same.").alias("text"))
    row = talk.conversation_result(table).first()
    assert 4_000 < row.duplicate + row.blank <= row.audit.count("D") and len(row.audit.replace("I", "")) == 4_985


def test_the_whole_conversation_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(tuple(r))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversations"](spark, sf_dir).collect()}
    assert set(got) == set(by)
    for conv, found in got.items():
        if len(by[conv]) <= 5:
            assert found == brute_conversation(by[conv])
