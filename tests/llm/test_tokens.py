"""Operators 1 and 5: against the tokenizers library, and exact round trips."""

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from metricspark.llm import bpe
from metricspark.llm.common import tokenizer_path
from metricspark.llm.queries import QUERIES
from metricspark.llm.wavelet import WaveletFile, build_shard, wavelet_result

ODD = [
    "", "  ", "\t\n", "á é", "ΣΑΣ ς", "<|endoftext|>x<|startoftext|>", "a<|endoftext|> b", "don't I'LL we're 'S",
    "x" * 5000, "ab" * 3000 + "!", "nb sp\x1cfs\x85nel", "日本語テキスト 123४५", "👩‍👩‍👧 emoji", "ﬁ ½ ² ǅ", "\x00 control", "ệ 각",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"] or "") for r in found]


@pytest.mark.parametrize("text", ODD)
def test_encoder_equals_library(tokenizer, text):
    coder, decoder = bpe.load_bpe(tokenizer_path()), bpe.load_decoder(tokenizer_path())
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.encode(text) == want
    assert decoder.decode(want) == tokenizer.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike():
    coder = bpe.load_bpe(tokenizer_path())
    chance = random.Random(4)
    for n in (60, 90):
        word = "".join(chance.choice("aeinorst") for _ in range(n))
        data = word.encode()
        ids = [coder.inner[b] for b in data[:-1]] + [coder.final[data[-1]]]
        assert coder._merge_long(list(ids)) == coder._merge_word(word)


def test_op5_over_whole_table(spark, sf_dir, texts, tokenizer):
    got = {r["doc_id"]: r for r in QUERIES["op5_bpe"](spark, sf_dir).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op5_odd_rows(odd_documents, no_documents, tokenizer):
    coded = bpe.decode_ids(bpe.encode_text(odd_documents))
    assert [c for c in coded.columns if c.lower() == "token_ids"] == ["token_ids"]
    for row in coded.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == ids
        assert row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
        assert row["Score"] == "kept"
    assert bpe.bpe_digests(no_documents).count() == 0


def test_op1_over_whole_table(spark, sf_dir, texts, tokenizer):
    got = {r["doc_id"]: r for r in QUERIES["op1_wavelet"](spark, sf_dir).collect()}
    start = 0
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        row = got.pop(doc_id)
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not got


def test_op1_odd_rows(odd_documents, no_documents):
    rows = wavelet_result(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0, *[r["n_tokens"] for r in ordered]])[:-1].tolist()
    assert ordered[0]["doc_id"] is None and {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)} == {1}
    assert wavelet_result(no_documents).count() == 0


@pytest.mark.parametrize("top", [1, 2, 700, 49_407, 70_000])
def test_wavelet_file_against_brute_force(top):
    chance = np.random.default_rng(top)
    ids = (chance.zipf(1.3, 150_000) % top).astype(np.uint32)
    file = WaveletFile(io.BytesIO(build_shard(ids, [5, None], np.array([100, 149_900]))))
    assert (file.read_all() == ids).all()
    assert file.documents()[0] == [5, None] and file.documents()[1].tolist() == [100, 149_900]
    for i in chance.integers(0, len(ids), 20).tolist():
        assert file.access(i) == ids[i]
        token = int(ids[i])
        low, high = sorted(chance.integers(0, len(ids) + 1, 2).tolist())
        assert file.count(token, low, high) == int((ids[low:high] == token).sum())
        places = np.flatnonzero(ids == token)
        k = int(chance.integers(0, len(places)))
        assert file.occurrence(token, k) == places[k]
    assert file.count(top + 1_000_000) == 0
    with pytest.raises(IndexError):
        file.occurrence(int(ids[0]), len(ids))


def test_empty_shard():
    file = WaveletFile(io.BytesIO(build_shard(np.zeros(0, np.uint16), [], np.zeros(0, np.int64))))
    assert len(file.read_all()) == 0 and file.count(3) == 0


def test_tokens_are_counted_and_found_over_several_shards(spark, odd_documents, tokenizer):
    from metricspark.llm.wavelet import token_counts, token_places, write_shards
    from metricspark.session import work_path

    folder = work_path(spark, "lookup")
    manifest = write_shards(odd_documents.repartition(3), folder, shard_tokens=50)
    assert manifest.count() > 2
    rows = [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in odd_documents.collect()]
    every = [t for _, ids in rows for t in ids]
    wanted = [2, 49407, every[0], every[-2], 17, 40_000, 70_000]
    got = {r["token"]: r["n"] for r in token_counts(spark, folder, wanted).collect()}
    assert got == {t: every.count(t) for t in wanted}
    for token in (2, every[0], 70_000):
        want = sorted(((str(d), i) for d, ids in rows for i, t in enumerate(ids) if t == token))
        assert sorted((str(r["doc_id"]), r["place"]) for r in token_places(spark, folder, token).collect()) == want


@pytest.mark.parametrize("top", [1, 200, 300, 65_535, 70_000])
def test_rank_and_select_across_blocks(top):
    chance = np.random.default_rng(top)
    ids = chance.integers(0, top, 150_000, endpoint=True).astype("<u4")
    ids[1_000:90_000] = top
    file = WaveletFile(io.BytesIO(build_shard(ids, [1], np.array([len(ids)]))))
    assert (file.read_all() == ids).all()
    for i in (0, 63, 64, 65_535, 65_536, 131_073, 149_999):
        assert file.access(i) == ids[i]
    for token in (0, top, top // 2):
        places = np.flatnonzero(ids == token)
        assert file.count(token) == len(places)
        assert file.count(token, 500, 70_001) == int(((places >= 500) & (places < 70_001)).sum())
        for k in {0, len(places) // 2, len(places) - 1} if len(places) else ():
            assert file.occurrence(token, k) == places[k]


def test_op1_encodes_a_word_once_and_many_words_at_a_time(tokenizer):
    """However the word is written and whatever marks follow; the ids stay the library's."""
    from metricspark.llm.wavelet import LibraryEncoder

    class Spy:
        def __init__(self, inner):
            self.inner, self.got = inner, []

        def encode_batch_fast(self, texts, **more):
            self.got += texts
            return self.inner.encode_batch_fast(texts, **more)

    def same(encoder, pieces):
        ids, at = encoder.pieces(pa.array(pieces))
        for piece, a, b in zip(pieces, at, at[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(piece, add_special_tokens=False).ids, ascii(piece)

    encoder = LibraryEncoder(tokenizer_path())
    spy = encoder.tokenizer = Spy(encoder.tokenizer)
    chance = random.Random(8)
    words = list(dict.fromkeys("".join(chance.choice("abcdeéöñ") for _ in range(9)) for _ in range(2_000)))
    same(encoder, [f(w) + m for w in words for f in (str.lower, str.upper, str.title) for m in ("", ",", "...", "%%%")])
    assert sum(len(t.split(" ")) for t in spy.got) == len(words) + 3  # and the marks
    assert len(spy.got) < len(words) / 10

    special = ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>.", "x|", "<x", "x>,", "s.'s", "don't,", "I'LL.", "'s,", "x'", "a1,", "a.b", "_", "x_y_"]
    special += ["e\u0301,", "e,\u0301", "x=\u0338", "İ.", "Aİ,", "\u0958.", "Σ.", "ΑΣ,", "ﬁ,", "K,", "½", "x½.", "ŉ,", "ǅ.", "ß!", "ẞ!", "日本,", "\u1112\u1161,", "x\x1c.", "x\u00a0,"]
    same(encoder, special)
    same(encoder, [chr(c) + m for c in range(0x21, 0x2000) for m in ("", ",", "x", "_.")])
    same(encoder, [f"x{chr(c)}{m}" for c in range(0x21, 0x300) for m in ("", ".", "\u0301,")])
