import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score string, TOKEN_IDS int"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing extra columns."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base + " thirteen", "en", "b"),
        (4, None, None, None),
        (5, "", "en", None),
        (6, " \n\t ", "en", "b"),
        (7, "Zoë wrote to zoe@example.org, then 10.0.0.1 <|endoftext|> don't", None, "a"),
        (8, "x" * 3000, "en", "c"),
        (9, ("lorem ipsum dolor sit amet " * 6000) + "end", "la", "c"),
        (9, ("lorem ipsum dolor sit amet " * 6000) + "end", "la", "c"),
        (None, base, "en", "a"),
        (11, "İstanbul ΣΑΣ ½ 日本 😀\x1cfs", "en", "c"),
    ]
    return spark.createDataFrame(
        [(i, t, la, so, None if t is None else len(t), "kept", 7) for i, t, la, so in rows], SCHEMA
    ).coalesce(2)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from metricspark.llm.common import tokenizer_path

    return Tokenizer.from_file(tokenizer_path())
