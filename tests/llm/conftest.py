import pytest

ODD_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, spans string, items string, "
    "value string, root string, kinds int, n_words string, fingerprint string"
)


def row(doc_id, text):
    return (doc_id, text, "en", "src0", len(text or ""), "s", "p", "i", "v", "r", 7, "n", "f")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns named like results."""
    texts = [
        (1, "the quick brown fox jumps over the lazy dog near the old river bank today"),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, "word " * 30_000 + "end"),
        (6, "x" * 5000),
        (7, "É è ß 中文 emoji 🙂 token = \"9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c\" \x00\x1c odd"),
        (8, "the quick brown fox jumps over the lazy dog near the old river bank today"),
        (8, "the quick brown fox jumps over the lazy dog near the old river bank today"),
        (9, "another text"),
        (9, "a different text of the same id"),
        (None, "a text without an id"),
        (None, None),
    ]
    return spark.createDataFrame([row(*t) for t in texts], ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
