import pytest

FOLDER = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, base string, slot string"


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z")


WORDS = [f"w{i}" for i in range(3000)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    passage = " ".join(WORDS[:70])
    rows = [
        document(None, None, None, None), document(None, "alone without an id"), document(None, "alone without an id"),
        document(1, ""), document(2, None), document(3, "  \n\t "), document(4, "x" * 30000), document(5, "12 34 !!"),
        document(6, " ".join(WORDS)), document(7, " ".join(WORDS[::-1])), document(8, "don't we'll  'twas\n\n it's"),
        document(9, passage), document(9, passage), document(10, passage), document(11, "ab " * 4000),
        document(12, f"{passage} tail one two"), document(13, "é ü 中文 ß 😀 İ"), document(14, "<|endoftext|> text <|endoftext|>"),
        document(15, "mail a.b@c.de or x@y.z.w_q@r.st, 10.0.0.256 1.2.3.4.5.6.7.8, 4111 1111 1111 1111, +1 (555) 010-9999"),
        document(16, "a"), document(17, "one two"), document(-5, "minus five"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet")
