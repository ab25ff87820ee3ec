import pytest

SF = "/root/testdata/sf0.001"
DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, fp string, word string, n string, key string, "
        "pos string, path string, root string, run string, a string, b string")


def row(i, text, source="s", lang="en", n_chars=1):
    return (i, text, lang, source, n_chars, *["x"] * 11)


@pytest.fixture(scope="module")
def make(spark):
    """A table of documents with columns whose names clash with those the operators use."""
    return lambda rows: spark.createDataFrame([row(*r) for r in rows], DOCS)


@pytest.fixture(scope="module")
def hard(make):
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    long_ = " ".join(f"longword{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} Ünï" for i in range(40_000))
    rows = [(1, "The quick brown fox jumps over the lazy dog"), (1, "The quick brown fox jumps over the lazy dog"), (2, ""), (3, " \n\t"), (4, "x"),
            (5, None), (None, "the QUICK brown fox jumps over the lazy dog"), (6, long_), (7, "naïveté naïveté NAÏVETÉ", None), (8, "tie", None, None, None),
            (8, "tie", None, None, None), (None, None, None, None, None), (9, "the quick brown fox jumps over the lazy dog", "")]
    return make(rows)


@pytest.fixture(scope="module")
def none(make):
    return make([])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
