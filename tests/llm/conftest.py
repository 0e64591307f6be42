import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return {r.doc_id: r for r in docs.collect()}


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    long_text = " ".join(f"word{i % 5000}" for i in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4),
        (4, long_text, "en", "a", len(long_text)), (5, "same words here", "de", "b", 15),
        (6, "same words here", "de", "b", 15), (6, "same words here", "de", "b", 15),
        (None, "no id at all", "fr", "c", 12), (None, None, None, None, None),
        (8, "one word", "fr", "c", 8), (9, "É Ü ß 漢字 🙂 tail", "de", "b", 15), (10, "one", "en", None, 3),
    ]
    clashing = "row string, n_words long, word_chars long, base_failed boolean, kept boolean, host string, _text string, " \
        "fp long, component_id long, size long, block long, bin long, start long, piece long, cluster string, shard int, " \
        "_found string, n_found long, score double, n_tokens long, law string, group string, ids string"
    n = clashing.count(",") + 1
    return spark.createDataFrame([r + (None,) * n for r in rows], f"{DOCS}, {clashing}")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def collected(df):
    return [r.asDict() for r in df.collect()]
