import pytest

LONG = "the quick brown fox jumps over the lazy dog and runs away " * 3_000
#: Columns whose names the operators use themselves.
CLASHING = {"fp": "1", "ids": "2", "shard": "3", "component_id": "4", "row": "5", "_kept": "6", "label": "7", "score": "8", "lang_pred": "9", "word": "10", "cuts": "11", "occurrence": "12"}
TEXTS = [
    None,
    "",
    " \t\n",
    "?!... 123 456",
    "One small text about nothing in particular, with a few more words.",
    "One small text about nothing in particular, with a few more words.",
    "Ünïcödé – 日本語 𠀀 é \x00 \x1c end",
    "a" * 5_000,
    "1 " * 5_000,
    LONG,
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated texts, rows and ids, extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None, len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "s", 1), (None, TEXTS[4], None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, value in CLASHING.items():
        df = df.selectExpr("*", f"'{value}' AS {name}")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return docs.select("doc_id", "text").toPandas()
