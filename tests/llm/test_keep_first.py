"""One row for each component, whatever its id."""

from pyspark.sql import functions as F

from rosterline.llm import simhash_dedup

SCHEMA = "doc_id long, text string"


def test_rows_of_one_id_with_different_texts_stay(spark, awkward, empty):
    texts = [f"{x} " * 3 + f"text about {x} and nothing else {x}" for x in ("apples", "pears", "plums")]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (1, "rain over the hills this morning"), (1, "a wholly different subject altogether"), (2, "a wholly different subject altogether")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("own"))
    out = simhash_dedup.keep_first(df)
    assert out.columns == df.columns
    assert sorted(r.text for r in out.collect()) == sorted({t for _, t in rows})
    # A copy that shares its id with the first row of another component goes.
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[0])]
    assert sorted(tuple(r) for r in simhash_dedup.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()) == [(1, texts[0]), (2, texts[1])]
    assert simhash_dedup.keep_first(awkward).columns == awkward.columns and simhash_dedup.keep_first(empty).count() == 0
