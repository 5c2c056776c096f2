"""Texts that are a shortened benchmark item as a whole."""

from rosterline.llm import decontam

SCHEMA = "doc_id long, text string"


def test_clipped_items(spark):
    item = [f"w{i}" for i in range(50)]
    texts = [" ".join(item[:n]) for n in (50, 47, 41, 40, 30)] + [" ".join(item[4:])]
    items = spark.createDataFrame([(1, texts[0])], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {r.doc_id: (r.similarity, r.start_word, r.n_words) for r in decontam.find(docs, items).collect()}
    of = lambda t: decontam.shingles(decontam.Words()(t), 5)
    brute = {i: (s, 0, len(t.split())) for i, t in enumerate(texts) if (s := decontam.similarity(of(t), of(texts[0]))) >= 0.8}
    assert found == brute and set(found) == {0, 1, 2, 5}
    assert {r.doc_id for r in decontam.clean(docs, items).collect()} == {3, 4}
