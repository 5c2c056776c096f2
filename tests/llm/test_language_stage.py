"""Short texts that tell no language apart."""

import numpy as np

from rosterline.llm import language_id
from rosterline.llm.queries import PIECES

SCHEMA = "doc_id long, text string"


def test_texts_without_a_lead_stay(spark, sf_dir, monkeypatch):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "A."), (2, ""), (3, None)], SCHEMA)
    pieces = len(language_id.vocabulary(PIECES)[0]) + 1
    even = language_id.Model(PIECES, ["de", "en", "fr"], np.full((3, pieces), 1 / pieces))
    monkeypatch.setattr(language_id, "train", lambda *a, **k: even)
    assert [r.doc_id for r in corpus_pipeline.known_languages(spark, docs, sf_dir).collect()] == [1]
