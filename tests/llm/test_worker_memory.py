"""What a Python worker holds: batches of bounded bytes, and the tables of one stage at a time."""

import pyarrow as pa
from public_tokenizers import path as public_path
from pyspark.sql import functions as F

from rosterline.llm import base, decontam, language_id, piece_codec, simhash_dedup

PIECES = public_path("piece_bpe_32k.model")


def test_a_worker_keeps_the_tables_of_one_stage(spark):
    codec = piece_codec.codec(PIECES)
    assert piece_codec.codec(PIECES) is codec
    with base.task(("codec", PIECES)):
        assert piece_codec.codec(PIECES) is codec
    shared = decontam.Shared(spark, [[(1, "one small item of the benchmark")]], 0.8)
    held = shared.items()
    assert list(base._kept) == [shared.name] and shared.items() is held
    assert piece_codec.codec(PIECES) is not codec
    with base.task():
        assert not base._kept


def test_texts_come_in_batches_of_bounded_bytes(spark):
    docs = spark.range(0, 4_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("rain over the hills "), "id"), 200).alias("text"))
    before = docs.agg(F.sum(F.length("text"))).first()[0]
    assert before > 16_000_000
    base.small_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert max(found) < 5_000_000 and sum(found) >= before
    assert simhash_dedup.fingerprints(docs).count() == 4_000


def test_batches_and_kept_tables_change_no_result(spark, awkward):
    texts = awkward.select("doc_id", "text")
    model = language_id.Model(PIECES, [], language_id.np.zeros((0, 1)))
    assert language_id.with_language(texts, model).count() == 0
    items = spark.createDataFrame([(1, "small text about nothing in particular with a few more words")], "item_id long, text string")
    clean = decontam.clean(texts, items)
    assert clean.count() == texts.filter("text IS NULL OR text NOT LIKE '%nothing in particular%'").count()
    assert piece_codec.digests(clean, PIECES).count() == clean.count()
