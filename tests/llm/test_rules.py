"""Rules that hold for whole texts and many rows: long words, dotted names, several blocks, labels by language, one stage."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline import staging
from rosterline.llm import ann, decontam, language_id, queries, quality, secret_scan, simhash_dedup

PIECES = queries.PIECES


@pytest.fixture(scope="module")
def model():
    kept, _ = language_id.vocabulary(PIECES)
    p = np.random.default_rng(1).dirichlet(np.ones(len(kept) + 1) / 5, 3)
    p[:, -1] = 1e-7
    return language_id.Model(PIECES, ["a", "b", "c"], p)


def plain_total(model, word):
    """Logarithms of the sums over all segmentations, in Python's own numbers with exponents apart."""
    kept, _ = language_id.vocabulary(PIECES)
    place, text = {x: k for k, x in enumerate(kept)}, language_id.BLANK + word
    out = []
    for p in model.p:
        sums = [0.0]
        for e in range(1, len(text) + 1):
            parts = [sums[e - n] + math.log(max(p[place[text[e - n : e]]], 1e-320)) for n in range(1, min(e, 24) + 1) if text[e - n : e] in place]
            if text[e - 1] not in place:
                parts.append(sums[e - 1] + math.log(p[-1]))
            top = max(parts)
            sums.append(top + math.log(sum(math.exp(x - top) for x in parts)))
        out.append(sums[-1])
    return out


@pytest.mark.parametrize("word", ["short", "theriverrunsslowlypastoldstonesandgreenfieldsunderawidesky", "日本語の文章は空白を使わない" * 30, "straße" * 60])
def test_long_words_are_summed_over_all_segmentations(model, word):
    assert model.long_totals(word).tolist() == pytest.approx(plain_total(model, word), rel=1e-9)


def test_texts_of_long_words_are_predicted_by_them(model):
    word = "theriverrunsslowlypastoldstonesandgreenfields"
    langs, scores = model.predict([word, f"{word} short {word}"])
    total = np.array(plain_total(model, word))
    share = np.exp(total - total.max())
    assert langs[0] == model.languages[int(total.argmax())] and scores[0] == pytest.approx(share.max() / share.sum(), rel=1e-6)
    both = 2 * total + np.array(plain_total(model, "short"))
    assert langs[1] == model.languages[int(both.argmax())]


def test_rare_languages_are_learned(spark):
    rows = spark.range(6_000).select(F.col("id").alias("doc_id"), F.lit("the river runs past the stones").alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(20).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("der fluss fliesst "), "id").alias("text"), F.lit("de").alias("lang"))
    found = language_id.train(rows.unionByName(rare), PIECES, train_rows=200)
    assert found.languages == ["de", "en"] and found.predict(["der fluss fliesst", "the river runs"])[0] == ["de", "en"]


def test_redacted_tables_may_have_any_column_names(spark):
    df = spark.createDataFrame([("password = hunter2hunter2", 1, "k")], "`the.text` string, `a.b` int, text string")
    row = secret_scan.redact(df, "the.text").collect()[0]
    assert tuple(row) == ("password = hunter2hunter2".replace("password = hunter2hunter2", "[secret]"), 1, "k")


def test_tables_of_several_blocks_are_built_once(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(8)]
    shared = decontam.Shared(spark, [items[i : i + 2] for i in range(0, 8, 2)], 0.8)
    before = decontam.Shared.built
    assert [len(x.by_length[30][0]) for x in shared.items()] == [2] * 4 and shared.items() is not None
    assert decontam.Shared.built == before + 4


def test_many_blocks_give_what_one_gives(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(k, f"before {t} after" if k % 3 else f"other words {k}") for k, t in items]
    docs = spark.createDataFrame(texts, "doc_id long, `the.text` string")
    one = sorted(map(tuple, decontam.find(docs.toDF("doc_id", "text"), bench).collect()))
    assert len(list(decontam.blocks(bench, block_items=4))) > decontam.PASS_BLOCKS
    assert one == sorted(map(tuple, decontam.find(docs.toDF("doc_id", "text"), bench, block_items=4).collect()))
    assert {r[0] for r in decontam.clean(docs, bench, "the.text", block_items=4).collect()} == {k for k, _ in items if k % 3 == 0}


def plain_learner(rows, epochs, alpha=4.0, beta=1.0, l1=1e-3, l2=1e-4):
    """Follow-the-regularised-leader with dictionaries."""
    z, n = {}, {}

    def weight(i):
        own = z.get(i, 0.0)
        if abs(own) <= l1:
            return 0.0
        return -(own - math.copysign(l1, own)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for places, values, label in rows:
            features = [*zip(places, values), (quality.PLACES, 1.0)]
            w = {i: weight(i) for i, _ in features}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * x for i, x in features)))))
            for i, x in features:
                g = (p - label) * x
                step = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}, n


def test_learners_follow_the_rule():
    of, own = quality.Features(), quality.Learner()
    texts = ["good words in a row", "bad bad words !!", "good stones", "bad row", "", "words"] * 4
    rows = [(*of(t), int("bad" not in t)) for t in texts]
    for places, values, label in rows * 3:
        own.visit(places, values, label)
    want, seen = plain_learner([(p.tolist(), v.tolist(), y) for p, v, y in rows], 3)
    at = np.array(sorted(want))
    assert own.weights(at).tolist() == pytest.approx([want[i] for i in at.tolist()], rel=1e-9, abs=1e-12)
    assert own.n[at].tolist() == pytest.approx([seen[i] for i in at.tolist()], rel=1e-9)


def test_features_are_counted_words_and_pairs():
    places, values = quality.Features()("one two, one two")
    # one, two, the sign, and the pairs one-two (twice), two-sign, sign-one
    counts = sorted(round(math.expm1(v * math.sqrt(sum(math.log1p(c) ** 2 for c in (2, 2, 1, 2, 1, 1))))) for v in values.tolist())
    assert len(places) == 6 and counts == [1, 1, 1, 2, 2, 2]


def test_quality_equals_plain_python(spark):
    docs = spark.range(120).selectExpr("id AS doc_id", "concat(if(id % 3 = 0, 'junk !! ', 'calm prose about '), 'number ', id % 7) AS text")
    labels = spark.range(120).selectExpr("id AS doc_id", "cast(id % 3 <> 0 AS int) AS quality")
    weights = quality.train(docs, labels, learners=2, epochs=2)
    import xxhash

    of, rows = quality.Features(), {}
    for r in docs.join(labels, "doc_id").withColumn("learner", F.pmod(F.xxhash64(F.lit("learner"), "doc_id"), F.lit(2))).collect():
        rows.setdefault(r["learner"], []).append(r)
    sums, seen = {}, {}
    for own in rows.values():
        own.sort(key=lambda r: xxhash.xxh64_intdigest(str(r["doc_id"]), 5))
        w, n = plain_learner([(*(x.tolist() for x in of(r["text"])), r["quality"]) for r in own], 2)
        for i in w:
            sums[i], seen[i] = sums.get(i, 0.0) + w[i] * n[i], seen.get(i, 0.0) + n[i]
    at = np.array(sorted(sums))
    assert weights[at].tolist() == pytest.approx([sums[i] / seen[i] for i in at.tolist()], rel=1e-6, abs=1e-9)
    assert np.count_nonzero(weights) <= len(at)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, weights).collect()}
    for r in docs.collect():
        places, values = of(r["text"])
        assert scores[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-(float(weights[places] @ values) + weights[-1]))), rel=1e-9)


def test_pipeline_takes_one_of_each_fingerprint_group(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.one_of_each(spark, docs, sf_dir)
    found = simhash_dedup.groups(docs).groupBy("component_id").agg(F.min("doc_id").alias("doc_id"))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found.collect()}


def test_pipeline_leaves_only_its_last_table(spark, sf_dir):
    import corpus_pipeline

    with staging.run(spark):
        before = set(staging.staged_paths(spark))
        corpus_pipeline.run(spark, sf_dir).count()
        left = [p.rpartition("/")[2].rpartition("-")[0] for p in staging.staged_paths(spark) if p not in before]
        assert left == [n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES[:-1]]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_nearest_vectors_are_found_on_every_given_table(spark, scale):
    path = f"/root/testdata/{scale}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    rows = spark.read.parquet(path)
    table = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    table = [(i, np.array(v)) for i, v in table if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, vectors = np.array([i for i, _ in table]), np.stack([v for _, v in table])
    units = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    # Every tenth row asks: 50 queries on the small tables, 200 on the large one.
    found = {}
    for r in ann.search(rows, F.col("vec_id") % 10 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = asked = 0
    for i in ids[ids % 10 == 0]:
        cosine = units @ units[ids == i][0]
        cosine[ids == i] = -np.inf
        best = {int(x) for x in ids[np.lexsort((ids, -cosine))[:5]]}
        hits, asked = hits + len(best & found[int(i)]), asked + len(best)
    assert hits / asked >= 0.9
