"""Language, quality, near copies, vectors and decontamination: brute force, held-out accuracy, awkward rows."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rosterline.llm import ann, decontam, language_id, quality, simhash_dedup
from rosterline.llm.queries import PIECES

SCHEMA = "doc_id long, text string"


def as_unsigned(x):
    return x % 2**64


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, near):
    """Smallest value reachable from each by links that ``near`` tells."""
    left, roots = set(values), {}
    for v in sorted(values):
        if v in left:
            front = [v]
            left.discard(v)
            while front:
                x = front.pop()
                roots[x] = v
                more = [y for y in left if near(x, y)]
                left.difference_update(more)
                front += more
    return roots


def near(a, b):
    return ((a ^ b) % 2**64).bit_count() <= 2


def test_fingerprints_and_components(spark, docs, rows):
    found = {r.doc_id: r for r in simhash_dedup.groups(docs).collect()}
    prints = {i: plain_fingerprint(t) for i, t in zip(rows.doc_id.tolist(), rows.text)}
    assert {i: as_unsigned(r.fp) for i, r in found.items()} == prints
    roots = plain_roots(set(prints.values()), near)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], i), i)
    assert {i: r.component_id for i, r in found.items()} == {i: least[roots[p]] for i, p in prints.items()}


@pytest.mark.parametrize("limit", [1, 3, 24])
def test_crowded_lists_lose_no_link(spark, limit):
    """Balls of near fingerprints, where lists are long: the same components as by all pairs."""
    rng = np.random.default_rng(limit)
    values = {0, 1, 3, -1}
    for _ in range(3):
        centre = int(rng.integers(-(2**63), 2**63))
        for _ in range(40):
            flips = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False))
            values.add(centre ^ flips)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash_dedup.links(df, limit)
    assert all(near(r.u, r.v) for r in links.collect())
    found = {r.node: r.root for r in simhash_dedup.components(links).collect()}
    assert {v: found.get(v, v) for v in values} == plain_roots(values, near)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "u long, v long")
    found = {r.node: r.root for r in simhash_dedup.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}


def test_copies_edge_cases(awkward, empty):
    found = simhash_dedup.groups(awkward).collect()
    assert len(found) == awkward.count() and simhash_dedup.groups(empty).count() == 0
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by_id[0] == by_id[1] == by_id[2] == {(0, 0)} and by_id[5] == by_id[4]
    kept = simhash_dedup.keep_first(awkward)
    assert kept.columns == awkward.columns and simhash_dedup.keep_first(empty).count() == 0
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 4} <= set(ids) and not {1, 2, 5, None} & set(ids)


def test_language_held_out_accuracy(docs):
    found = language_id.held_out_predictions(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_forward_sums_all_segmentations():
    kept, automaton = language_id.vocabulary(PIECES)
    p = np.random.default_rng(1).random(len(kept) + 1)
    place = {x: i for i, x in enumerate(kept)}

    def brute(text):
        if not text:
            return 1.0
        total = sum(p[place[text[:n]]] * brute(text[n:]) for n in range(1, len(text) + 1) if text[:n] in place)
        return total + (p[-1] * brute(text[1:]) if text[0] not in place else 0)

    words = ["the", "then", "a", "é", "日本x", "hello"]
    lattice = language_id.Lattice(words, automaton, len(kept))
    assert np.allclose(np.exp(lattice.log_totals(p[lattice.piece])), [brute(language_id.BLANK + w) for w in words])
    # Expected uses weighted by piece length give back the letters of every word.
    length = np.array([len(x) for x in kept] + [1])
    uses = lattice.expected(p[lattice.piece], np.ones(len(words)))
    assert np.isclose((uses * length[lattice.piece]).sum(), sum(len(w) + 1 for w in words))


def test_language_edge_cases(awkward, empty):
    model = language_id.train(awkward, PIECES)
    found = {r.doc_id: r for r in language_id.identify(awkward.filter("doc_id IS NOT NULL"), model).collect()}
    assert model.languages == ["en"]
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {0, 1, 2, 3, 8}
    assert all(r.score == (0.0 if r.lang_pred == "und" else 1.0) for r in found.values())
    untaught = language_id.train(empty, PIECES)
    assert {r.lang_pred for r in language_id.identify(awkward, untaught).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0
    kept = language_id.with_language(awkward, model)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, 9, None}


def test_language_bound_keeps_some(docs):
    model = language_id.train(docs, PIECES, train_rows=100, rounds=1)
    assert len(model.languages) >= 3 and np.allclose(model.p[:, :-1].sum(1), 1, atol=1e-3)


def test_quality_held_out(docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.held_out_scores(docs, labels)
    rows = found.join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    assert found.count() == docs.count()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.75, auc
    assert all(r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found.collect())


def test_quality_edge_cases(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (4, 1), (9, 0), (0, 0), (None, 1), (5, None), (77, 1)], "doc_id long, quality int")
    found = quality.held_out_scores(awkward, labels)
    assert found.count() == awkward.count() and all(0 <= r.score <= 1 for r in found.collect())
    assert {r.score for r in quality.held_out_scores(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality.held_out_scores(empty, labels).count() == 0


def test_vectors_recall_and_exactness(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    found = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0, shard_rows=64, query_block=2).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    cosine = lambda a, b: float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))
    hits = total = 0
    for q in [i for i in rows if i % 50 == 0]:
        best = sorted(((-cosine(rows[q], v), i) for i, v in rows.items() if i != q))[:5]
        hits += len({i for _, i in best} & {i for i, _ in found[q]})
        total += 5
        assert len(found[q]) == 5 and all(abs(s - cosine(rows[q], rows[i])) < 1e-12 for i, s in found[q])
    assert hits / total >= 0.9


def test_vector_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (50, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit(1)).withColumn("block", F.lit("x"))
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0), (50, 3, 2, 0.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    copies = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(300)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.search(copies, F.col("vec_id") == 100).orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_rotations_keep_lengths():
    x = np.random.default_rng(3).normal(size=(5, 48))
    for t in range(3):
        assert np.allclose((ann.rotated(x, t) ** 2).sum(1), (x**2).sum(1))


def brute_items(text, items, least=0.8):
    """Every window of every item."""
    words = decontam.Words()
    own, out = words(text or ""), {}
    for item, item_text in items:
        w = words(item_text or "")
        if not len(w):
            continue
        width = min(decontam.WIDTH, len(w))
        target, hashes = decontam.shingles(w, width), decontam.shingles(own, width)
        if not np.isin(target, hashes).any():
            continue
        size = min(len(target), len(hashes))  # a shorter text is one window
        sims = [(decontam.similarity(hashes[i : i + size], target), -i) for i in range(len(hashes) - size + 1)]
        if sims and max(sims)[0] >= least:
            out[item] = (max(sims)[0], -max(sims)[1], min(len(w), len(own)))
    return out


def test_items_in_documents(spark, docs, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    item = next(t for _, t in items if len(t.split()) > 30).split()
    edited = [" ".join(item[:k] + ["changed"] + item[k + 1 :]) for k in (0, 2, 15)] + [" ".join(item[:-2]), "pre fix " + " ".join(item).upper() + " post", " ".join(item * 3), " ".join(item[:12])]
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(edited)], SCHEMA)
    every = docs.select("doc_id", "text").union(more)
    found = {}
    for r in decontam.find(every, bench).collect():
        found.setdefault(r.doc_id, {})[r.item_id] = (r.similarity, r.start_word, r.n_words)
    brute = {r.doc_id: b for r in every.collect() if (b := brute_items(r.text, items))}
    assert found == brute and 10_004 in found and 10_006 not in found
    kept = {r.doc_id for r in decontam.clean(every, bench).collect()}
    assert kept == {r.doc_id for r in every.collect()} - set(brute)


def test_items_in_blocks_and_edge_cases(spark, awkward, empty):
    items = [(1, "small text about nothing in particular"), (2, "end"), (3, None), (4, ""), (5, "quick brown fox jumps over the lazy dog"), (1, "small text about nothing in particular"), (6, "absent words here")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = sorted(((r.doc_id, r.item_id) for r in decontam.find(awkward, bench).collect()), key=repr)
    assert found == sorted([(i, 1) for i in (4, 4, 5, None) for _ in "12"] + [(6, 2), (9, 5)], key=repr)
    assert len(list(decontam.blocks(bench, block_items=2))) > 1
    assert decontam.find(awkward, bench.limit(0)).count() == 0 and decontam.find(empty, bench).count() == 0
    kept = decontam.clean(awkward, bench)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 7, 8, None}


def test_pipeline_equals_its_parts(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns and docs.count() <= before, name
    last = {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}
    assert last == {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()} and len(last) == docs.count()


def test_pipeline_edge_cases(spark, sf_dir, awkward, empty):
    import corpus_pipeline

    for start in (awkward, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns[:2] == ["doc_id", "n_tokens"]
