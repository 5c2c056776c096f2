"""Resampling against SQL and plain integers, bit planes, draws with ties, awkward rows."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import oracle
from hypothesis import given
from hypothesis import strategies as st

from rosterline.llm import queries, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    own = WORD.findall((text or "").translate(SMALL))
    return own, own + [f"{a} {b}" for a, b in zip(own, own[1:])]


def brute(rows, target, percent=25, least_words=20, seed=7):
    """Sorted (doc_id, n_features, weight, score, rank); ``rows`` of (doc_id, text)."""
    places = lambda fs: Counter(crc32(f.encode()) % 10_000 for f in fs)
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(places(features(text)[1]))
    for text in target:
        t.update(places(features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))
    scored = []
    for key, text in rows:
        own, all_features = features(text)
        n = len(all_features)
        weight = sum(c * gain(b) for b, c in places(all_features).items()) // n if n else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        scored.append((key, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(own) >= least_words))
    eligible = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = percent * len(eligible) // 100
    out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(eligible)]
    return sorted(map(repr, out + [(*r[:4], None) for r in scored if not r[4]]))


def found(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_query_equals_sql(spark, sf_dir):
    name = "op12_importance_resample"
    assert oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name]) == []


def test_awkward_rows(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    target = ["the lazy dog", None, "", "One small TEXT"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(resample.resample(awkward, frame, percent=60, least_words=2)) == brute(rows, target, 60, 2)
    assert found(resample.resample(awkward, frame.limit(0), percent=100, least_words=0)) == brute(rows, [], 100, 0)


def test_empty_corpus(spark, empty):
    assert resample.resample(empty, empty).collect() == []


def test_equal_rows_rank_one_after_the_other_over_many_tasks(spark):
    df = spark.range(3_000).selectExpr("cast(null as long) AS doc_id", f"'{'one two ' * 12}' AS text").repartition(6)
    ranks = [r["rank"] for r in resample.resample(df, df.limit(1)).select("rank").collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 751)) and len(ranks) == 3_000


@given(st.lists(st.integers(0, 3_000), min_size=1, max_size=60), st.lists(st.integers(-40_000, 40_000), min_size=1, max_size=60), st.integers(0, 9_000))
def test_bit_planes_sum_exactly(counts, values, at):
    c, g = np.zeros(resample.BUCKETS, np.int64), np.zeros(resample.BUCKETS, np.int64)
    c[at : at + len(counts)], g[at + 3 : at + 3 + len(values)] = counts, values
    assert resample.Gains(g).total(c) == int(c @ g)


@given(st.text(max_size=200), st.integers(1, 30))
def test_buckets_of_stretches(text, size):
    data = text.encode("utf-8", "surrogatepass")
    if data.decode("utf-8", "ignore") != text:
        return
    original = resample.words.runs
    try:
        resample.words.runs = lambda d, t: original(d, t, size)
        counts, n = resample.buckets(data)
    finally:
        resample.words.runs = original
    own, every = features(text)
    assert n == len(own) and Counter({int(b): int(counts[b]) for b in np.flatnonzero(counts)}) == Counter(crc32(f.encode()) % 10_000 for f in every)
