"""Source divergence against SQL and plain integers, its hashes, awkward rows, small bounds."""

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import oracle
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from rosterline.llm import divergence, queries, words

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(rows, min_docs, most):
    """The contract in exact fractions: rows of (lang, source, text)."""
    rows = [(a or "", b or "", terms(t)) for a, b, t in rows]
    out = set()
    for lang in {a for a, _, _ in rows}:
        held = Counter(t for a, _, own in rows if a == lang for t in set(own))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for a, source, own in rows:
            if a == lang:
                counts[source].update(t for t in own if held[t] >= min_docs)
        whole = sum(counts.values(), Counter())
        p = lambda c: {t: 1 + math.floor(Fraction(10**9 * (c[t] + 2), sum(c.values()) + 2 * len(kept))) for t in kept}
        f = lambda x, y: math.floor(Fraction((x - y) ** 2, x + y))
        q = p(whole)
        shares = {s: p(c) for s, c in counts.items()}
        for s in counts:
            pairs = sorted((-sum(f(shares[s][t], shares[o][t]) for t in kept), o.encode()) for o in counts if o != s)
            lead = sorted((-f(shares[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and shares[s][t] > q[t])[:most]
            for part, found in (("pair", pairs), ("term", lead)):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_sql(spark, sf_dir):
    name = "op11_source_divergence"
    assert oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name]) == []


def test_small_bounds_change_nothing(spark, docs, monkeypatch):
    """Many shards and rounds, dense arrays given out often, blocks of sources and of slots."""
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    monkeypatch.setattr(divergence, "SIDE", 3)
    ours = found(divergence.audit(docs, min_docs=4, most=3, shard_keys=64, round_bytes=20_000, dense_bytes=100_000))
    assert ours == brute(rows, 4, 3)


def test_awkward_rows(spark, awkward):
    rows = [tuple(r) for r in awkward.select("lang", "source", "text").collect()]
    assert found(divergence.audit(awkward, min_docs=2)) == brute(rows, 2, 10)


def test_languages_without_kept_terms(spark):
    rows = [("en", "a", "one two"), ("en", "b", "two 3"), ("en", "c", None), (None, "a", "x"), ("de", None, "y"), ("de", "ä", "z"), ("de", "z", "Z z")]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert found(divergence.audit(df)) == brute(rows, 10, 10)
    assert found(divergence.audit(df, min_docs=2)) == brute(rows, 2, 10)


def test_empty_table(empty):
    assert divergence.audit(empty).collect() == []


def test_one_group_with_all_rows_leaves_one_row_a_block(spark):
    df = spark.range(40_000).selectExpr("'en' AS lang", "'hot' AS source", "concat('w', char(97 + id % 26), ' the the') AS text")
    own = divergence._own(df.repartition(8))
    shards = divergence.term_shards(divergence.kept_terms(own, 10))
    counted = divergence.recount(own, shards).collect()
    assert len(counted) == 1 and counted[0]["n"] == 120_000


@given(st.sets(st.text(min_size=1, max_size=12), min_size=1, max_size=300), st.sets(st.text(max_size=12), max_size=60))
def test_perfect_hash_is_dense_and_verifies_keys(kept, others):
    kept = [t.encode("utf-8", "surrogatepass") for t in kept]
    others = [t for t in (o.encode("utf-8", "surrogatepass") for o in others) if t not in set(kept)]
    index = divergence.Terms(divergence.Terms.build(kept))
    hashes = lambda xs: np.fromiter((xxhash.xxh64_intdigest(x, divergence.FIRST_SEED) for x in xs), np.uint64, len(xs))
    assert sorted(index.find(kept, hashes(kept)).tolist()) == list(range(len(kept)))
    assert [index.keys()[s] for s in index.find(kept, hashes(kept))] == kept
    assert (index.find(others, hashes(others)) == -1).all()
    again = divergence.Terms(divergence.Terms.build(kept, seed=43))
    assert sorted(again.find(kept, hashes(kept)).tolist()) == list(range(len(kept)))


@given(st.lists(st.integers(0, 10**15), min_size=1, max_size=20), st.integers(0, 10**15))
def test_shares_are_exact(counts, more):
    total = sum(counts) // 20 + max(counts) + 2 + more
    assert divergence.share(np.array(counts), total).tolist() == [1 + 10**9 * (c + 2) // total for c in counts]


@given(st.text(max_size=80), st.integers(1, 20))
def test_words_in_stretches_are_whole(text, size):
    data = text.encode("utf-8", "surrogatepass")
    if data.decode("utf-8", "ignore") != text:
        return
    assert [w.decode() for run in words.runs(data, divergence.TERMS, size) for w in run] == terms(text)
