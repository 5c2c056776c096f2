"""The recurrent network against plain loops and numeric gradients, windows of whole texts, awkward rows, held-out rows."""

import math
import os
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterline.llm import toxicity as x

MEAN = "you are a stupid idiot and all of it is trash".split()
CALM = "the river runs slowly past old stones and green fields under a wide sky".split()


def made_up(n=60):
    """Label 1 where one of three words occurs, anywhere in texts of many windows."""
    chance = np.random.default_rng(3)
    out = []
    for i in range(n):
        text = list(chance.choice(CALM, 20 + 4 * i))
        if i % 3 == 0:
            text[int(chance.integers(0, len(text)))] = MEAN[3 + i % 2]
        out.append((i, " ".join(text), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def net():
    rows = made_up(90)
    return x.fit([t for _, t, _ in rows], [y for _, _, y in rows], epochs=12)


def plain_score(net, words):
    """One window word by word with plain loops."""
    lexicon = x.Lexicon(sorted(set(words)))
    place = {w: i + 1 for i, w in enumerate(sorted(set(words)))}
    vectors = lexicon.vectors(net).astype(float)
    h, sig = x.HIDDEN, lambda v: 1 / (1 + math.exp(-v))

    def states(order, d):
        state, out = [0.0] * h, []
        for w in order:
            gate = vectors[place[w]] @ net["input"] + net["input_bias"]
            gate = gate[3 * h * d : 3 * h * (d + 1)]
            past = [sum(state[i] * float(net["state"][d, i, j]) for i in range(h)) for j in range(3 * h)]
            new = []
            for j in range(h):
                hold, reset = sig(gate[j] + past[j]), sig(gate[h + j] + past[h + j])
                candidate = math.tanh(gate[2 * h + j] + reset * past[2 * h + j])
                new.append(hold * state[j] + (1 - hold) * candidate)
            state = new
            out.append(state)
        return out

    ahead, back = states(words, 0), states(words[::-1], 1)[::-1]
    both = [np.array(a + b) for a, b in zip(ahead, back)]
    weight = np.exp([float(np.tanh(s @ net["attend"] + net["attend_bias"]) @ net["weigh"]) for s in both])
    pooled = sum(w * s for w, s in zip(weight / weight.sum(), both))
    return sig(float(pooled @ net["out"] + net["out_bias"][0]))


def test_gradients_are_those_of_the_loss():
    net, chance = x.fresh(2, np.float64), np.random.default_rng(0)
    lexicon = x.Lexicon([b"stupid", b"word", "réê".encode(), b"clean", b"a"])
    ids = chance.integers(1, 6, (4, x.WINDOW))
    ids[0, 10:] = 0
    labels = np.array([0.0, 1, 1, 0])
    _, grad = x.gradients(net, lexicon, ids, labels)
    for name in net:
        flat, slope = net[name].reshape(-1), grad[name].reshape(-1)
        for at in np.argsort(-np.abs(slope))[:5]:
            held, step = flat[at], 1e-5
            flat[at] = held + step
            above = x.gradients(net, lexicon, ids, labels)[0]
            flat[at] = held - step
            below = x.gradients(net, lexicon, ids, labels)[0]
            flat[at] = held
            assert slope[at] == pytest.approx((above - below) / 2 / step, rel=1e-3, abs=1e-9), name


@settings(deadline=None, max_examples=20)
@given(st.lists(st.sampled_from([*MEAN, *CALM, "ünï", "x" * 40]), min_size=1, max_size=70))
def test_scores_are_the_highest_window_by_plain_loops(net, words):
    own = [w.encode() for w in words]
    starts = range(0, max(1, len(own) - x.WINDOW + x.STRIDE), x.STRIDE)
    want = max(plain_score(net, own[s : s + x.WINDOW]) for s in starts)
    assert x.Scorer(net)([" ".join(words)])[0] == pytest.approx(want, abs=2e-5)


@given(st.integers(0, 400), st.integers(24, 90))
def test_windows_of_segments_are_windows_of_the_text(n, segment):
    words = [b"w%d" % i for i in range(n)]
    before = x.SEGMENT
    try:
        x.SEGMENT = segment
        found = []
        for own in x.segments(" ".join(w.decode() for w in words)):
            ids = np.array([int(w[1:]) + 1 for w in own])
            found += [tuple(r[r > 0]) for r in x.windows(ids)]
    finally:
        x.SEGMENT = before
    whole = [tuple(r[r > 0]) for r in x.windows(np.arange(1, n + 1))] if n else []
    assert found == whole
    assert set().union(*found) == set(range(1, n + 1)) if n else found == []


def test_remembered_words_change_nothing(net):
    texts = [t for _, t, _ in made_up()]
    assert x.Scorer(net, most=5)(texts).tolist() == pytest.approx(x.Scorer(net)(texts).tolist(), abs=2e-6)


def test_learns_whatever_the_place(net):
    scores = {text: s for text, s in zip(["calm", "mean"], x.Scorer(net)([" ".join(CALM * 40), " ".join(CALM * 39 + ["idiot"] + CALM)]))}
    assert scores["calm"] < 0.5 < scores["mean"]


def test_awkward_rows(spark, awkward, empty, net):
    got = [(r["doc_id"], r["score"]) for r in x.score(awkward, net).collect()]
    assert len(got) == awkward.count()
    texts = [r["text"] or "" for r in awkward.collect()]
    want = x.Scorer(net)(texts).tolist()
    assert sorted(s for _, s in got) == pytest.approx(sorted(want), abs=2e-6)
    assert sorted(g for g in got if g[0] is not None and g[0] < 3) == [(0, 0.0), (1, 0.0), (2, 0.0)]
    assert all(0 <= s <= 1 for _, s in got) and x.score(empty, net).collect() == []


def test_without_both_labels_every_score_is_zero(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    ones = spark.createDataFrame([(4, 1), (9, 1), (None, 0), (5, None), (1, 0)], "doc_id long, toxic int")
    for labels in (none, ones):
        rows = x.held_out_scores(awkward, labels).collect()
        assert len(rows) == awkward.count() and {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}
    assert x.held_out_scores(empty, ones).collect() == []


def test_sample_is_bounded_and_takes_both_labels(spark):
    docs = spark.range(400).selectExpr("id % 300 AS doc_id", "concat('word ', id, repeat(' x', 50)) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS toxic")
    rows = x.sample(docs, labels, "toxic", 80, 1 << 20, "doc_id", "text").collect()
    assert len(rows) == 70 and sum(r["label"] for r in rows) == 30  # half of the bound at most of each label
    assert x.sample(docs, labels, "toxic", 80, 2_000, "doc_id", "text").count() < 20


def test_held_out_rows(spark):
    path = "/root/testdata/sf0.1"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = x.held_out_scores(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    told = [r for r in rows if r["held_out"] and r["toxic"] is not None]
    caught = [r["predicted"] for r in told if r["toxic"] == 1]
    blamed = [r["predicted"] for r in told if r["toxic"] == 0]
    assert sum(caught) / len(caught) >= 0.85 and sum(blamed) / len(blamed) <= 0.03
