"""Toxicity by a small recurrent network over all overlapping windows of a text, trained in numpy.

Words are stretches of letters, digits and signs beyond ASCII, in small letters. A word's input is a learned vector of the
word itself (hashed) beside the mean of learned vectors of its characters in runs of ``GRAMS`` with the word's borders
(hashed). A gated recurrent network reads a window of ``WINDOW`` words from both ends, attention weighs its states, and a
logistic unit scores the weighted sum. Windows begin every ``STRIDE`` words, so each place is read in two contexts; the
last window reaches the end of the text. A text scores as its highest window.

Labels belong to whole texts, so training takes for each text the window that scores highest at the time (and for texts of
label 0 another at random); the first epochs take windows at random. Gradients run back through time by hand; steps are
Adam's. It happens in one task on a bounded sample: at most ``train_rows`` labelled rows (half of each label at most, by
a hash of their ids; of texts that share an id, one) and ``train_bytes`` of text.

The input of a word is the same wherever it stands, so a scoring task computes its share of the gates once and keeps it
up to a bound. Texts pass in segments of some ten thousand words that share no window, so a very long text is scored whole
in bounded memory. Scores are rounded to six digits, since sums of floats depend on what else is in a batch.

Null, empty and wordless texts score 0. Without labelled rows of both labels every score is 0. Labels other than 0 and
1 are left out, as are null ids in labels. Rows are scored independently: repeated rows alike; an empty table gives an
empty result; other columns, of whatever name, are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm import base, words
from rosterline.llm.language_id import fold

WINDOW, STRIDE = 24, 12
HIDDEN, ATTENTION = 12, 8
WORD_ROWS, WORD_SIZE = 1 << 13, 8
GRAMS, GRAM_BITS, GRAM_SIZE = (3, 4, 5), 14, 16
SEGMENT = 50_000  # words
CHUNK = 512  # windows
TABLE = words.table(words.ALPHANUMERIC)


def grams(listed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the runs of 3, 4 and 5 characters that begin in each word, borders marked; and the words' numbers of places."""
    sizes = np.fromiter(map(len, listed), np.int64, len(listed))
    marked = np.frombuffer(b"".join(b"<%b>\0\0" % w for w in listed), np.uint8).astype(np.uint32)
    first = np.cumsum(sizes + 4) - (sizes + 4)
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    code, rows = np.full(len(at), 0x811C9DC5, np.uint32), []
    with np.errstate(over="ignore"):
        for k in range(max(GRAMS)):
            code = (code ^ marked[at + k]) * np.uint32(0x01000193)
            if k + 1 in GRAMS:
                rows.append(((code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS))
    return np.stack(rows), sizes


class Lexicon:
    """Rows of words and their characters for a list of words; place 0 is padding without any."""

    def __init__(self, listed: list[bytes]):
        self.word = np.fromiter((crc32(w) % WORD_ROWS for w in listed), np.int64, len(listed))
        self.gram, self.sizes = grams(listed)
        self.ends = np.cumsum(self.sizes)

    def _at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the characters of words (places less one), and their numbers."""
        sizes = self.sizes[places]
        return np.repeat(self.ends[places] - np.cumsum(sizes), sizes) + np.arange(sizes.sum()), sizes

    def vectors(self, net: dict, places: np.ndarray | None = None) -> np.ndarray:
        """Inputs of the padding and of the words at ``places`` (all by default)."""
        places = np.arange(1, len(self.word) + 1) if places is None else places
        out = np.zeros((len(places) + 1, WORD_SIZE + GRAM_SIZE), net["word"].dtype)
        if len(places):
            at, sizes = self._at(places - 1)
            out[1:, :WORD_SIZE] = net["word"][self.word[places - 1]]
            sums = sum(net["gram"][rows[at]] for rows in self.gram)
            out[1:, WORD_SIZE:] = np.add.reduceat(sums, np.cumsum(sizes) - sizes, axis=0) / (len(GRAMS) * sizes[:, None])
        return out

    def spread(self, places: np.ndarray, gradient: np.ndarray, into: dict) -> None:
        """Add the gradient of the inputs of words at ``places`` (different ones) to the tables' gradients."""
        np.add.at(into["word"], self.word[places - 1], gradient[:, :WORD_SIZE])
        at, sizes = self._at(places - 1)
        each = np.repeat(gradient[:, WORD_SIZE:] / (len(GRAMS) * sizes[:, None]), sizes, axis=0)
        for rows in self.gram:
            np.add.at(into["gram"], rows[at], each)


def fresh(seed: int = 1, kind=np.float32) -> dict:
    """A network with small random weights; gates lie in the order keep, reset, new."""
    draw = np.random.default_rng(seed).normal
    sizes = {
        "word": (WORD_ROWS, WORD_SIZE), "gram": (1 << GRAM_BITS, GRAM_SIZE), "input": (WORD_SIZE + GRAM_SIZE, 6 * HIDDEN), "input_bias": (6 * HIDDEN,),
        "state": (2, HIDDEN, 3 * HIDDEN), "attend": (2 * HIDDEN, ATTENTION), "attend_bias": (ATTENTION,), "weigh": (ATTENTION,), "out": (2 * HIDDEN,), "out_bias": (1,),
    }
    scale = {"word": 0.05, "gram": 0.05, "input_bias": 0.0, "attend_bias": 0.0, "out_bias": 0.0}
    return {k: (draw(size=s) * scale.get(k, s[-2] ** -0.5 if len(s) > 1 else s[0] ** -0.5)).astype(kind) for k, s in sizes.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def forward(net: dict, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logit of each window; ``gates`` (2, words, 3 HIDDEN) are the inputs' shares, ``ids`` (windows, WINDOW) their places.

    With ``keep`` also what ``backward`` needs.
    """
    n, steps = ids.shape
    real = ids != 0
    whole = real.all()
    state = np.zeros((2, n, HIDDEN), gates.dtype)
    states = np.empty((steps, n, 2 * HIDDEN), gates.dtype)
    own = np.empty((2, n, 3 * HIDDEN), gates.dtype)
    kept = []
    for t in range(steps):
        back = steps - 1 - t
        np.take(gates[0], ids[:, t], axis=0, out=own[0])
        np.take(gates[1], ids[:, back], axis=0, out=own[1])
        past = state @ net["state"]
        both = _sigmoid(own[..., : 2 * HIDDEN] + past[..., : 2 * HIDDEN])
        hold, reset = both[..., :HIDDEN], both[..., HIDDEN:]
        new = np.tanh(own[..., 2 * HIDDEN :] + reset * past[..., 2 * HIDDEN :])
        if keep:
            kept.append((state, past[..., 2 * HIDDEN :], hold, reset, new))
        after = new + hold * (state - new)
        state = after if whole else np.where(np.stack([real[:, t], real[:, back]])[..., None], after, state)
        states[t, :, :HIDDEN], states[back, :, HIDDEN:] = state[0], state[1]
    looked = np.tanh(states @ net["attend"] + net["attend_bias"])
    weight = looked @ net["weigh"]
    if not whole:
        weight = np.where(real.T, weight, -1e9)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = (weight[..., None] * states).sum(0)
    logit = pooled @ net["out"] + net["out_bias"]
    return (logit, (kept, real, states, looked, weight, pooled)) if keep else logit


def backward(net: dict, held: tuple, slope: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weights behind the gates, and of each place's gates (WINDOW, windows, 6 HIDDEN)."""
    kept, real, states, looked, weight, pooled = held
    steps, n = len(kept), len(slope)
    grad = {"out": pooled.T @ slope, "out_bias": slope.sum(keepdims=True), "state": np.zeros_like(net["state"])}
    to_pooled = slope[:, None] * net["out"]
    to_weight = (states * to_pooled).sum(-1)
    to_weight = weight * (to_weight - (weight * to_weight).sum(0))
    grad["weigh"] = np.tensordot(to_weight, looked, ([0, 1], [0, 1]))
    to_look = to_weight[..., None] * net["weigh"] * (1 - looked * looked)
    grad["attend"], grad["attend_bias"] = np.tensordot(states, to_look, ([0, 1], [0, 1])), to_look.sum((0, 1))
    to_states = weight[..., None] * to_pooled + to_look @ net["attend"].T
    to_gates = np.empty((steps, n, 6 * HIDDEN), states.dtype)
    to_state, turned = np.zeros((2, n, HIDDEN), states.dtype), net["state"].swapaxes(1, 2)
    for t in reversed(range(steps)):
        back = steps - 1 - t
        before, past, hold, reset, new = kept[t]
        to_state = to_state + np.stack([to_states[t, :, :HIDDEN], to_states[back, :, HIDDEN:]])
        live = np.stack([real[:, t], real[:, back]])[..., None]
        to_after = np.where(live, to_state, 0)
        to_new = to_after * (1 - hold) * (1 - new * new)
        to_hold = to_after * (before - new) * hold * (1 - hold)
        to_reset = to_new * past * reset * (1 - reset)
        into = np.concatenate([to_hold, to_reset, to_new], -1)
        to_gates[t, :, : 3 * HIDDEN], to_gates[back, :, 3 * HIDDEN :] = into[0], into[1]
        into = np.concatenate([to_hold, to_reset, to_new * reset], -1)
        grad["state"] += before.swapaxes(1, 2) @ into
        to_state = np.where(live, 0, to_state) + to_after * hold + into @ turned
    return grad, to_gates


def gates_of(net: dict, vectors: np.ndarray) -> np.ndarray:
    """What the inputs add to the gates of both directions."""
    flat = vectors @ net["input"] + net["input_bias"]
    return np.stack([flat[:, : 3 * HIDDEN], flat[:, 3 * HIDDEN :]])


def gradients(net: dict, lexicon: Lexicon, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean log loss of windows and its gradient by every weight."""
    places, own = np.unique(ids, return_inverse=True)
    if places[0] != 0:
        places, own = np.concatenate([[0], places]), own + 1
    own = own.reshape(ids.shape)
    vectors = lexicon.vectors(net, places[1:])
    logit, held = forward(net, gates_of(net, vectors), own, keep=True)
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    grad, to_gates = backward(net, held, (_sigmoid(logit) - labels) / np.asarray(len(labels), logit.dtype))
    by_place = np.zeros((len(places), 6 * HIDDEN), to_gates.dtype)
    np.add.at(by_place, own.T, to_gates)
    grad["input"], grad["input_bias"] = vectors.T @ by_place, by_place.sum(0)
    grad["word"], grad["gram"] = np.zeros_like(net["word"]), np.zeros_like(net["gram"])
    lexicon.spread(places[1:], (by_place @ net["input"].T)[1:], grad)
    return loss, grad


class Adam:
    def __init__(self, net: dict, first: float = 0.9, second: float = 0.99):
        self.first, self.second, self.t = first, second, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in net.items()} for _ in range(2))

    def step(self, net: dict, grad: dict, rate: float) -> None:
        self.t += 1
        rate *= (1 - self.second**self.t) ** 0.5 / (1 - self.first**self.t)
        for k, g in grad.items():
            self.m[k] += (1 - self.first) * (g - self.m[k])
            self.v[k] += (1 - self.second) * (g * g - self.v[k])
            net[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)


def segments(text: str) -> Iterator[list[bytes]]:
    """The words of a whole text in stretches whose windows together are the windows of the text."""
    held: list[bytes] = []
    for own in words.runs(text.lower().encode("utf-8", "surrogatepass"), TABLE):
        held += own
        while len(held) >= SEGMENT + WINDOW:
            n = SEGMENT // STRIDE
            yield held[: (n - 1) * STRIDE + WINDOW]
            held = held[n * STRIDE :]
    if held:
        yield held


def windows(ids: np.ndarray) -> np.ndarray:
    """All windows of a stretch, the last one padded with zeros."""
    n = 1 if len(ids) <= WINDOW else -(-(len(ids) - WINDOW) // STRIDE) + 1
    padded = np.zeros((n - 1) * STRIDE + WINDOW, ids.dtype)
    padded[: len(ids)] = ids
    return padded[np.arange(n)[:, None] * STRIDE + np.arange(WINDOW)]


def logits(net: dict, gates: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Logits of windows, chunk by chunk; padded windows apart, so that the others need no mask."""
    out, full = np.empty(len(ids), gates.dtype), (ids != 0).all(1)
    for part in (np.flatnonzero(full), np.flatnonzero(~full)):
        for at in range(0, len(part), CHUNK):
            own = part[at : at + CHUNK]
            out[own] = forward(net, gates, ids[own])
    return out


def fit(texts: list[str], labels: list[int], warm: int = 3, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 1) -> dict:
    """A network for texts with words; the highest window of a text carries its label."""
    listed: dict[bytes, int] = {}
    parts, owner = [], []
    for k, text in enumerate(texts):
        for own in segments(text):
            ids = np.fromiter((listed.setdefault(w, len(listed) + 1) for w in own), np.int32, len(own))
            parts.append(windows(ids))
            owner += [k] * len(parts[-1])
    ids, owner, y = np.concatenate(parts), np.array(owner), np.array(labels)
    texts_with, first = np.unique(owner, return_index=True)
    count = np.diff([*first, len(owner)])
    lexicon, net, chance = Lexicon(list(listed)), fresh(seed), np.random.default_rng(seed)
    adam, total = Adam(net), warm + epochs
    for epoch in range(total):
        chosen = first + chance.integers(0, count)
        if epoch >= warm:
            score = logits(net, gates_of(net, lexicon.vectors(net)), ids)
            order = np.lexsort((score, owner))
            highest = order[first + count - 1]
            chosen = np.unique(np.concatenate([highest, chosen[y[texts_with] == 0]]))
        chance.shuffle(chosen)
        for at in range(0, len(chosen), batch):
            own = chosen[at : at + batch]
            _, grad = gradients(net, lexicon, ids[own], y[owner[own]].astype(np.float32))
            adam.step(net, grad, rate * (1 - epoch / total))
    return net


def sample(docs: DataFrame, labels: DataFrame, label_col: str, train_rows: int, train_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """text, label of the rows a network is fitted on."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter("label IN (0, 1) AND doc_id IS NOT NULL").distinct()
    of_each = [marked.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2) for y in (0, 1)]
    chosen = of_each[0].unionByName(of_each[1])
    rows = base.keyed_text(docs, id_col, text_col).filter("text IS NOT NULL").join(chosen, "doc_id")
    single = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # Over at most ``train_rows`` rows.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "label").rowsBetween(Window.unboundedPreceding, 0)
    return single.withColumn("bytes", F.sum(F.octet_length("text")).over(order)).filter(F.col("bytes") <= train_bytes).select("text", "label")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", train_rows: int = 3_000, train_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """The fitted network, None without rows of both labels."""

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group[[any(True for own in segments(t)) for t in group["text"]]].sort_values(["text", "label"])
        if group["label"].nunique() < 2:
            return pd.DataFrame({"net": pd.Series([], dtype=object)})
        stream = io.BytesIO()
        np.savez(stream, **fit(group["text"].tolist(), group["label"].tolist()))
        return pd.DataFrame({"net": [stream.getvalue()]})

    rows = sample(docs, labels, label_col, train_rows, train_bytes, id_col, text_col)
    learned = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "net binary").collect()  # one row of the weights at most
    return dict(np.load(io.BytesIO(learned[0]["net"]))) if learned else None


class Scorer:
    """Scores of texts; the gates' inputs of words are remembered up to ``most`` words."""

    def __init__(self, net: dict, most: int = 200_000):
        self.net, self.most = net, most
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.gates = gates_of(self.net, Lexicon([]).vectors(self.net))
        self.used = 1

    def _learn(self, new: list[bytes]) -> None:
        found = gates_of(self.net, Lexicon(new).vectors(self.net))[:, 1:]
        if self.used + len(new) > self.gates.shape[1]:
            room = np.zeros((2, max(2 * self.used, self.used + len(new)), 3 * HIDDEN), self.gates.dtype)
            room[:, : self.used] = self.gates[:, : self.used]
            self.gates = room
        self.gates[:, self.used : self.used + len(new)] = found
        self.place.update(zip(new, range(self.used, self.used + len(new))))
        self.used += len(new)

    def _highest(self, owners: list[int], lists: list[list[bytes]], out: np.ndarray) -> None:
        every = set().union(*lists)
        if self.used + len(every) > self.most:
            self._forget()
        self._learn([w for w in every if w not in self.place])
        parts = [windows(np.fromiter(map(self.place.__getitem__, own), np.int32, len(own))) for own in lists]
        score = logits(self.net, self.gates, np.concatenate(parts))
        np.maximum.at(out, np.repeat(owners, [len(p) for p in parts]), _sigmoid(score.astype(np.float64)))

    def __call__(self, texts: list[str]) -> np.ndarray:
        out, owners, lists, held = np.zeros(len(texts)), [], [], 0
        for k, text in enumerate(texts):
            for own in segments(text):
                owners.append(k)
                lists.append(own)
                held += len(own)
                if held >= SEGMENT:
                    self._highest(owners, lists, out)
                    owners, lists, held = [], [], 0
        if lists:
            self._highest(owners, lists, out)
        return np.round(out, 6)


def score(docs: DataFrame, net: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every whole text."""
    own = base.keyed_text(docs, id_col, text_col)
    if net is None:
        return own.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in base.pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer(base.texts(batch)), pa.float64())], ["doc_id", "score"])

    return own.mapInArrow(run, "doc_id long, score double")


def held_out_scores(docs: DataFrame, labels: DataFrame, train_rows: int = 3_000) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from the labels that are not held out."""
    net = train(docs, labels.filter(fold("doc_id", 5) != 0), train_rows=train_rows)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return score(docs, net).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
