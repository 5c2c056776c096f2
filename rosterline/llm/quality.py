"""Quality scores by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are words, signs and pairs of neighbours, each hashed to one of 2^18 places; a text is the vector of
log(1 + count) at its places, scaled to length one. Training visits labelled rows one after the other and keeps for each
place the sums of the FTRL-proximal rule (step ``alpha``, ``beta``, penalties ``l1`` and ``l2``). Several learners each
take a share of the rows, dealt by a hash of the id, and their weights are averaged on Spark place by
place, each by the squared gradients it has seen there. At most
about ``train_rows`` labelled rows are used (by a hash of their ids; all below the bound), so a learner's rows are
bounded too. A score is the logistic of one sparse dot product.

The whole text is scored, however long, in memory in proportion to it; a score of 0.5 counts as label 1. Null and empty texts have no features and score by the intercept alone. Without labelled rows
every score is 0.5. Labels that are null are left out; a repeated label row counts twice. Rows are scored
independently: repeated rows alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base
from rosterline.llm.language_id import fold

BITS = 18
PLACES = 1 << BITS
TOKEN = re.compile(r"\w+|[^\w\s]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Sparse vectors of texts; hashes of tokens are remembered up to a bound."""

    def __init__(self):
        self.hashes = base.Remembered(lambda w: xxhash.xxh64_intdigest(w.encode(), 11), 400_000)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = TOKEN.findall(text)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            pairs = (h[:-1] * _ODD) ^ (h[1:] + _ODD)
            pairs = (pairs ^ (pairs >> np.uint64(29))) * _ODD
        places, counts = np.unique(np.concatenate([h, pairs]) >> np.uint64(64 - BITS), return_counts=True)
        values = np.log1p(counts)
        return places.astype(np.int64), values / np.sqrt(values @ values)


class Learner:
    """Sums of the FTRL-proximal rule for all places, the intercept last."""

    def __init__(self, alpha: float = 4.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-4):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z = self.z[places]
        rate = (self.beta + np.sqrt(self.n[places])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def visit(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        places, values = np.append(places, PLACES), np.append(values, 1.0)
        w = self.weights(places)
        gradient = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        squared = self.n[places] + gradient * gradient
        self.z[places] += gradient - (np.sqrt(squared) - np.sqrt(self.n[places])) / self.alpha * w
        self.n[places] = squared


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 20_000, learners: int = 8, epochs: int = 5) -> np.ndarray:
    """Weights of all places, the intercept last."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    n = marked.count()
    if n > train_rows:
        grain = 1 << 30
        marked = marked.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(grain)) < int(grain * train_rows / n))
    rows = base.keyed_text(docs, id_col, text_col).join(marked, "doc_id")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        own, features = Learner(), Features()
        group = group.iloc[np.argsort([xxhash.xxh64_intdigest(str(i), 5) for i in group["doc_id"]], kind="stable")]
        vectors = [features(t or "") for t in group["text"]]
        for _ in range(epochs):
            for (places, values), label in zip(vectors, group["label"]):
                own.visit(places, values, int(label))
        w = own.weights(np.arange(PLACES + 1))
        used = np.flatnonzero(own.n)
        return pd.DataFrame({"place": used, "w": w[used] * own.n[used], "n": own.n[used]})

    share = F.pmod(F.xxhash64(F.lit("learner"), "doc_id"), F.lit(learners)).alias("learner")
    shares = rows.select("doc_id", "text", "label", share)
    learned = shares.groupBy("learner").applyInPandas(learn, "place long, w double, n double")
    summed = learned.groupBy("place").agg((F.sum("w") / F.sum("n")).alias("w")).toPandas()
    weights = np.zeros(PLACES + 1)
    weights[summed["place"].astype("int64")] = summed["w"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        features, w = Features(), shared.value
        for batch in base.pieces(batches):
            sums = []
            for text in base.texts(batch):
                places, values = features(text)
                sums.append(w[places] @ values + w[PLACES])
            scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return base.keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def held_out_scores(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from the labels that are not held out."""
    weights = train(docs, labels.filter(fold("doc_id", 3) != 1), train_rows=train_rows)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return score(docs, weights).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
