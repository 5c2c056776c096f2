"""Importance resampling towards a target: documents drawn by the log-ratio of hashed n-gram frequencies plus Gumbel noise.

Features are the runs of one and two consecutive words (letters, digits and signs beyond ASCII, A-Z in small letters),
repeats included; a feature's bucket is the crc32 of its UTF-8 bytes modulo ``BUCKETS``. The crc of a pair goes on from its
first word's. Bucket counts of the whole corpus and of the whole target (``BUCKETS`` numbers each, whatever the input)
give each bucket an integer gain.

A document's weight is the floored mean gain of its features, by bit-sliced aggregation: its bucket counts become planes
of ``BUCKETS`` bits, plane k holding bit k of every count; the gains are planes too, positive and negative apart. The sum
of count times gain is the sum over pairs of planes of 2^(j+k) times the population count of their AND: exact integers
at any length of text.

Noise comes from a digest of seed and id, so scores do not depend on the layout of the input. Ranks are places in one range
shuffle of narrow rows, sorted inside the partitions, plus the sizes of the partitions before; a row number written
before tells equal rows apart, so a value that many rows share still spreads.

Null and empty texts have no features and weight 0, and take no part in the draw (nor does any text under ``least_words``
words). A null id is the empty text in the digest and comes after other ids in ties. Repeated rows have equal scores and
ranks one after the other, the one with fewer features first. Very long texts are taken in stretches, whole. An empty
corpus gives an empty result; an empty target draws towards even frequencies. Other columns, of whatever name, are
not read.
"""

from __future__ import annotations

import hashlib
import math
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm import base, words

BUCKETS = 10_000
WORDS = words.table(words.ALPHANUMERIC)
_PLANE = -(-BUCKETS // 64) * 8  # bytes


def buckets(text: bytes) -> tuple[np.ndarray, int]:
    """How many features fall to each bucket, and the number of words."""
    counts, n, last = np.zeros(BUCKETS, np.int64), 0, None
    for own in words.runs(text, WORDS):
        if not own:
            continue
        single = list(map(crc32, own))
        before = single[:-1] if last is None else [last, *single[:-1]]
        spaced = map(crc32, repeat(b" "), before)
        pairs = list(map(crc32, own if last is not None else own[1:], spaced))
        counts += np.bincount(np.array(single + pairs, np.int64) % BUCKETS, minlength=BUCKETS)
        n, last = n + len(own), single[-1]
    return counts, n


def totals(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features in each bucket over all rows."""

    def run(batches):
        sums = np.zeros(BUCKETS, np.int64)
        for batch in base.pieces(batches):
            for text in words.encoded(batch):
                sums += buckets(text)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS), pa.int32()), pa.array(sums, pa.int64())], ["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.collect():  # one row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed frequency in the target over that in the corpus) of each bucket."""
    s_all, t_all = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    ratio = [float(t + 1) * s_all / (float(s + 1) * t_all) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit k of every value (none negative) in row k, 64 to a word."""
    k = int(values.max(initial=0)).bit_length()
    bits = (values[None, :] >> np.arange(k)[:, None]) & 1
    packed = np.zeros((k, _PLANE), np.uint8)
    packed[:, : -(-BUCKETS // 8)] = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")
    return packed.view(np.uint64)


class Gains:
    """Signed gain planes and the power of two of each."""

    def __init__(self, values: np.ndarray):
        up, down = planes(np.maximum(values, 0)), planes(np.maximum(-values, 0))
        self.planes = np.concatenate([up, down])
        self.powers = np.array([*(1 << j for j in range(len(up))), *(-(1 << j) for j in range(len(down)))], np.int64)

    def total(self, counts: np.ndarray) -> int:
        """Exact sum of count times gain."""
        own, out = planes(counts), 0
        for k in range(len(own)):
            ones = np.bitwise_count(own[k] & self.planes).sum(1, dtype=np.int64)
            out += int(ones @ self.powers) << k
        return out


def noise(key: str, seed: int) -> int:
    """floor of 1000 times a Gumbel value that the digest of seed and id gives."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gains_now = Gains(shared.value)
        for batch in base.pieces(batches):
            out = []
            for key, text in zip(batch.column("doc_id").to_pylist(), words.encoded(batch)):
                counts, n_words = buckets(text)
                n = int(counts.sum())
                weight = gains_now.total(counts) // n if n else 0
                out.append((key, n_words, n, weight, weight + noise("" if key is None else str(key), seed)))
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 5)], names)

    return base.keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank 1, 2, ... of those drawn, best first."""
    gain = gains(totals(docs, text_col), totals(target))
    scored = weigh(docs, gain, seed, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    scored = base.staged(scored.withColumn("short", F.col("n_words") < least_words), "weights")
    drawn = percent * scored.filter("NOT short").count() // 100
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["short", F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "row"]
    ordered = scored.repartitionByRange(width, *order).sortWithinPartitions(*order)
    # Numbered while they are written: partition in the upper bits, place in the lower 33.
    placed = base.staged(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each partition
    first = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = placed.withColumn("part", part).join(first, "part").withColumn("rank", F.col("first") + place + 1)
    rank = F.when(~F.col("short") & (F.col("rank") <= drawn), F.col("rank"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
