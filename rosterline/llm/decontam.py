"""Benchmark items in texts: SimHash fingerprints of windows as long as the item, then exact similarity.

Words are stretches of letters and digits in small letters. Items and windows are multisets of shingles of five words
(an item of fewer words is one shingle); a fingerprint bit is set if it is set in over half of the shingles' hashes,
repeats included. A window of an item's length is a candidate if its fingerprint lies within ``RADIUS`` bits of the
item's. Candidates come from a multi-index: eight blocks of eight bits, of which at least one differs in no more than
RADIUS // 8 bits, so the blocks guarantee all fingerprints within the radius. They are verified by the weighted
similarity of the two multisets, the sum of smaller counts over the sum of larger counts, at ``least`` (0.8) or more.

A text with fewer shingles than an item, but at least 0.8 of them, is compared with it as one window.

Only windows that can pass are looked at: a similarity of 0.8 needs 0.8 of the item's shingles in the window, so a
window is skipped, without loss, where fewer of its shingles occur in the benchmark at all.

The benchmark is taken in blocks whose size is checked (``block_items`` rows and ``block_chars`` characters).
``PASS_BLOCKS`` of them at most go to every executor for one pass over the documents, and each worker builds each block's tables
once; more blocks take more passes. Documents are never shuffled. A radius of 24 of 64 bits leaves out a window of similarity
0.8 about once in a hundred thousand.

Nulls and texts without words match nothing. Very long texts are searched whole, their windows in steps of bounded size. Each row is judged alone: repeated rows and items give repeated results,
an empty table on either side an empty one. The best window is the one of the highest similarity, then the first.
Other columns are not read (``clean`` returns them unchanged).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base

WORD = re.compile(r"[^\W_]+")
WIDTH = 5
RADIUS = 24
BLOCKS = 8
PASS_BLOCKS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.arange(256, dtype=np.uint8)
#: near[a, b]: the bytes a and b differ in RADIUS // BLOCKS bits at most.
_NEAR = np.bitwise_count(_BYTES[:, None] ^ _BYTES[None, :]) <= RADIUS // BLOCKS


class Words:
    """Hashes of the words of a text, remembered up to a bound."""

    def __init__(self):
        self.hashes = base.Remembered(lambda w: xxhash.xxh64_intdigest(w.encode(), 3), 400_000)

    def __call__(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every stretch of ``width`` words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out = (out ^ words[k : k + n]) * _ODD
            out ^= out >> np.uint64(31)
        return out


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def packed(ones: np.ndarray, total: int) -> np.ndarray:
    """Fingerprints of rows of 64 bit counts."""
    return np.packbits(2 * ones > total, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Smaller over larger counts of two multisets of hashes."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    return common / (len(a) + len(b) - common)


class Items:
    """A block of the benchmark: items by length, their fingerprints in blocks, and all their shingles."""

    def __init__(self, rows: list[tuple[int, str]], least: float = 0.8):
        self.least = least
        self.words = Words()
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in rows:
            words = self.words(text or "")
            if len(words):
                by_length.setdefault(len(words), []).append((item, shingles(words, min(WIDTH, len(words)))))
        self.by_length = {}
        owners: dict[int, dict[int, set[int]]] = {}
        for length, items in by_length.items():
            prints = np.concatenate([packed(bits_of(s).sum(0, dtype=np.int64)[None, :], len(s)) for _, s in items])
            # For each block and byte value the items within reach of it.
            reach = _NEAR[:, prints.view(np.uint8).reshape(-1, 8)]  # value, item, block
            self.by_length[length] = ([i for i, _ in items], [s for _, s in items], prints, np.ascontiguousarray(reach.transpose(2, 0, 1)))
            for _, s in items:
                for h in s.tolist():
                    owners.setdefault(min(WIDTH, length), {}).setdefault(h, set()).add(length)
        # By shingle width: sorted hashes, the lengths of their items, and a small table that most others miss.
        self.known = {}
        for width, lengths in owners.items():
            keys = np.array(sorted(lengths), np.uint64)
            table = np.zeros(1 << 20, bool)
            table[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.known[width] = (keys, [sorted(lengths[k]) for k in keys.tolist()], table)

    def find(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window of each item found."""
        words = self.words(text)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for width, (keys, lengths, table) in self.known.items():
            hashes = shingles(words, width)
            likely = np.flatnonzero(table[(hashes >> np.uint64(44)).astype(np.int64)])
            if not len(likely):
                continue
            at = np.minimum(np.searchsorted(keys, hashes[likely]), len(keys) - 1)
            there = keys[at] == hashes[likely]
            hits, at = likely[there], at[there]
            if not len(hits):
                continue
            held = np.zeros(len(hashes) + 1, np.int64)
            held[hits + 1] = 1
            held = np.cumsum(held)
            spots: dict[int, list[int]] = {}
            for hit, k in zip(hits.tolist(), at.tolist()):
                for length in lengths[k]:
                    spots.setdefault(length, []).append(hit)
            for length, where in spots.items():
                size = length - width + 1
                if size > len(hashes) >= self.least * size - 1e-9:
                    size = len(hashes)  # the whole text is the one window
                self._windows(hashes, held, length, size, np.array(where), best)
        return [(self.by_length[length][0][k], sim, start, min(length, len(words))) for (length, k), (sim, start) in sorted(best.items())]

    def _windows(self, hashes, held, length, size, hits, best) -> None:
        """Windows of ``size`` shingles that hold a hit and enough shingles of the benchmark."""
        last = len(hashes) - size
        if last < 0:
            return
        mark = np.zeros(last + 2, np.int64)
        np.add.at(mark, np.clip(hits - size + 1, 0, last + 1), 1)
        np.add.at(mark, np.clip(hits + 1, 0, last + 1), -1)
        starts = np.flatnonzero((np.cumsum(mark)[:-1] > 0) & (held[size:] - held[: last + 1] >= self.least * size - 1e-9))
        ids, multisets, prints, reach = self.by_length[length]
        step = max(1, 4_000_000 // (64 * max(1, len(ids))))
        for at in range(0, len(starts), step):
            some = starts[at : at + step]
            # Running bit counts over each stretch of the text that its windows span.
            for stretch in np.split(some, np.flatnonzero(np.diff(some) > size) + 1):
                low, high = int(stretch[0]), int(stretch[-1]) + size
                sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(bits_of(hashes[low:high]), axis=0, dtype=np.int64)])
                found = packed(sums[stretch - low + size] - sums[stretch - low], size)
                values = found.view(np.uint8).reshape(-1, 8)
                candidate = np.zeros((len(stretch), len(ids)), bool)
                for block in range(BLOCKS):
                    candidate |= reach[block, values[:, block]]
                candidate &= np.bitwise_count(found[:, None] ^ prints[None, :]) <= RADIUS
                for w, k in zip(*np.nonzero(candidate)):
                    start = int(stretch[w])
                    sim = similarity(hashes[start : start + size], multisets[k])
                    if sim >= self.least and (-sim, start) < (-best.get((length, k), (0.0, 0))[0], best.get((length, k), (0.0, 0))[1]):
                        best[length, k] = (sim, start)


class Shared:
    """Blocks of one pass that travel as their rows; each block's tables are built once in each Python worker."""

    built = 0  # tables built in this worker

    def __init__(self, spark, listed: list[list[tuple[int, str]]], least: float):
        self.least, self.name = least, uuid.uuid4().hex
        self.rows = [spark.sparkContext.broadcast(rows) for rows in listed]

    def items(self) -> list[Items]:
        return base.worker_state(self.name, self._build)

    def _build(self) -> list[Items]:
        Shared.built += len(self.rows)
        return [Items(rows.value, self.least) for rows in self.rows]


def passes(spark, benchmark: DataFrame, item_col: str, text_col: str, least: float, **bounds) -> Iterator[Shared]:
    held: list[list[tuple[int, str]]] = []
    for rows in blocks(benchmark, item_col, text_col, **bounds):
        held.append(rows)
        if len(held) == PASS_BLOCKS:
            yield Shared(spark, held, least)
            held = []
    if held:
        yield Shared(spark, held, least)


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_items: int = 20_000, block_chars: int = 32_000_000) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of checked size, dealt by a hash of the item."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, -(-n // block_items), -(-chars // block_chars))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for k in range(parts if n else 0):
        yield [tuple(r) for r in rows.filter(part == k).collect()]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.8, **bounds) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words for every item of ``benchmark`` found in a text of ``docs``; ``bounds`` of ``blocks``."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, similarity double, start_word long, n_words long"
    parts: list[DataFrame] = []
    for shared in passes(spark, benchmark, item_col, item_text_col, least, **bounds):

        def body(batch, shared=shared):
            held = shared.items()
            found = [(key, *hit) for key, text in zip(batch.column("doc_id").to_pylist(), base.texts(batch)) for items in held for hit in items.find(text)]
            columns = list(zip(*found)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "similarity", "start_word", "n_words"])

        parts.append(base.map_batches(base.keyed_text(docs, id_col, text_col), body, schema, shared.name))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.8, **bounds) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay. What a pass leaves is staged for the next one."""
    base.small_batches(docs.sparkSession)
    for k, shared in enumerate(passes(docs.sparkSession, benchmark, item_col, item_text_col, least, **bounds)):
        docs = (base.staged(docs, "clean") if k else docs).filter(_free(shared)(F.col(f"`{text_col}`")))
    return docs


def _free(shared: Shared):
    @F.pandas_udf("boolean")
    def free(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with base.task(shared.name):
            for text in texts:
                held = shared.items()
                yield pd.Series([not any(items.find(t or "") for items in held) for t in text], dtype=bool)

    return free
