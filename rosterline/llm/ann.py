"""Nearest vectors by cosine with cross-polytope hashing and multiprobe tables.

A hash turns a unit vector by a fast pseudo-rotation (three rounds of random signs and a Hadamard transform, for each
table its own) and takes the signed axis it comes nearest to. Rows are dealt to shards of about ``shard_rows``; each
shard keeps ``tables`` tables from signed axis to rows. A query probes in each table the ``probes`` axes it comes
nearest to; rows found in any table are its candidates and are ranked by exact cosine in double precision. Every shard
returns its best ``k`` for each query, and the best of all shards are the result: shards are searched independently
(blocks of queries against blocks of rows), so no task holds more than one block of each, and what is shuffled is rows
times query blocks, queries times shards, and k rows for each query and shard.

All rows are indexed and the hash is fitted to nothing. Of rows with equal vectors only the k + 1 of smallest id can be
among the k nearest of anything, so further copies leave the candidates beforehand without loss, however many there are.
The result is approximate in what it finds: tables and probes are set for vectors that have no close neighbours, where
recall against brute force is over 0.9 (see README); scores and order of what is found are exact, ties to the smaller id.

Null or zero vectors, those with null or non-finite components, of another length than ``dims`` (by default the
commonest length), and rows with a null id take no part. Repeated ids are separate candidates, except that a query never
finds its own id. Where the tables of a shard give too few rows, all of the shard are candidates: with fewer than ``k`` other rows all
of those are returned. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, length a power of two, scaled to keep lengths."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
        x = x.reshape(n, width)
    return x / np.sqrt(width)


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-rotation number ``table`` of the rows, padded to a power of two."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng([SEED, table, width]).integers(0, 2, (3, width)) * 2.0 - 1
    for s in signs:
        out = hadamard(out * s)
    return out


def nearest_axis(x: np.ndarray, table: int) -> np.ndarray:
    """Signed axis of each row: the axis, plus the width if negative."""
    turned = rotated(x, table)
    axis = np.abs(turned).argmax(1)
    return axis + np.where(turned[np.arange(len(x)), axis] < 0, turned.shape[1], 0)


def probed_axes(x: np.ndarray, table: int, probes: int) -> np.ndarray:
    """reached[query, signed axis]: the ``probes`` signed axes nearest to each query."""
    turned = rotated(x, table)
    both = np.concatenate([turned, -turned], axis=1)
    probes = min(probes, both.shape[1])
    reached = np.zeros(both.shape, bool)
    np.put_along_axis(reached, np.argpartition(-both, probes - 1, axis=1)[:, :probes], True, axis=1)
    return reached


class Shard:
    """Tables over a block of rows: ids, vectors and for each table the signed axis of each row."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, tables: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lengths = np.sqrt((self.vectors * self.vectors).sum(1))
        self.units = self.vectors / self.lengths[:, None]
        self.axes = [nearest_axis(self.units, t) for t in range(tables)]

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, probes: int, step: int = 256) -> Iterator[tuple[int, int, float]]:
        """(query, row, score) of the best k candidates of each query."""
        for at in range(0, len(ids), step):
            own, some = ids[at : at + step], vectors[at : at + step]
            lengths = np.sqrt((some * some).sum(1))
            units = some / lengths[:, None]
            candidate = np.zeros((len(own), len(self.ids)), bool)
            for table, axes in enumerate(self.axes):
                candidate |= probed_axes(units, table, probes)[:, axes]
            candidate[candidate.sum(1) <= k] = True  # tables that give too few rows give all of the shard
            candidate &= own[:, None] != self.ids[None, :]
            rough = np.where(candidate, units @ self.units.T, -np.inf)
            kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(own), -np.inf)
            for q in range(len(own)):
                # Rough scores differ from exact ones in the last places only; ties are settled on exact ones.
                near = np.flatnonzero(candidate[q] & (rough[q] >= kth[q] - 1e-9))
                exact = (self.vectors[near] * some[q]).sum(1) / (self.lengths[near] * lengths[q])
                for i in np.lexsort((self.ids[near], -exact))[:k]:
                    yield int(own[q]), int(self.ids[near[i]]), float(exact[i])


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def search(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", dims: int | None = None, tables: int = 12, probes: int = 8, shard_rows: int = 4096, query_block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows of which ``is_query`` (over vec_id, vector) holds."""
    df = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    df = df.filter(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))
    if dims is None:
        first = df.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
        dims = first["dims"] if first else 0
    df = df.filter(F.size("vector") == dims)
    n = df.count()
    shards, query_blocks = max(1, -(-n // shard_rows)), max(1, -(-df.filter(is_query).count() // query_block))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    candidates = df.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).select("vec_id", "vector")
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = candidates.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.lit("row")), F.lit(shards)).cast("int").alias("shard"), spread(query_blocks).alias("block"))
    right = df.filter(is_query).select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(query_blocks)).cast("int").alias("block"), spread(shards).alias("shard"))

    def cell(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if own.empty or asked.empty:
            return pd.DataFrame({x: [] for x in names})
        shard = Shard(own["vec_id"].to_numpy(), np.stack(own["vector"].to_numpy()), tables)
        return pd.DataFrame(shard.search(asked["vec_id"].to_numpy(), np.stack(asked["vector"].to_numpy()), k, probes), columns=names)

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(cell, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
