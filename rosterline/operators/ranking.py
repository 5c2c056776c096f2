"""Ranking, top-k and sampling.

"Best per key" is an aggregate plus a join on (key, order) rather than a
window: the aggregate combines map-side, and the join spreads a hot key's rows
over its order values, so no task ever sorts a whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _with_order(df: DataFrame, key: Sequence[str], order: Sequence[Column], lowest: bool) -> DataFrame:
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    pick = F.min if lowest else F.max
    keyed = df.withColumn("_rank", rank)
    best = keyed.groupBy(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(key)]).agg(pick("_rank").alias("_best"))
    test = keyed["_rank"] == best["_best"]
    for i, k in enumerate(key):
        test = test & keyed[k].eqNullSafe(best[f"_k_{i}"])
    return keyed.join(best.withColumn("_is_best", F.lit(True)), test, "left").drop(
        "_rank", "_best", *[f"_k_{i}" for i in range(len(key))]
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of rank 1 in ascending ``order``; ties all stay."""
    return _with_order(df, key, order, True).filter(F.col("_is_best")).drop("_is_best")


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of rank 1 in descending ``order``; ties all stay."""
    return _with_order(df, key, order, False).filter(F.col("_is_best")).drop("_is_best")


def beaten_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows that rank behind the first of their key."""
    return _with_order(df, key, order, True).filter(F.col("_is_best").isNull()).drop("_is_best")


def latest_row_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exactly one row per key, the last by a total ``order``; a single partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def seeded_sample(df: DataFrame, key: Sequence[str], k: int, seed: int) -> DataFrame:
    """``k`` rows in an order fixed by the seed; the same rows whatever the partitioning."""
    picked = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    return df.orderBy(picked, *key).limit(k)
