"""Row keys and person keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pad_person_id
from ..staging import stage
from .joins import _distinct_keys


def with_row_key(df: DataFrame, order: Sequence[Column | str], name: str = "row_key", base: Column | int = 0) -> DataFrame:
    """Dense keys ``base + 1 ..`` in the given order, without a one-task window.

    The rows are staged once, each with a place. Only the order's columns and the place are dealt to ranges and sorted; the
    rows come back by their place. Equal rows of the order are told apart by a digest of the whole row and then
    by place, so a value that many rows share still spreads over partitions. The only window runs over one row per
    partition.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = stage(df.withColumns({"_digest": digest, "_place": F.monotonically_increasing_id()}), "rows")
    order = [*order, F.col("_digest"), F.col("_place")]
    # Numbered while they are written: partition in the upper bits, place in the range in the lower 33.
    ranged = rows.repartitionByRange(width, *order).sortWithinPartitions(*order)
    placed = stage(ranged.select(F.col("_place").alias("_at_place"), F.monotonically_increasing_id().alias("_at")), "places")
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the staged places: bounded by the partition count.
    keyed = placed.select("_at_place", part.alias("_part"), within.alias("_within")).join(F.broadcast(offsets), "_part")
    keyed = keyed.select("_at_place", (F.col("_offset") + F.col("_within") + 1).alias("_key"))
    base = F.lit(base) if isinstance(base, int) else base
    joined = rows.join(keyed, F.col("_place") == F.col("_at_place"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (base + F.col("_key")).cast("bigint").alias(name))


def fix_person_id(df: DataFrame, column: str, people: DataFrame, key: str, name: str) -> DataFrame:
    """Person key repaired from loose text; null when no such person exists."""
    padded = df.withColumn("_id", pad_person_id(column))
    keys = _distinct_keys(people, {"_id": key})
    joined = padded.join(keys, padded["_id"] == keys["_r_0"], "left")
    return joined.select(*[padded[c] for c in df.columns], F.col("_r_0").alias(name))
