"""Aggregation operators. All combine map-side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import semi


def sum_when(test: Column) -> Column:
    """Number of rows that pass ``test``, zero when none."""
    return F.sum(F.when(test, 1).otherwise(0)).cast("bigint")


def group_hidden(df: DataFrame, by: Sequence[str], hidden: Sequence[str], **aggregates: Column) -> DataFrame:
    """Group by more columns than are shown; rows that differ only in a hidden column stay apart."""
    return df.groupBy(*by, *hidden).agg(*[c.alias(n) for n, c in aggregates.items()]).drop(*hidden)


def duplicates(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of whole rows in which null, blank and column order all count."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def dedupe_keep_min(df: DataFrame, by: Sequence[str], key: str, removable: Column | None = None) -> DataFrame:
    """Keep the lowest key of each group of equal rows (nulls are equal); others go if ``removable``.

    Groups form on a digest, so wide values never travel; the survivors come
    back through their key.
    """
    firsts = df.groupBy(row_digest(by).alias("_digest")).agg(F.min(key).alias("_first")).select("_first")
    if removable is None:
        return semi(df, firsts, {key: "_first"})
    flagged = df.join(firsts.withColumn("_is_first", F.lit(True)), df[key] == firsts["_first"], "left").drop("_first")
    return flagged.filter(F.col("_is_first") | ~F.coalesce(removable, F.lit(False))).drop("_is_first")


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: rows on the left, and how many have an identical row of the same key on the right.

    Digests travel as bytes, half as long as their hexadecimal text.
    """
    digest = F.unhex(row_digest(columns))
    a = left.select(F.col(key).alias("_ka"), digest.alias("_da"))
    b = right.select(F.col(key).alias("_kb"), digest.alias("_db"))
    return a.join(b, F.col("_ka") == F.col("_kb"), "left").agg(
        F.count(F.lit(1)).alias("total_rows"), sum_when(F.col("_da") == F.col("_db")).alias("matched_rows")
    )


def high_water(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Largest key per table and the next one to hand out."""
    out = None
    for name, (df, key) in tables.items():
        part = df.agg(F.max(F.col(key).cast("bigint")).alias("max_key")).select(
            F.lit(name).alias("table_name"), "max_key", (F.coalesce("max_key", F.lit(0)) + 1).alias("next_key")
        )
        out = part if out is None else out.unionByName(part)
    return out


def overlap_counts(
    df: DataFrame, entity: str, start: str, end: str, key: str, name: str = "conflicts", unique_key: bool = False
) -> DataFrame:
    """Number of ordered pairs of overlapping intervals per entity, without forming the pairs.

    An interval meets every interval that starts by its end, except those that
    ended before its start. Counts of starts and ends are first combined per
    (entity, moment). Running totals go in two levels: over the days of an entity (as many rows as its calendar has days),
    and over the moments of one day; so no task holds an entity with many rows. Repeats of a row (same
    key and interval) do not pair; with ``unique_key`` no interval repeats and one exchange is saved.
    """
    valid = df.filter(F.col(start) <= F.col(end))
    if unique_key:
        whole = valid.select(entity, start, end, F.lit(1).cast("bigint").alias("_c"))
    else:
        whole = valid.groupBy(entity, key, start, end).agg(F.count(F.lit(1)).alias("_c"))
    moments = whole.select(
        entity,
        F.inline(
            F.array(
                F.struct(
                    F.col(start).alias("_at"), F.col("_c").alias("_s"), F.lit(0).cast("bigint").alias("_e"),
                    (F.col("_c") * F.col("_c")).alias("_own"),
                ),
                F.struct(
                    F.col(end).alias("_at"), F.lit(0).cast("bigint").alias("_s"), F.col("_c").alias("_e"),
                    F.lit(0).cast("bigint").alias("_own"),
                ),
            )
        ),
    )
    points = moments.groupBy(entity, "_at").agg(
        F.sum("_s").alias("_s"), F.sum("_e").alias("_e"), F.sum("_own").alias("_own")
    )
    dates_only = all(isinstance(df.schema[c].dataType, T.DateType) for c in (start, end))
    keys = [entity]
    if not dates_only:
        points = points.withColumn("_day", F.col("_at").cast("date"))
        keys = [entity, "_day"]
        days = points.groupBy(*keys).agg(F.sum("_s").alias("_ds"), F.sum("_e").alias("_de"))
        earlier = Window.partitionBy(entity).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
        sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n) for c, n in (("_ds", "_before_s"), ("_de", "_before_e"))]
        points = points.join(days.select(*keys, *sums), keys)
    upto = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    started, ended = F.sum("_s").over(upto), F.sum("_e").over(upto) - F.col("_e")
    if not dates_only:
        started, ended = started + F.col("_before_s"), ended + F.col("_before_e")
    running = points.withColumns({"_started": started, "_ended": ended})
    total = F.sum(F.col("_e") * F.col("_started") - F.col("_s") * F.col("_ended") - F.col("_own"))
    return running.groupBy(entity).agg(total.cast("bigint").alias(name)).filter(F.col(name) > 0)
