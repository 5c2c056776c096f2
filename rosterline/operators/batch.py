"""Composite writers: decide per request, purge by batch, backfill, repair versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .aggregates import dedupe_keep_min
from .changes import ChangeSet
from .joins import _on, _pairs, adjacent_versions, anti, blank_safe_columns, first_match, semi
from .ranking import top_k


def classify_requests(
    requests: DataFrame, target: DataFrame, on: Sequence[str] | Mapping[str, str], is_open: Column, reopenable: Column,
    name: str = "decision",
) -> DataFrame:
    """``reopen`` when a reopenable row exists, ``ignore`` when an open one does, else ``insert``.

    The target is reduced to two flags per key before the join.
    """
    pairs = _pairs(on)
    state = target.groupBy(*[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())]).agg(
        F.bool_or(F.coalesce(is_open, F.lit(False))).alias("_open"),
        F.bool_or(F.coalesce(reopenable, F.lit(False))).alias("_reopen"),
    )
    joined = requests.join(state, _on(requests, state, pairs, False), "left")
    decision = F.when(F.col("_reopen"), "reopen").when(F.col("_open"), "ignore").otherwise("insert")
    return joined.select(*[requests[c] for c in requests.columns], decision.alias(name))


def batch_verdicts(rows: DataFrame, batch: str, wanted: Column, violations: Mapping[str, Column]) -> DataFrame:
    """Batches with a wanted row, one flag per violation; one partial aggregate over all batches."""
    flags = {n: F.bool_or(F.coalesce(v, F.lit(False))) for n, v in violations.items()}
    return (
        rows.groupBy(batch)
        .agg(F.bool_or(F.coalesce(wanted, F.lit(False))).alias("_wanted"), *[c.alias(n) for n, c in flags.items()])
        .filter("_wanted")
        .drop("_wanted")
    )


def backfill_key(
    target: DataFrame,
    key: str,
    row_id: str,
    candidates: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    candidate_key: str,
    order: Sequence[Column],
    owner: Sequence[str],
    limit: int | None = None,
) -> ChangeSet:
    """Fill a missing key with the first candidate: every row, or the newest ``limit`` rows where a caller wants batches.

    A candidate key already held by the same owner is not used again, and of
    several rows of one owner that would get the same key the newest wins.
    """
    open_rows = target.filter(F.col(key).isNull())
    matched = first_match(open_rows, candidates, on, order, {"_new_key": candidate_key})
    free = anti(matched, target.filter(F.col(key).isNotNull()), {**{c: c for c in owner}, "_new_key": key})
    winners = free.groupBy(*owner, "_new_key").agg(F.max(row_id).alias("_id")).select("_id", "_new_key")
    chosen = winners if limit is None else top_k(winners, [F.col("_id").desc()], limit)
    joined = target.join(chosen, target[row_id] == chosen["_id"], "left")
    filled = F.coalesce(F.col("_new_key").cast(target.schema[key].dataType), target[key]).alias(key)
    result = joined.select(*[filled if c == key else target[c] for c in target.columns], F.col("_id").isNotNull().alias("_hit"))
    return ChangeSet(result.drop("_hit"), result.filter("_hit").drop("_hit").withColumn("action", F.lit("UPDATE")))


def repair_versions(
    df: DataFrame,
    row_id: str,
    same: Sequence[str],
    group: Sequence[str],
    start: str,
    end: str,
    status: str,
    eligible: Column,
    match: Sequence[str] | None = None,
    active: str = "A",
    inactive: str = "I",
) -> ChangeSet:
    """Merge a current version into its identical predecessor that ended the day before.

    1. find active open-ended rows with such a predecessor; 2. delete active
    open-ended rows equal to them; 3. purge inactive duplicates, keeping the lowest id per
    ``group`` and end; 4. re-open the predecessors. Steps 2 and 4 compare
    ``match`` (default ``same``). Run again while changes remain.
    """
    match = list(match or same)
    open_now = (F.col(status) == active) & F.col(end).isNull()
    found = adjacent_versions(df, same, start, end, open_now & eligible, F.col(status) == inactive)
    names = [f"_k_{c}" for c in match]
    # Read by steps 2 and 4; what step 3 leaves is read by step 4 and by the log.
    found_keys = stage(found.select(*blank_safe_columns(match), F.col(start).cast("date").alias("_start")).distinct(), "found")

    keyed = df.withColumns(dict(zip(names, blank_safe_columns(match))))
    doomed_probe = keyed.filter(F.col(end).isNull()).withColumn("_start", F.col(start).cast("date"))
    doomed = semi(doomed_probe, found_keys, [*names, "_start"]).select(row_id)
    remaining = anti(df, doomed, [row_id])

    purged = stage(dedupe_keep_min(remaining, [*group, end], row_id, F.col(status) == inactive), "purged")

    probe = purged.withColumns(dict(zip(names, blank_safe_columns(match)))).withColumn(
        "_start", F.date_add(F.col(end).cast("date"), 1)
    )
    flags = found_keys.select(*[F.col(n).alias(f"_f{n}") for n in names], F.col("_start").alias("_fstart"))
    test = probe["_start"] == flags["_fstart"]
    for n in names:
        test = test & (probe[n] == flags[f"_f{n}"])
    flagged = probe.join(flags.withColumn("_reopen", F.lit(True)), test, "left")
    reopen = F.coalesce(F.col("_reopen"), F.lit(False))
    cols = []
    for c in df.columns:
        value = probe[c]
        if c == end:
            value = F.when(~reopen, probe[c])
        elif c == status:
            value = F.when(reopen, F.lit(active)).otherwise(probe[c])
        cols.append(value.alias(c))
    final = flagged.select(*cols, reopen.alias("_reopen"))

    log = (
        doomed.select(row_id, F.lit("DELETE").alias("action"))
        .unionByName(anti(remaining, purged, [row_id]).select(row_id, F.lit("PURGE").alias("action")))
        .unionByName(final.filter("_reopen").select(row_id, F.lit("REOPEN").alias("action")))
    )
    return ChangeSet(final.drop("_reopen"), log)
