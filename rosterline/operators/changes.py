"""Writers as pure functions from a state and an input to a new state and its changes.

Nothing is written here. The caller checks the change-sets (``require_none``),
looks at them (``preview``) and writes them to a new run path (``write_run``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day, moment
from .joins import _on, _pairs, anti, semi
from .keys import with_row_key


@dataclass(frozen=True)
class ChangeSet:
    """New contents of a table, and one row per change with its ``action``.

    ``tagged``, where a writer has it, holds both in one plan: all rows with their ``action`` (null: unchanged, DELETE: not in
    the new contents). ``repeated``, where a writer takes values from a source, holds the source keys that occur more than
    once; such a source would multiply rows, so ``write_run`` refuses it.
    """

    new_state: DataFrame
    changes: DataFrame
    tagged: DataFrame | None = None
    repeated: DataFrame | None = None


class RunAborted(Exception):
    """A check failed before anything was written."""


def preview(changes: DataFrame, by: Sequence[str] = ("action",)) -> DataFrame:
    """Number of changes per action; the dry run of a writer."""
    return changes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def require_none(checks: Mapping[str, DataFrame], shown: int = 20) -> None:
    """Stop the run when any check yields a row; the message lists a few of them."""
    for name, bad in checks.items():
        rows = bad.limit(shown).collect()
        if rows:
            raise RunAborted(f"{name}: " + "; ".join(str(r.asDict()) for r in rows))


def repeated_keys(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null match nothing and are left out."""
    return source.select(*key).dropna().groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def from_tagged(tagged: DataFrame, repeated: DataFrame | None = None) -> ChangeSet:
    """The change-set of rows that carry their action."""
    kept = tagged.filter(F.col("action").isNull() | (F.col("action") != "DELETE")).drop("action")
    return ChangeSet(kept, tagged.filter(F.col("action").isNotNull()), tagged, repeated)


def write_run(changesets: Mapping[str, ChangeSet], path: str) -> None:
    """Write every new state and change log under a new run path; sources that repeat a key stop the run before any write.

    A writer with a ``tagged`` plan runs once, to ``tagged/<name>``; state and changes are split off that table.
    """
    require_none({f"{n}: repeated source key": c.repeated for n, c in changesets.items() if c.repeated is not None})
    for name, c in changesets.items():
        if c.tagged is not None:
            c.tagged.write.mode("errorifexists").parquet(f"{path}/tagged/{name}")
            c = from_tagged(c.tagged.sparkSession.read.schema(c.tagged.schema).parquet(f"{path}/tagged/{name}"))
        c.new_state.write.mode("errorifexists").parquet(f"{path}/state/{name}")
        c.changes.write.mode("errorifexists").parquet(f"{path}/changes/{name}")


def audit_log(
    before: DataFrame, after: DataFrame, key: Sequence[str], columns: Sequence[str], process: str, at: datetime, operator: str
) -> DataFrame:
    """One row per changed key: action, images of ``columns`` before and after (JSON), process, time and operator.

    Both states are tagged and combined per key in one aggregate; keys are unique in each state.
    """

    def tagged(df: DataFrame, name: str) -> DataFrame:
        other = {"_before": "_after", "_after": "_before"}[name]
        image = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return df.select(*key, image.alias(name), F.lit(None).cast("string").alias(other))

    images = (
        tagged(before, "_before").unionByName(tagged(after, "_after"))
        .groupBy(*key).agg(F.max("_before").alias("before_image"), F.max("_after").alias("after_image"))
        .filter(~F.col("before_image").eqNullSafe(F.col("after_image")))
    )
    action = F.when(F.col("before_image").isNull(), "INSERT").when(F.col("after_image").isNull(), "DELETE").otherwise("UPDATE")
    return images.select(
        *key, action.alias("action"), "before_image", "after_image", F.lit(process).alias("process"), moment(at).alias("changed_at"),
        F.lit(operator).alias("operator"),
    )


def with_audit(df: DataFrame, as_of: datetime, operator: Column | str) -> DataFrame:
    """Create and revision columns of an inserted row."""
    who = F.lit(operator) if isinstance(operator, str) else operator
    stamps: dict[str, Column] = {}
    for kind in ("CREATE", "REVISION"):
        stamps |= {
            f"{kind}_DATE": day(as_of),
            f"{kind}_TIME": moment(as_of),
            f"{kind}_OPID": who,
            f"{kind}_TERMINAL": F.lit("0001"),
        }
    return df.withColumns(stamps | {"ABT_JOIN": F.lit("*")})


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns and types of ``like``; columns it lacks are dropped, columns ``df`` lacks are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def append(target: DataFrame, rows: DataFrame, action: str = "INSERT") -> ChangeSet:
    added = align_columns(rows, target).withColumn("action", F.lit(action))
    return ChangeSet(target.unionByName(added.drop("action")), added, target.withColumn("action", F.lit(None).cast("string")).unionByName(added))


def insert_missing(target: DataFrame, source: DataFrame, key: Sequence[str]) -> ChangeSet:
    """Insert the source rows whose key the target lacks; a second run inserts nothing."""
    return append(target, anti(source, target, key))


def insert_unless_exists(
    target: DataFrame, source: DataFrame, key: Sequence[str], allow_duplicates: bool = False
) -> ChangeSet:
    return append(target, source) if allow_duplicates else insert_missing(target, source, key)


def upsert(
    target: DataFrame, source: DataFrame, key: Sequence[str], on_update: Mapping[str, Column], on_insert: Mapping[str, Column]
) -> ChangeSet:
    """Update matched rows, insert the others; expressions see the source row as ``s.<column>``."""
    s = source.select(F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"_s_{k}") for k in key])
    t = target.withColumn("_in_target", F.lit(True))
    test = None
    for k in key:
        one = t[k] == s[f"_s_{k}"]
        test = one if test is None else test & one
    joined = t.join(s, test, "full_outer")
    inserted, matched = F.col("_in_target").isNull(), F.col("_in_target") & F.col("s").isNotNull()
    out = []
    for f in target.schema.fields:
        new = on_insert.get(f.name)
        if new is None:
            new = F.col(f"s.{f.name}") if f.name in source.columns else F.lit(None)
        upd = on_update.get(f.name, F.col(f.name))
        out.append(
            F.when(inserted, new.cast(f.dataType)).when(matched, upd.cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        )
    action = F.when(inserted, "INSERT").when(matched, "UPDATE").alias("action")
    result = joined.select(*out, action)
    return ChangeSet(result.drop("action"), result.filter(F.col("action").isNotNull()), result, repeated_keys(source, key))


def sync_to(target: DataFrame, desired: DataFrame, key: Sequence[str], managed: DataFrame | None = None,
            managed_on: Sequence[str] = ()) -> ChangeSet:
    """Insert what is missing and delete what is extra; deletes only within the managed scope."""
    tagged = (
        target.select(*key).distinct().withColumns({"_t": F.lit(1), "_d": F.lit(0)})
        .unionByName(desired.select(*key).distinct().withColumns({"_t": F.lit(0), "_d": F.lit(1)}))
        .groupBy(*key)
        .agg(F.max("_t").alias("_t"), F.max("_d").alias("_d"))
    )
    inserts = tagged.filter("_t = 0 AND _d = 1").select(*key, F.lit("INSERT").alias("action"))
    deletes = tagged.filter("_t = 1 AND _d = 0").select(*key)
    if managed is not None:
        deletes = semi(deletes, managed, list(managed_on))
    deletes = deletes.withColumn("action", F.lit("DELETE"))
    kept = anti(target, deletes, list(key))
    return ChangeSet(kept.unionByName(align_columns(inserts, target)), inserts.unionByName(deletes))


def next_id(target: DataFrame, id_column: str) -> Column:
    """Largest id in use, as a scalar read by the plan (zero for an empty table)."""
    return F.coalesce(target.agg(F.max(F.col(id_column).cast("bigint")).alias("m")).scalar(), F.lit(0))


def insert_returning(
    target: DataFrame, rows: DataFrame, id_column: str, order: Sequence[Column | str], used: DataFrame | None = None
) -> tuple[ChangeSet, DataFrame]:
    """Append rows with new ids; also returns the input rows beside their ids.

    New ids lie above those of ``used``: the table before rows were taken out of ``target``, so that no id is given out again.
    """
    numbered = with_row_key(rows.drop(id_column), order, id_column, next_id(target if used is None else used, id_column))
    return append(target, numbered), numbered


def update_from(
    target: DataFrame, source: DataFrame, on: Sequence[str] | Mapping[str, str], sets: Mapping[str, str], when: Column | None = None
) -> ChangeSet:
    """Take values from a source that is unique on its key; ``when`` may compare with ``s.<column>``."""
    pairs = _pairs(on)
    s = source.select(
        *[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())], F.struct(*source.columns).alias("s")
    )
    joined = target.join(s, _on(target, s, pairs, False), "left")
    hit = F.col("s").isNotNull() if when is None else F.col("s").isNotNull() & F.coalesce(when, F.lit(False))
    columns = [
        (F.when(hit, F.col(f"s.{sets[c]}").cast(target.schema[c].dataType)).otherwise(target[c]) if c in sets else target[c]).alias(c)
        for c in target.columns
    ]
    return _updated(joined.select(*columns, hit.alias("_hit")), repeated_keys(source, list(pairs.values())))


def _updated(result: DataFrame, repeated: DataFrame | None = None) -> ChangeSet:
    tagged = result.select(*[c for c in result.columns if c != "_hit"], F.when(F.col("_hit"), "UPDATE").alias("action"))
    return ChangeSet(result.drop("_hit"), result.filter("_hit").drop("_hit").withColumn("action", F.lit("UPDATE")), tagged, repeated)


def update_where(target: DataFrame, test: Column, sets: Mapping[str, Column]) -> ChangeSet:
    test = F.coalesce(test, F.lit(False))
    flagged = target.withColumn("_hit", test)
    values = {c: F.when(F.col("_hit"), v.cast(target.schema[c].dataType)).otherwise(F.col(c)) for c, v in sets.items()}
    return _updated(flagged.withColumns(values))


def delete_matching(target: DataFrame, doomed: DataFrame, on: Sequence[str] | Mapping[str, str]) -> ChangeSet:
    """Remove the rows whose key occurs among the doomed."""
    return ChangeSet(anti(target, doomed, on), semi(target, doomed, on).withColumn("action", F.lit("DELETE")))


def delete_where(target: DataFrame, test: Column) -> ChangeSet:
    test = F.coalesce(test, F.lit(False))
    tagged = target.withColumn("action", F.when(test, "DELETE"))
    return ChangeSet(target.filter(~test), target.filter(test).withColumn("action", F.lit("DELETE")), tagged)


@dataclass(frozen=True)
class Member:
    """A table of a family and the column that refers to the family's key."""

    table: str
    key: str
    by: str = "id"


def cascade_delete(tables: Mapping[str, DataFrame], members: Sequence[Member], doomed: Mapping[str, DataFrame]) -> dict[str, ChangeSet]:
    """Delete the doomed keys (frames with column ``key``, one per kind of key) from every member."""
    return {m.table: delete_matching(tables[m.table], doomed[m.by], {m.key: "key"}) for m in members}


def cascade_copy(
    old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], members: Sequence[Member], wanted: Mapping[str, DataFrame],
    excluded: Mapping[str, Column] | None = None,
) -> dict[str, ChangeSet]:
    """Append the old rows of the wanted keys to the new tables, less the excluded rows."""
    out = {}
    for m in members:
        rows = semi(old[m.table], wanted[m.by], {m.key: "key"})
        if excluded and m.table in excluded:
            rows = rows.filter(~F.coalesce(excluded[m.table], F.lit(False)))
        out[m.table] = append(new[m.table], rows)
    return out
