"""Predicates, schema conformance, reference validation, defaults and run guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, col, default_if_blank
from .joins import few_valued


def given(value) -> bool:
    """A parameter that is neither missing nor blank."""
    return value is not None and str(value).rstrip() != ""


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def optional_equals(params: Mapping[str, object]) -> Column:
    """Equality on every given parameter; missing or blank parameters do not restrict."""
    return all_of([F.col(name) == F.lit(value) for name, value in params.items() if given(value)])


def wildcard_equals(c: Column | str, value) -> Column:
    """Like an optional equality, but rows with a blank code always pass."""
    return ((col(c) == F.lit(value)) | (col(c) == "")) if given(value) else F.lit(True)


def scope_or_key(scope: Column, key: str, value) -> Column:
    """Rows in scope, or the one row named by its key whatever its scope."""
    return scope | (F.col(key) == F.lit(value)) if given(value) else scope


def gate(rows: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose caller is in the allowed list.

    The different callers meet the list in one aggregate. Few callers (often one, who asks for everything) then come back as a
    map, so that neither a hot caller nor a constant one makes a join; many callers join by key.
    """
    asked = rows.select(*on).distinct().withColumns({"_asked": F.lit(1), "_listed": F.lit(0)})
    listed = allowed.select(*on).distinct().withColumns({"_asked": F.lit(0), "_listed": F.lit(1)})
    flags = asked.unionByName(listed).groupBy(*on).agg(F.max("_asked").alias("_asked"), F.max("_listed").alias("_listed"))
    known = flags.filter("_asked = 1 AND _listed = 1").select(*on, F.lit(True).alias("_known"))
    return few_valued(rows, known, on, {"_known": "_known"}).drop("_known")


def action_status(executed: Column, canceled: Column, waived: Column, scheduled: Column, as_of: Column) -> Column:
    """Status by precedence: done, canceled, waived, then by the scheduled day."""
    ahead = F.date_diff(scheduled, as_of)
    return (
        F.when(executed.isNotNull(), "Complete")
        .when(canceled, "Canceled")
        .when(waived, "Waived")
        .when(ahead > 0, "Future")
        .when(ahead == 0, "Today")
        .otherwise("Past Due")
    )


def conform_schema(
    df: DataFrame,
    required: Mapping[str, str],
    optional: Mapping[str, str],
    one_of: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Caller-supplied rows brought to a fixed schema.

    Missing required columns, or a group of which no column exists, are errors
    raised before any work starts. Missing optional columns become typed nulls,
    extra columns are dropped and a null in a required column fails the job.
    """
    present = {c.lower(): c for c in df.columns}
    missing = [c for c in required if c.lower() not in present]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    for group in one_of:
        if not any(c.lower() in present for c in group):
            raise ValueError(f"at least one of these columns is needed: {', '.join(group)}")
    kept = []
    for name, kind in required.items():
        value = F.col(f"`{present[name.lower()]}`").cast(kind)
        checked = F.when(value.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(value)
        kept.append(checked.cast(kind).alias(name))
    for name, kind in optional.items():
        value = F.col(f"`{present[name.lower()]}`") if name.lower() in present else F.lit(None)
        kept.append(value.cast(kind).alias(name))
    return df.select(*kept)


@dataclass(frozen=True)
class Reference:
    """``column`` must occur in ``dimension.key``; a null passes unless ``required``."""

    column: str
    dimension: DataFrame
    key: str
    required: bool = True


def validate_refs(df: DataFrame, rules: Sequence[Reference]) -> DataFrame:
    """Add ``errors`` (array of messages) and ``ok``.

    One left join per rule against the distinct keys of its dimension. The
    planner broadcasts a dimension only when its size is under the session's
    limit; otherwise both sides shuffle on the key.
    """
    out, checks = df, []
    for i, rule in enumerate(rules):
        flag = f"_known_{i}"
        keys = rule.dimension.select(F.col(rule.key).alias(f"_key_{i}")).distinct().withColumn(flag, F.lit(True))
        out = out.join(keys, out[rule.column] == keys[f"_key_{i}"], "left").drop(f"_key_{i}")
        bad = F.col(flag).isNull()
        if not rule.required:
            bad = bad & F.col(rule.column).isNotNull()
        shown = F.coalesce(F.col(rule.column).cast("string"), F.lit("(none)"))
        checks.append(F.when(bad, F.concat(F.lit(f"{rule.column} '"), shown, F.lit("' not found"))))
    out = out.withColumn("errors", F.array_compact(F.array(*checks)))
    out = out.drop(*[f"_known_{i}" for i in range(len(rules))])
    return out.withColumn("ok", F.size("errors") == 0)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing or blank values; a default may be a column."""
    changes = {}
    for name, value in defaults.items():
        if isinstance(df.schema[name].dataType, T.StringType):
            changes[name] = default_if_blank(name, value)
        else:
            changes[name] = F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
    return df.withColumns(changes)


def blanks_to_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: blank_to_null(n) for n in names})


def guarded(df: DataFrame, is_open: bool) -> DataFrame:
    """The rows when the run is open, else no rows with the same schema."""
    return df if is_open else df.limit(0)
