"""Places of regular-expression matches as built-in column expressions.

Matches and the texts between them alternate, so the places follow from their lengths. Places count code points from 0,
ends exclusive. Nothing is exploded: the spans of a row stay in one array of that row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches (``pattern`` in Java's dialect, never matching an empty text)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def placed(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<start,end,value>> of the matches in ``found``; ``text`` is split only where there are any."""
    empty = none()
    first = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("value"))
    pairs = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.when(F.size(found) > 0, F.aggregate(pairs, first, step, lambda acc: acc["out"])).otherwise(empty)


def labelled(spans: Column, order: int, kind: str, key: str = "start") -> Column:
    """Spans as structs that sort by ``key``, then kind (or kind first), with their text kind:start:end."""
    text = lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])
    if key == "start":
        return F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.lit(order).alias("b"), s["end"].alias("c"), text(s).alias("text")))
    return F.transform(spans, lambda s: F.struct(F.lit(order).alias("a"), s["start"].alias("b"), s["end"].alias("c"), text(s).alias("text")))


def written(labels: list[Column]) -> Column:
    """All labelled spans in their order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.concat(*labels)), lambda s: s["text"]), ",")
