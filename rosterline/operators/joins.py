"""Join operators.

Semi and anti joins first reduce the right side to its distinct keys: a hot key
on that side becomes one row before it is shuffled, and the join reuses the
partitioning of that step. No side is broadcast by hint; the planner does so
only for sides whose measured size is under the session's limit.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_to_blank

#: Rows of a side that is as small as a calendar or a code table; a look-up in its map goes through all of them.
FEW_ROWS = 256
#: Values of all groups together that such a map may hold.
FEW_VALUES = 4_096
#: Pairs that a task of a join dealt by its pairs makes.
TASK_PAIRS = 8_000_000
# Join key of a class section, shared by all academic tables.
SECTION_KEY = ["ACADEMIC_YEAR", "ACADEMIC_TERM", "ACADEMIC_SESSION", "EVENT_ID", "EVENT_SUB_TYPE", "SECTION"]
# The same key for joins of facts, what tells most sections apart first: sorts compare few columns then.
SECTION_JOIN = ["EVENT_ID", "ACADEMIC_YEAR", "ACADEMIC_TERM", "SECTION", "ACADEMIC_SESSION", "EVENT_SUB_TYPE"]


def _pairs(on: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _distinct_keys(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())]).distinct()


def _on(left: DataFrame, keys: DataFrame, pairs: Mapping[str, str], null_safe: bool) -> Column:
    tests = [
        left[l].eqNullSafe(keys[f"_r_{i}"]) if null_safe else left[l] == keys[f"_r_{i}"]
        for i, l in enumerate(pairs)
    ]
    result = tests[0]
    for t in tests[1:]:
        result = result & t
    return result


def semi(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str], null_safe: bool = False) -> DataFrame:
    """Left rows with a partner. ``on`` is a list of shared names or left name -> right name."""
    pairs = _pairs(on)
    keys = _distinct_keys(right, pairs)
    return left.join(keys, _on(left, keys, pairs, null_safe), "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str], null_safe: bool = False) -> DataFrame:
    """Left rows without a partner; a null key has no partner."""
    pairs = _pairs(on)
    keys = _distinct_keys(right, pairs)
    return left.join(keys, _on(left, keys, pairs, null_safe), "left_anti")


def semi_any(left: DataFrame, rights: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """Left rows whose key occurs in any of the right sides: one join with the union of their keys."""
    keys = None
    for df, name in rights:
        part = df.select(F.col(name).alias("_k"))
        keys = part if keys is None else keys.unionByName(part)
    return semi(left, keys, {key: "_k"})


def not_in(left: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """``column NOT IN (values)`` with three-valued logic.

    An empty list keeps everything; a null in the list keeps nothing; a null
    probe is kept only by an empty list. The two facts about the list are
    one-row aggregates read as scalar subqueries, so a long list still joins by key.
    """
    facts = values.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(value_column).isNull()).alias("nulls")
    )
    empty = facts.select("n").scalar() == 0
    clean = facts.select("nulls").scalar() == 0
    return anti(left, values, {column: value_column}).filter(empty | (clean & F.col(column).isNotNull()))


def few_rows(side: DataFrame, most: int = FEW_ROWS) -> DataFrame | None:
    """The rows of a side that has at most ``most``, as constants of the plan; None for a larger one, of which no more are read."""
    rows = side.limit(most + 1).collect()
    return side.sparkSession.createDataFrame(rows, side.schema) if len(rows) <= most else None


def among_few(df: DataFrame, side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs on a side of few different keys, as a filter that reaches the scan; by a semi join where there are more."""
    found = side.select(*on).distinct().limit(FEW_ROWS + 1).collect()
    if len(found) > FEW_ROWS:
        return semi(df, side, on)
    test = F.lit(False)
    for row in found:
        same = F.lit(True)
        for c, value in zip(on, row):
            same = same & (F.col(c) == F.lit(value))
        test = test | same
    return df.filter(test)


def few_valued(
    df: DataFrame, side: DataFrame, on: Sequence[str] | Mapping[str, str], take: Mapping[str, str], how: str = "inner", most: int = FEW_ROWS
) -> DataFrame:
    """Join with a side whose key is unique, without moving ``df`` where the side is as small as a calendar.

    Such a side is computed once and becomes one map that the plan reads as a scalar, so rows of ``df`` stay where they
    are however few values their key has; a larger side is joined by key. ``take`` maps output names to columns of the side.
    """
    pairs = _pairs(on)
    keys = F.struct(*[F.col(r).alias(f"k{i}") for i, r in enumerate(pairs.values())])
    values = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(take.values())])
    known = side.filter(F.forall(F.array(*[F.col(r).isNull() for r in pairs.values()]), lambda x: ~x))
    small = few_rows(known.select(*dict.fromkeys([*pairs.values(), *take.values()])), most)
    if small is not None:
        entries = small.select(F.struct(keys.alias("key"), values.alias("value")).alias("e"))
        table = entries.agg(F.map_from_entries(F.collect_list("e")).alias("m")).scalar()
        types = known.select(*pairs.values()).schema
        asked = F.struct(*[df[l].cast(f.dataType).alias(f"k{i}") for i, (l, f) in enumerate(zip(pairs, types))])
        given = F.forall(F.array(*[df[l].isNull() for l in pairs]), lambda x: ~x)
        found = df.select(*[df[f"`{c}`"] for c in df.columns], F.when(given, F.try_element_at(table, asked)).alias("_found"))
    else:
        picked = known.select(*[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())], values.alias("_found"))
        joined = df.join(picked, _on(df, picked, pairs, False), "left")
        found = joined.select(*[df[f"`{c}`"] for c in df.columns], "_found")
    if how == "inner":
        found = found.filter(F.col("_found").isNotNull())
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_found.t{i}").alias(o) for i, o in enumerate(take)])


def not_in_per_group(
    left: DataFrame, column: str, values: DataFrame, value_column: str, on: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """``column NOT IN (values of the same group)`` with three-valued logic.

    Few values (a code table): the values of a row's group come from a map, and ``left`` is not moved. Many: two key joins, an
    anti join for the matches, then one summary row per group for the rules about nulls. A row whose group has no
    values is kept.
    """
    pairs = _pairs(on)
    listed = values.select(*[F.col(r).alias(f"_g_{i}") for i, r in enumerate(pairs.values())], F.col(value_column).alias("_v")).distinct()
    groups = {l: f"_g_{i}" for i, l in enumerate(pairs)}
    small = few_rows(listed, FEW_VALUES)
    if small is not None:
        grouped = small.groupBy(*groups.values()).agg(F.collect_set("_v").alias("_set"), F.bool_or(F.col("_v").isNull()).alias("_null"))
        found = few_valued(left, grouped, groups, {"_set": "_set", "_null": "_null"}, "left")
        outside = ~F.col("_null") & F.col(f"`{column}`").isNotNull() & ~F.array_contains("_set", F.col(f"`{column}`"))
        return found.filter(F.col("_null").isNull() | F.coalesce(outside, F.lit(False))).drop("_set", "_null")
    survivors = anti(left, values, {**pairs, column: value_column})
    summary = values.groupBy(*[F.col(r).alias(f"_g_{i}") for i, r in enumerate(pairs.values())]).agg(
        F.bool_or(F.col(value_column).isNull()).alias("_has_null")
    )
    test = None
    for i, l in enumerate(pairs):
        t = survivors[l] == summary[f"_g_{i}"]
        test = t if test is None else test & t
    kept = survivors.join(summary, test, "left").filter(
        F.col("_has_null").isNull() | (~F.col("_has_null") & F.col(column).isNotNull())
    )
    return kept.drop("_has_null", *[f"_g_{i}" for i in range(len(pairs))])


def _day_bucket(c: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(c.cast("date")) / F.lit(bucket_days)).cast("int")


def _wide(bucket: Column, width: Column) -> Column:
    """The bucket of 2^width times the days that holds a bucket."""
    return F.call_function("shiftright", bucket, width)


def _width(start: Column, end: Column, bucket_days: int) -> Column:
    """Power of two of the narrowest buckets that are no shorter than an interval."""
    return F.ceil(F.log2(_day_bucket(end, bucket_days) - _day_bucket(start, bucket_days) + 1)).cast("int")


def interval_buckets(start: Column, end: Column, bucket_days: int = 1) -> Column:
    """The buckets of an interval, two at most, as an array."""
    width = _width(start, end, bucket_days)
    return F.sequence(_wide(_day_bucket(start, bucket_days), width), _wide(_day_bucket(end, bucket_days), width))


def overlap_pairs(
    df: DataFrame,
    entity: str,
    start: str,
    end: str,
    key: str,
    carry: Sequence[str] = (),
    second: DataFrame | None = None,
    bucket_days: int = 1,
) -> DataFrame:
    """Pairs of intervals of one entity that overlap (ends included), different keys, both orders.

    Two intervals overlap where the later one starts inside the earlier one. Buckets have widths of ``bucket_days`` times a
    power of two. An interval goes to the buckets of the narrowest width that is no shorter than itself: two at most,
    whatever its length. A start goes to its bucket of each width that occurs among the intervals (one scalar read
    by the plan). They are joined on (entity, width, bucket), so the work per task is bounded by what one entity has in a
    stretch about as long as the intervals are, and no pair is met twice.

    Within one set, a pair is found at its later start and mirrored; with a ``second`` set for the right side, the starts
    of each set meet the intervals of the other. ``carry`` columns come out with suffixes 1 and 2.
    """
    columns = [entity, key, start, end, *carry]

    def side(frame: DataFrame, n: int) -> DataFrame:
        s, e = F.col(f"{start}{n}"), F.col(f"{end}{n}")
        picked = frame.select(*[F.col(c).alias(f"{c}{n}") for c in columns]).filter(s <= e)
        return picked.withColumn(f"_w{n}", _width(s, e, bucket_days))

    def meet(spans: DataFrame, i: int, starts: DataFrame, j: int, strictly: bool) -> DataFrame:
        """Intervals of side ``i`` beside those of side ``j`` that start in them."""
        s, e, at = F.col(f"{start}{i}"), F.col(f"{end}{i}"), F.col(f"{start}{j}")
        widths = spans.agg(F.collect_set(f"_w{i}").alias("w")).scalar()
        spans = spans.withColumn(f"_b{i}", F.explode(interval_buckets(s, e, bucket_days)))
        starts = starts.withColumn(f"_w{j}", F.explode(widths)).withColumn(f"_b{j}", _wide(_day_bucket(at, bucket_days), F.col(f"_w{j}")))
        same = (F.col(f"{entity}{i}") == F.col(f"{entity}{j}")) & (F.col(f"_w{i}") == F.col(f"_w{j}")) & (F.col(f"_b{i}") == F.col(f"_b{j}"))
        inside = (at > s if strictly else at >= s) & (at <= e) & (F.col(f"{key}{i}") != F.col(f"{key}{j}"))
        return spans.join(starts, same & inside).withColumn(entity, F.col(f"{entity}1")).select(*pairwise)

    pairwise = [entity, *[f"{c}{n}" for c in (key, start, end, *carry) for n in (1, 2)]]
    if second is not None:
        a, b = side(df, 1), side(second, 2)
        return meet(a, 1, b, 2, False).unionByName(meet(b, 2, a, 1, True))
    found = meet(side(df, 1), 1, side(df, 2), 2, False)
    swapped = [
        F.col(f"{c[:-1]}{3 - int(c[-1])}").alias(c) if c != entity else F.col(c) for c in pairwise
    ]
    # Equal starts meet in both orders by themselves.
    earlier = F.col(f"{start}1") < F.col(f"{start}2")
    both = F.when(earlier, F.array(F.struct(*pairwise), F.struct(*swapped))).otherwise(F.array(F.struct(*pairwise)))
    return found.select(F.inline(both))


def first_match(
    outer: DataFrame,
    inner: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    order: Sequence[Column],
    take: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Attach the first inner row by ``order``; ``take`` maps output names to inner columns.

    The inner side is reduced by an aggregate with map-side combine, not by a
    window, so a hot key costs one row per input task.
    """
    pairs = _pairs(on)
    best = inner.groupBy(*[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())]).agg(
        F.min_by(F.struct(*[F.col(c).alias(o) for o, c in take.items()]), F.struct(*order)).alias("_best")
    )
    joined = outer.join(best, _on(outer, best, pairs, False), how)
    return joined.select(*[outer[c] for c in outer.columns], *[F.col(f"_best.{o}").alias(o) for o in take])


def attach_sum(
    outer: DataFrame, inner: DataFrame, on: Sequence[str] | Mapping[str, str], amount: Column, name: str
) -> DataFrame:
    """Sum per key of the inner side beside each outer row, zero when there is none."""
    pairs = _pairs(on)
    sums = inner.groupBy(*[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())]).agg(
        F.sum(amount).alias("_sum")
    )
    joined = outer.join(sums, _on(outer, sums, pairs, False), "left")
    return joined.select(
        *[outer[c] for c in outer.columns], F.coalesce(F.col("_sum"), F.lit(0).cast(sums.schema["_sum"].dataType)).alias(name)
    )


def lookup(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join to a dimension whose key is unique; ``take`` maps output names to its columns."""
    pairs = _pairs(on)
    picked = dimension.select(
        *[F.col(r).alias(f"_r_{i}") for i, r in enumerate(pairs.values())],
        *[F.col(c).alias(f"_t_{i}") for i, c in enumerate(take.values())],
    )
    joined = df.join(picked, _on(df, picked, pairs, False), "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"_t_{i}").alias(o) for i, o in enumerate(take)])


def dealt_by_pairs(left: DataFrame, right: DataFrame, on: Sequence[str], most: int = TASK_PAIRS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on equal names, dealt to tasks by the pairs that it makes, and the names to join on then.

    Sizes in bytes say nothing about a result that is far longer than its sides. Rows are counted by key beforehand (one job), and
    there are as many tasks as ``most`` pairs each need. A key with more pairs goes in pieces: each of its left rows to one
    (by a digest of the row), its right rows to all.
    """
    keys = [F.col(c) for c in on]
    counted = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    sizes = counted.dropna().groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    # A row that is moved takes about as long as some pairs that are made.
    work = F.col("_l").cast("double") * F.col("_r") + 8 * (F.col("_l") + F.col("_r"))
    total, largest = sizes.agg(F.sum(work), F.max(work)).first()
    tasks = math.ceil((total or 0) / most) or 1
    if (largest or 0) > most:
        pieces = F.ceil(work / most).cast("int")
        hot = sizes.filter((work > most) & (F.col("_l") > 0)).select(*[F.col(c).alias(f"_h_{c}") for c in on], pieces.alias("_pieces"))
        same = [F.col(c) == F.col(f"_h_{c}") for c in on]
        left, right = (side.join(hot, same, "left").drop(*[f"_h_{c}" for c in on]) for side in (left, right))
        count = F.coalesce("_pieces", F.lit(1))
        left = left.withColumn("_piece", F.pmod(F.xxhash64(*left.columns), count).cast("int")).drop("_pieces")
        right = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), count - 1))).drop("_pieces")
        on = [*on, "_piece"]
    return left.repartition(tasks, *on), right.repartition(tasks, *on), list(on)


def text_match(
    df: DataFrame, text: str, pattern: str, candidates: DataFrame, on: Mapping[str, str], code: str, tail: str,
    take: Mapping[str, str], many: bool = False,
) -> DataFrame:
    """Match rows to candidates through a code and a (possibly cut) name inside free text.

    ``pattern`` has two groups: the code (equal to ``candidates.code``) and the
    beginning of ``candidates.tail``. ``on`` adds plain equalities. Unmatched rows stay.
    A candidate goes out with the beginnings of its name that are as long as names in the texts are (one scalar read by the plan), so the
    join is one of equal keys and compares no names. ``many`` deals it by the pairs it makes, where a row meets many candidates.
    """
    left = df.withColumns(
        {"_code": F.regexp_extract(F.col(text), pattern, 1), "_tail": F.regexp_extract(F.col(text), pattern, 2)}
    )
    lengths = left.agg(F.collect_set(F.length("_tail")).alias("n")).scalar()
    begun = candidates.select(
        F.col(code).alias("_code"),
        *[F.col(r).alias(f"_r_{i}") for i, r in enumerate(on.values())],
        F.col(tail).alias("_name"),
        *[F.col(c).alias(f"_t_{i}") for i, c in enumerate(take.values())],
        F.explode(lengths).alias("_size"),
    ).filter(F.col("_size") <= F.length("_name"))
    picked = begun.withColumn("_tail", F.substring("_name", F.lit(1), F.col("_size"))).drop("_name")
    left = left.withColumns({f"_r_{i}": F.col(l) for i, l in enumerate(on)} | {"_size": F.length("_tail")})
    keys = ["_code", *[f"_r_{i}" for i in range(len(on))], "_size", "_tail"]
    if many:
        left, picked, keys = dealt_by_pairs(left, picked, keys)
    joined = left.join(picked, keys, "left")
    return joined.select(*[left[f"`{c}`"] for c in df.columns], *[F.col(f"_t_{i}").alias(o) for i, o in enumerate(take)])


def prefix_lookup(
    df: DataFrame, number: str, codes: DataFrame, prefix: str, length: str, value: str, name: str
) -> DataFrame:
    """Value of the longest code whose length equals the number's and whose prefix begins it.

    Each different number goes out once with its prefixes of the lengths that codes have (one scalar read by the plan), meets
    the codes in one join on (length, prefix), and keeps the longest by an aggregate; a second join on the number brings
    the value back to the rows. Nothing runs while the query is planned. Numbers that no code reaches have no value.
    """
    unique = codes.select(
        F.col(prefix).cast("string").alias("_p"), F.col(length).cast("int").alias("_n"), F.col(value).alias("_v")
    ).groupBy("_p", "_n").agg(F.min("_v").alias("_v"))
    sizes = unique.agg(F.collect_set(F.length("_p")).alias("s")).scalar()
    digits = F.rtrim(F.col(number))
    numbers = df.select(digits.alias("_number")).filter("_number IS NOT NULL").distinct()
    begun = numbers.select("_number", F.length("_number").alias("_n"), F.explode(sizes).alias("_size"))
    begun = begun.filter("_size <= _n").withColumn("_p", F.substring("_number", F.lit(1), F.col("_size")))
    best = begun.join(unique, ["_n", "_p"]).groupBy("_number").agg(F.max_by("_v", "_size").alias("_found"))
    joined = df.join(best, digits == best["_number"], "left")
    return joined.select(*[df[f"`{c}`"] for c in df.columns], F.col("_found").alias(name))


def blank_safe_columns(columns: Sequence[str]) -> list[Column]:
    """Comparable form of columns in which null and blank are the same."""
    return [null_to_blank(F.col(c).cast("string")).alias(f"_k_{c}") for c in columns]


def adjacent_versions(
    df: DataFrame, same: Sequence[str], start: str, end: str, current: Column, former: Column
) -> DataFrame:
    """Current rows whose former version, equal in ``same`` (null = blank), ended the day before they start."""
    keys = blank_safe_columns(same)
    names = [f"_k_{c}" for c in same]
    older = df.filter(former).select(*keys, F.date_add(F.col(end).cast("date"), 1).alias("_next"))
    newer = df.filter(current).withColumns(dict(zip(names, keys))).withColumn("_next", F.col(start).cast("date"))
    return semi(newer, older, [*names, "_next"]).drop(*names, "_next")


def remap_keys(
    rows: DataFrame,
    key: str,
    old: DataFrame,
    new: DataFrame,
    id_column: str,
    natural: Sequence[str],
    required: bool = True,
) -> DataFrame:
    """Replace an old surrogate key by the new one through the natural key; unmatched rows are rejected."""
    bridge = (
        old.select(F.col(id_column).alias("_old"), *natural)
        .join(new.select(F.col(id_column).alias("_new"), *natural), list(natural))
        .select("_old", "_new")
    )
    joined = rows.join(bridge, rows[key] == bridge["_old"], "inner" if required else "left")
    return joined.select(*[F.col("_new").alias(c) if c == key else rows[c] for c in rows.columns])


def repeated_natural_keys(old: DataFrame, new: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Natural keys (as text) that either side of a bridge holds more than once: such a key would give a row several new ids."""
    out = None
    for side, df in (("old", old), ("new", new)):
        counted = df.select(*natural).dropna().groupBy(*natural).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        part = counted.select(F.lit(side).alias("side"), F.to_json(F.struct(*natural)).alias("natural_key"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def side_difference(df: DataFrame, side: str, items: Sequence[str]) -> DataFrame:
    """Per item: ``Only <side>`` or ``Both have``; one partial aggregate instead of a self join."""
    return df.groupBy(*items).agg(F.min(side).alias("_lo"), F.max(side).alias("_hi")).select(
        *items,
        F.when(F.col("_lo") == F.col("_hi"), F.concat(F.lit("Only "), F.col("_lo").cast("string")))
        .otherwise("Both have")
        .alias("status"),
    )


def coalesce_parents(
    df: DataFrame, first: DataFrame, second: DataFrame, on: Mapping[str, tuple[str, str]], keys: tuple[str, str], name: str
) -> DataFrame:
    """Rows that belong to a parent in either table; ``name`` holds the parent's key.

    ``on`` maps a column of ``df`` to its counterparts in the two parent tables.
    """
    out, found = df, []
    for side, (parent, key) in enumerate(zip((first, second), keys)):
        picked = parent.select(
            *[F.col(names[side]).alias(f"_j{side}_{i}") for i, names in enumerate(on.values())],
            F.col(key).alias(f"_found{side}"),
        )
        test = None
        for i, c in enumerate(on):
            t = df[c] == picked[f"_j{side}_{i}"]
            test = t if test is None else test & t
        out = out.join(picked, test, "left").drop(*[f"_j{side}_{i}" for i in range(len(on))])
        found.append(F.col(f"_found{side}"))
    out = out.withColumn(name, F.coalesce(*found)).filter(F.col(name).isNotNull())
    return out.drop("_found0", "_found1")


def copy_closure(root: DataFrame, levels: Sequence[tuple[str, DataFrame, str, str]]) -> dict[str, DataFrame]:
    """Follow foreign keys downwards: each level is (name, rows, its foreign key, the parent's key)."""
    out, parent = {"root": root}, root
    for name, rows, foreign, parent_key in levels:
        parent = semi(rows, parent, {foreign: parent_key})
        out[name] = parent
    return out
