"""Set operations and nested membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .joins import anti, semi


def union_branches(branches: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Rows of all branches, by column name; ``distinct`` gives one desired state."""
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out.distinct() if distinct else out


def compare_sets(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of either side with ``side`` = left, right or both; one aggregate, no outer join."""
    tagged = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    flags = tagged.groupBy(*on).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = F.when(F.col("_l") + F.col("_r") == 2, "both").when(F.col("_l") == 1, "left").otherwise("right")
    return flags.select(*on, side.alias("side"))


def group_closure(edges: DataFrame) -> DataFrame:
    """(parent, member) of groups that reach each other over any number of steps; ``edges`` are between groups.

    Paths double: each round joins what is reached in up to n steps with itself, so the rounds grow with the logarithm of the
    depth. A group on a cycle reaches itself. Rounds are staged, which keeps the plan short.
    """
    reach = stage(edges.distinct(), "reach")
    n = reach.count()
    while n:
        steps = reach.select(F.col("parent").alias("_from"), F.col("member").alias("parent")).join(
            reach, "parent"
        ).select(F.col("_from").alias("parent"), "member")
        reach = stage(reach.unionByName(steps).distinct(), "reach")
        before, n = n, reach.count()
        if n == before:
            break
    return reach


def flatten_membership(edges: DataFrame, roots: DataFrame, leaves_only: bool = True) -> DataFrame:
    """Members reached from each root through nested groups; safe on cycles.

    ``edges`` has (parent, member), ``roots`` has (root). Only groups (members that are parents themselves) take part in the
    rounds; the other members are attached to the groups reached by one join at the end.
    """
    edges = stage(edges.select("parent", "member").distinct(), "edges")
    reach = group_closure(semi(edges, edges.select(F.col("parent").alias("_group")), {"member": "_group"}))
    own = roots.select("root", F.col("root").alias("parent")).distinct()
    groups = own.unionByName(own.join(reach, "parent").select("root", F.col("member").alias("parent"))).distinct()
    found = groups.join(edges, "parent").select("root", "member").distinct().filter(F.col("root") != F.col("member"))
    return anti(found, edges, {"member": "parent"}) if leaves_only else found
