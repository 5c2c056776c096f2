"""Nested directory groups flattened into one target group."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode
from ..operators import sets

# What each side of the comparison asks for.
SIDE_ACTIONS = {"left": "ADD", "right": "REMOVE"}


def group_sync(edges: DataFrame, roots: DataFrame, current: DataFrame) -> DataFrame:
    """Members to add to and to remove from the target.

    ``edges`` (parent, member), ``roots`` (root) and ``current`` (member) hold names.
    """
    wanted = sets.flatten_membership(edges, roots).select("member")
    sides = sets.compare_sets(wanted, current, ["member"])
    return sides.filter(F.col("side") != "both").select("member", decode("side", SIDE_ACTIONS).alias("action"))
