"""Stored-view metadata: cascade delete and copy over its family of tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import changes
from ..operators.changes import ChangeSet, Member
from ..sources.registry import TableRegistry

# The family of tables, keyed by view id or by the view's database name.
HEAD = "VISTAVIEW"
FAMILY = (
    *(Member(HEAD + part, "VIEW_ID") for part in ("", "COLUMNS", "COMPUTES", "CRITERIA", "GROUPS", "JOIN", "JOINCRITERIA", "SORT", "SYNTAX", "TABLES")),
    Member("PBCATCOL", "PBC_TNAM", "name"),
    Member("PBCATTBL", "PBT_TNAM", "name"),
    Member("ABT_TABLES", "TABLE_NAME", "name"),
    Member("ABT_TABLESECURITY", "TABLE_NAME", "name"),
)
LAST_FREE_ID = 9999
KEPT_ACCOUNT = "SYSTEM"


def _keys(views: DataFrame) -> dict[str, DataFrame]:
    return {"id": views.select(F.col("VIEW_ID").alias("key")), "name": views.select(F.col("VIEW_DB_NAME").alias("key"))}


def view_metadata_delete(t: TableRegistry, name: str, as_of: datetime, confirm: bool = False, database: str = "main") -> dict[str, ChangeSet | DataFrame]:
    """Delete a view's metadata everywhere and log the head row; protected views need ``confirm``.

    An unknown name, or a protected view without confirmation, changes nothing.
    """
    views = t[HEAD].filter((F.col("VIEW_DB_NAME") == name) & (F.coalesce("VIEW_ID", F.lit(0)) != 0))
    if not confirm:
        views = views.filter(F.col("VIEW_ID") <= LAST_FREE_ID)
    out: dict[str, ChangeSet | DataFrame] = dict(changes.cascade_delete({m.table: t[m.table] for m in FAMILY}, FAMILY, _keys(views)))
    out["log"] = views.select("*", dates.moment(as_of).alias("DateDeleted"), F.lit(database).alias("Database"))
    return out


def view_metadata_copy(t: TableRegistry, view_id: int, old: str, new: str) -> dict[str, ChangeSet]:
    """Append a view's metadata from one database to another, without the system account's rights."""
    views = t.table(HEAD, old).filter(F.col("VIEW_ID") == view_id)
    old_tables, new_tables = ({m.table: t.table(m.table, db) for m in FAMILY} for db in (old, new))
    return changes.cascade_copy(old_tables, new_tables, FAMILY, _keys(views), {"ABT_TABLESECURITY": F.col("SECURITY_ID") == KEPT_ACCOUNT})
