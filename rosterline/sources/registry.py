"""Tables of several databases in one query, found by alias and name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import CASE_BLIND


@dataclass(frozen=True)
class TableRegistry:
    """``databases`` maps an alias to a base path, or to ready frames by table name.

    With ``case_blind`` every text column compares without regard to case and
    trailing blanks, as the source system does.
    """

    spark: SparkSession
    databases: Mapping[str, str | Mapping[str, DataFrame]]
    default: str = "main"
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)
    case_blind: bool = False

    def table(self, name: str, db: str | None = None) -> DataFrame:
        source = self.databases[db or self.default]
        if isinstance(source, Mapping):
            df = source[name]
        else:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            df = reader.parquet(f"{source}/{name}.parquet")
        return as_case_blind(df) if self.case_blind else df

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def alias(self, **sources: str | Mapping[str, DataFrame]) -> TableRegistry:
        """The same registry with database aliases added or pointed elsewhere."""
        return replace(self, databases={**self.databases, **sources})

    def use(self, db: str) -> TableRegistry:
        return replace(self, default=db)

    def register_views(self, names: Mapping[str, str]) -> None:
        """Temporary views for SQL users: view name -> table name."""
        for view, table in names.items():
            self.table(table).createOrReplaceTempView(view)


def as_case_blind(df: DataFrame) -> DataFrame:
    changes = {
        f.name: F.col(f"`{f.name}`").cast(T.StringType(CASE_BLIND))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(changes) if changes else df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def find_value(
    tables: Mapping[str, DataFrame],
    value: str,
    columns: list[str] | None = None,
    scope: Mapping[str, str] | None = None,
    partial_scope: Mapping[str, list[str]] | None = None,
    all_tables: bool = True,
) -> DataFrame:
    """(table, column, instances) of every text column that holds ``value``.

    One scan and one partial aggregate per table, whatever its number of
    columns. ``scope`` limits tables that have its columns (any of them counts
    as having); ``partial_scope`` names the scope columns for special tables;
    ``all_tables`` off leaves out tables without scope columns.
    """
    out = None
    for name, df in sorted(tables.items()):
        searched = [c for c in text_columns(df) if columns is None or c in columns]
        held = [c for c in (scope or {}) if c in df.columns]
        if not searched or (scope and not held and not all_tables):
            continue
        if held:
            for c in (partial_scope or {}).get(name, held):
                df = df.filter(F.col(c) == scope[c])
        counts = df.agg(*[F.count_if(F.col(c) == value).alias(f"n{i}") for i, c in enumerate(searched)])
        rows = counts.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("instances")) for i, c in enumerate(searched)]))
        ).select(F.lit(name).alias("table_name"), "column_name", "instances")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        if not tables:
            raise ValueError("no tables to search")
        # No table qualifies: nothing is found.
        any_table = next(iter(tables.values()))
        return any_table.sparkSession.createDataFrame([], "table_name string, column_name string, instances long")
    return out.filter("instances > 0")
