"""Registered queries over the star-schema tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from ..sources.registry import TableRegistry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed "today" of the checks: the last order day.
AS_OF = "2001-08-01"


class Tables:
    """The given tables of one scale factor, read on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = prepare(spark), path
        self.registry = TableRegistry(spark, {"main": path})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.registry.table(name)

    @cached_property
    def dated_orders(self) -> DataFrame:
        return self.registry.table("orders").withColumn("d", F.col("o_orderdate").cast("date"))


def portable(df: DataFrame, texts: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """Days and moments as text and decimals as doubles, which all clients print alike."""
    casts = {c: "string" for c in texts} | {c: "double" for c in numbers}
    return df.withColumns({c: F.col(c).cast(k) for c, k in casts.items()}) if casts else df


def portable_sql(sql: str, texts: Sequence[str] = (), numbers: Sequence[str] = ()) -> str:
    casts = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in texts] + [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in numbers]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n) typed" if casts else sql


def query(sql: str | None = None, texts: Sequence[str] = (), numbers: Sequence[str] = ()):
    """Register a function of ``Tables`` under its own name."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: portable(fn(Tables(spark, sf_dir)), texts, numbers)
        if sql is not None:
            ORACLES[name] = portable_sql(sql, texts, numbers)
        return fn

    return wrap


def cents(c: str):
    """Amounts as exact decimals, so sums do not depend on the order of addition."""
    return F.col(c).cast("decimal(18,2)")
