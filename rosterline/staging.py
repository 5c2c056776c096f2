"""Intermediate tables as Parquet on storage that every executor can reach.

A staged table outlives executors and cuts lineage; readers still prune its columns and push filters down. Every table is in
a register of its application: inside ``run`` it goes when the run ends, that is when its last reader has been written;
otherwise when the application ends.

The folder is the one that the session names in ``spark.checkpoint.dir``. Only a local master without that setting gets a
folder of its own beside Spark's scratch files.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sources.folders import Folder

_roots: dict[str, str] = {}
#: Staged folders of each application by open run, innermost last; the first list is that of the application itself.
_held: dict[str, list[list[str]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application's staged tables."""
    context = spark.sparkContext
    app = context.applicationId
    if app not in _roots:
        named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "") or ""
        if not named:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            named = spark.conf.get("spark.local.dir", tempfile.gettempdir())
        _roots[app] = f"{named.rstrip('/')}/staged-{app}-{uuid.uuid4().hex[:8]}"
        _held[app] = [[]]
        atexit.register(_end, spark, _roots[app])
    return _roots[app]


def _end(spark: SparkSession, root: str) -> None:
    """Remove an application's folder; a session that has been stopped no longer reaches it but on a local disk."""
    with contextlib.suppress(Exception):
        Folder(spark, root).delete()
    shutil.rmtree(root.removeprefix("file://"), ignore_errors=True)


def new_folder(spark: SparkSession, what: str = "table") -> str:
    """A path in the shared folder that goes with the innermost open run."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _held[spark.sparkContext.applicationId][-1].append(path)
    return path


def stage(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` once and read it back; columns that Parquet cannot hold side by side go under names of their own."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, what)
    void = [isinstance(f.dataType, T.NullType) for f in df.schema]
    if not any(void) and len({c.lower() for c in df.columns}) == len(df.columns):
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    plain = df.toDF(*[f"c{i}" for i in range(len(void))])
    plain = plain.select(*[F.col(c).cast("string").alias(c) if v else F.col(c) for c, v in zip(plain.columns, void)])
    plain.write.parquet(path)
    back = spark.read.schema(plain.schema).parquet(path)
    return back.select(*[(F.lit(None) if v else F.col(c)).alias(n) for c, v, n in zip(back.columns, void, df.columns)])


def staged_paths(spark: SparkSession) -> list[str]:
    """What the register holds, oldest first."""
    shared_folder(spark)
    return [p for held in _held[spark.sparkContext.applicationId] for p in held]


@contextlib.contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is staged inside; its readers must have been written by then. Runs nest."""
    shared_folder(spark)
    held = _held[spark.sparkContext.applicationId]
    held.append([])
    try:
        yield
    finally:
        for path in held.pop():
            Folder(spark, path).delete()


def keep(df: DataFrame, what: str = "table") -> DataFrame:
    """Stage ``df`` for readers outside the innermost open run."""
    out, held = stage(df, what), _held[df.sparkSession.sparkContext.applicationId]
    if len(held) > 1:
        held[-2].append(held[-1].pop())
    return out
