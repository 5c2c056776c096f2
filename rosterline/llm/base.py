"""What the operators share: input tables, staged intermediate tables, text columns in Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.staging import new_folder, stage

#: Bytes of a batch that Spark hands to a Python worker; its own 10,000 rows of long texts are many times that, in the JVM and in Python.
BATCH_BYTES = "4m"
#: What the stage that a Python worker runs keeps there between its tasks, under one key.
_kept: dict[Hashable, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, what: str) -> str:
    """A new path in the folder that all executors share."""
    return new_folder(spark, what)


def staged(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: a short lineage that outlives executors."""
    return stage(df, what)


def keyed_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key (as long ``doc_id``) and the text, whatever else the table holds."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task holds beside them stays small with long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch in the caller's session; it holds when the plan runs."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def worker_state(key: Hashable, make: Callable[[], object]):
    """``make()``, built once in each Python worker and kept there until a task asks for something else."""
    if key not in _kept:
        _drop()
        _kept[key] = make()
    return _kept[key]


def _drop() -> None:
    if _kept:
        _kept.clear()
        gc.collect()


def _give_back() -> None:
    """Free memory goes back to the system; else a worker that is used again keeps the most it ever took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def task(keeps: Hashable = None) -> Iterator[None]:
    """Around a task's work in a Python worker: what other stages kept there goes, all but ``keeps``."""
    if keeps not in _kept:
        _drop()
        _give_back()
    try:
        yield
    finally:
        _give_back()


def map_batches(df: DataFrame, body: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, keeps: Hashable = None) -> DataFrame:
    """``body`` on small batches of ``df``; its state lives as long as the task, that under ``keeps`` as long as the stage's tasks come."""
    small_batches(df.sparkSession)

    def run(batches):
        with task(keeps):
            for batch in pieces(batches):
                yield body(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


class Remembered(dict):
    """A bounded memo of a pure function: emptied when full, so results never depend on the bound."""

    def __init__(self, function: Callable, most: int = 200_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value
