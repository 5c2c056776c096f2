"""Landed files consumed once, as Structured Streaming file sources.

Every query keeps its progress in a checkpoint folder; ``available_now`` runs
what has landed and stops, which is how a scheduled task uses it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import moment
from ..operators.ranking import latest_row_per_key
from ..sources.folders import Folder

# File name templates of landed applications and documents.
APPLICATION_NAME = r"^DICAS_([^_]*)_([^_]*)_([^_]*)_([^_]*)_([^_.]*)\.csv$"
APPLICATION_IDS = ("instanceId", "organizationId", "programId", "applicationId", "casApplicantId")
DOCUMENT_NAME = r"^DICAS_(app|pers)_([^_]*)_([^_!]*)_([^!]*?)_([^_!]*)_([^_!]*)!([^.]*)\.pdf$"
DOCUMENT_IDS = ("scope", "casApplicantId", "programId", "documentType", "collegeId", "fileId", "deliveredDate")

# Phrases that mark a delivered body as an error message.
ERROR_PHRASES = ("is not authenticated", "user name or password is incorrect")


def name_parts(name: Column, pattern: str, parts: Sequence[str]) -> list[Column]:
    """Groups of a file name pattern as columns; null when the name does not match or the part is empty."""
    return [F.nullif(F.regexp_extract(name, pattern, i + 1), F.lit("")).alias(p) for i, p in enumerate(parts)]


def application_parts(name: Column) -> list[Column]:
    return name_parts(name, APPLICATION_NAME, APPLICATION_IDS)


def document_parts(name: Column) -> list[Column]:
    return name_parts(name, DOCUMENT_NAME, DOCUMENT_IDS)


def landed_csv(spark: SparkSession, path: str, schema: T.StructType, archive: str | None = None) -> DataFrame:
    """Stream of landed CSV rows with their file name and landing time; consumed files move to ``archive``."""
    reader = spark.readStream.schema(schema).option("header", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path).select(
        "*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("landed_at")
    )


def landed_names(spark: SparkSession, path: str) -> DataFrame:
    """Stream of landed opaque files, names only; bodies are never read into the plan."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "modificationTime", "length")
    )


def applications(rows: DataFrame) -> DataFrame:
    return rows.select(*application_parts(F.col("file_name")), *rows.columns)


def latest_versions(rows: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """An update replaces the earlier row of the same application."""
    return latest_row_per_key(rows, key, [F.col(c) for c in version])


def run_available(stream: DataFrame, checkpoint: str, each_batch) -> None:
    """Run what has landed; ``each_batch(frame, batch_id)`` must be safe to repeat for one id."""
    if isinstance(each_batch, Appended):
        each_batch = each_batch.under(stream.sparkSession, checkpoint)
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class Appended:
    """A batch writer whose repeats replace their own earlier output.

    Batch numbers begin anew with each checkpoint, so ``run_available`` gives each checkpoint a folder of its own: output
    of an earlier checkpoint is never overwritten. A folder that holds batches without one goes on as it is.
    """

    path: str

    def under(self, spark: SparkSession, checkpoint: str) -> Appended:
        if any(n.startswith("batch=") for n in Folder(spark, self.path).listing()):
            return self
        mark = Folder(spark, checkpoint)
        mark.write_new("output-name", uuid.uuid4().hex)  # once for each checkpoint
        return Appended(f"{self.path}/stream={mark.read('output-name')}")

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def append_batches(path: str) -> Appended:
    return Appended(path)


def merge_batches(path: str, key: Sequence[str], version: Sequence[str]):
    """A batch writer that keeps the latest version per key of a small table; ``state.LatestVersions`` rewrites touched buckets only.

    Batch n reads the state of batch n - 1 and writes its own, so a repeat of a
    batch writes the same state again. The current state is the highest
    ``state=`` folder.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df
        if batch_id > 0:
            rows = rows.unionByName(df.sparkSession.read.parquet(f"{path}/state={batch_id - 1}"))
        latest_versions(rows, key, version).write.mode("overwrite").parquet(f"{path}/state={batch_id}")

    return write


def dedupe_overlap(stream: DataFrame, key: Sequence[str], event_time: str, window: str = "8 days") -> DataFrame:
    """Rows that each run pulls again are dropped; in a stream, state is bounded by the watermark.

    A stream loses rows behind its watermark; ``state.SeenOnce`` keeps them.

    A batch keeps the latest row of each key; equal times are settled by the other columns.
    """
    if stream.isStreaming:
        return stream.withWatermark(event_time, window).dropDuplicatesWithinWatermark(list(key))
    rest = [F.col(f"`{c}`") for c in stream.columns if c not in {*key, event_time}]
    return latest_row_per_key(stream, key, [F.col(event_time), *rest])


def replay(rows: DataFrame, landed_at: str, start: datetime, end: datetime) -> DataFrame:
    """Rows that landed within a range, to be applied again."""
    return rows.filter((F.col(landed_at) >= moment(start)) & (F.col(landed_at) <= moment(end)))


def split_errors(rows: DataFrame, body: str, phrases: Sequence[str] = ERROR_PHRASES) -> Mapping[str, DataFrame]:
    """``ok`` rows and ``rejected`` rows, whose body holds an error phrase."""
    bad = F.lit(False)
    for p in phrases:
        bad = bad | F.contains(F.col(body), F.lit(p))
    bad = F.coalesce(bad, F.lit(False))
    return {"ok": rows.filter(~bad), "rejected": rows.filter(bad)}
