"""Tables that streams keep up to date in a store: latest versions by hash bucket, and a ledger of rows seen by day.

Both write a batch once beside the current data and make it current by the store's manifest. Neither depends on the
stream's own progress: a repeated batch, or files that come again under a new checkpoint, change nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import latest_row_per_key
from ..sources.manifest import Entry, Manifest, Store


def _run_name(name: str, batch_id: int) -> str:
    return f"{name}-{batch_id}-{uuid.uuid4().hex[:12]}"


def _total(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> list[Column]:
    """The version, then the other columns, so that equal versions are settled alike in every run."""
    return [F.col(f"`{c}`") for c in (*version, *(c for c in df.columns if c not in {*key, *version}))]


@dataclass(frozen=True)
class LatestVersions:
    """The latest version of each key in the table ``name`` of a store.

    The table lies in ``buckets`` folders by a hash of the key (fixed when the table begins). A batch reads key and version
    of the buckets it falls to, and rewrites only buckets in which it holds something later; the others keep their folders.
    Of equal versions the row that came first stays; within a batch the other columns settle them. Null keys are one key.
    """

    store: Store
    name: str
    key: Sequence[str]
    version: Sequence[str]
    buckets: int = 64

    def current(self) -> DataFrame | None:
        entry = self.store.manifest().tables.get(self.name)
        return None if entry is None else self.store.frame(entry)

    def merge(self, rows: DataFrame, run: str | None = None) -> Manifest:
        """Take in a batch; returns the manifest that holds it (the current one if it brings nothing later)."""
        store, base = self.store, self.store.manifest()
        run = run or _run_name(self.name, 0)
        entry = base.tables.get(self.name)
        if entry and entry.options["key"] != list(self.key):
            raise ValueError(f"{self.name} is kept by {entry.options['key']}")
        buckets = entry.options["buckets"] if entry else self.buckets
        place = store.attempt(run)
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        incoming = latest_row_per_key(rows, self.key, _total(rows, self.key, self.version)).withColumn("_bucket", bucket)
        arrived = Entry(plain.json(), store.write_parts(incoming, "_bucket", f"{place}/arrived"))
        later = store.frame(arrived)
        if entry:
            held = store.frame(entry, list(arrived.parts))
            known = held.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key)], F.struct(*self.version).alias("_known"))
            test = F.lit(True)
            for i, k in enumerate(self.key):
                test = test & later[k].eqNullSafe(known[f"_k{i}"])
            joined = later.join(known, test, "left")
            later = joined.filter(F.col("_known").isNull() | (F.struct(*self.version) > F.col("_known"))).select(*rows.columns)
            touched = sorted(str(r[0]) for r in later.select(bucket).distinct().collect())  # at most one for each bucket
            rest = store.frame(entry, touched)
            # Later rows win over what is held; no key occurs twice on either side.
            tagged = later.withColumn("_later", F.lit(True)).unionByName(rest.withColumn("_later", F.lit(False)))
            state = latest_row_per_key(tagged, self.key, [F.col("_later")]).drop("_later")
        else:
            touched, state = list(arrived.parts), later
        if not touched:
            return base
        if entry:
            written = store.write_parts(state.withColumn("_bucket", bucket), "_bucket", f"{place}/{self.name}")
        else:
            written = dict(arrived.parts)
        options = {"key": list(self.key), "buckets": buckets}
        table = Entry(plain.json(), {**(entry.parts if entry else {}), **written}, options=options)
        return store.commit(base, run, {self.name: table})

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        """For ``run_available``."""
        self.merge(rows, _run_name(self.name, batch_id))


@dataclass(frozen=True)
class SeenOnce:
    """Rows of overlapping pulls, each (key, event day) once, in the table ``name`` of a store.

    The table lies in folders by event day and is its own ledger: a batch is checked against the keys of the days it
    holds, however old, so that late rows are neither dropped nor taken twice. A key that moves to another day counts as
    a new row. Of rows that repeat within a batch the latest stays. Null times are a day of their own.
    """

    store: Store
    name: str
    key: Sequence[str]
    event_time: str

    def current(self) -> DataFrame | None:
        entry = self.store.manifest().tables.get(self.name)
        return None if entry is None else self.store.frame(entry)

    def take(self, rows: DataFrame, run: str | None = None) -> Manifest:
        store, base = self.store, self.store.manifest()
        run = run or _run_name(self.name, 0)
        entry = base.tables.get(self.name)
        place = store.attempt(run)
        day = F.coalesce(F.unix_date(F.col(self.event_time).cast("date")), F.lit(-(1 << 31)))
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        keyed = rows.withColumn("_day", day)
        incoming = latest_row_per_key(keyed, [*self.key, "_day"], _total(rows, self.key, [self.event_time]))
        arrived = store.write_parts(incoming.select(*rows.columns, "_day"), "_day", f"{place}/arrived")
        fresh = arrived
        parts = dict(entry.parts) if entry else {}
        ledger = [p for p in parts if p.partition("/")[0] in arrived]
        if ledger:
            new = store.frame(Entry(plain.json(), arrived)).withColumn("_day", day)
            seen = store.frame(entry, ledger).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key)], day.alias("_seen"))
            test = new["_day"] == seen["_seen"]
            for i, k in enumerate(self.key):
                test = test & new[k].eqNullSafe(seen[f"_k{i}"])
            fresh = store.write_parts(new.join(seen, test, "left_anti"), "_day", f"{place}/{self.name}")
        if not fresh:
            return base
        mark = place.rpartition("/")[2]
        parts |= {f"{d}/{mark}": path for d, path in fresh.items()}
        schema = json.loads(entry.schema) if entry else plain.jsonValue()
        return store.commit(base, run, {self.name: Entry(json.dumps(schema), parts, options={"key": list(self.key)})})

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        """For ``run_available``."""
        self.take(rows, _run_name(self.name, batch_id))
