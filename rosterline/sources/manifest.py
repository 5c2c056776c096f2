"""Tables that change together: runs write beside each other, one small file says which data is current.

Layout of a store::

    runs/<run>/<attempt>/...        data of a run, never changed afterwards
    manifests/<number>.json         the tables after a run: schema and folders of each

A run writes all its tables first and becomes current by one rename of its manifest to the next free number. Whatever fails
before that leaves the manifest, hence every table, as it was; of two runs that start from the same manifest one is
refused. Data is Parquet written by Spark; the driver handles names only. Readers take a ``Snapshot``, which keeps
showing the tables of one manifest while later runs come in.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import ChangeSet, RunAborted, from_tagged, require_none
from .folders import Folder

RUN_NAME = re.compile(r"[\w.=-]+")


@dataclass(frozen=True)
class Entry:
    """A table of a manifest: its schema and its folders by part; ``tagged`` rows carry the action that the run took on them."""

    schema: str
    parts: Mapping[str, str]
    tagged: bool = False
    options: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    run: str = ""
    tables: Mapping[str, Entry] = field(default_factory=dict)
    changes: Mapping[str, Entry] = field(default_factory=dict)

    def text(self) -> str:
        pack = lambda entries: {n: vars(e) for n, e in entries.items()}
        return json.dumps({"run": self.run, "tables": pack(self.tables), "changes": pack(self.changes)})

    @staticmethod
    def of(number: int, text: str) -> Manifest:
        held = json.loads(text)
        unpack = lambda entries: {n: Entry(**e) for n, e in entries.items()}
        return Manifest(number, held["run"], unpack(held["tables"]), unpack(held["changes"]))

    def folders(self) -> set[str]:
        return {p for e in (*self.tables.values(), *self.changes.values()) for p in e.parts.values()}


class Snapshot(Mapping):
    """Tables of one manifest by name; fits as a database of ``TableRegistry``."""

    def __init__(self, store: Store, manifest: Manifest):
        self.store, self.manifest = store, manifest

    def __getitem__(self, name: str) -> DataFrame:
        return self.store.frame(self.manifest.tables[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self.manifest.tables)

    def __len__(self) -> int:
        return len(self.manifest.tables)

    def changes(self, name: str) -> DataFrame:
        """Rows that the run of this manifest changed in a table, with their ``action``."""
        entry = self.manifest.changes[name]
        found = self.store.frame(Entry(entry.schema, entry.parts))
        return from_tagged(found).changes if entry.tagged else found


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.listing("manifests") if re.fullmatch(r"\d+\.json", n))

    def manifest(self, number: int | None = None) -> Manifest:
        """The current manifest or an earlier one; the empty manifest 0 before the first run."""
        if number is None:
            number = max(self.numbers(), default=0)
        return Manifest.of(number, self.folder.read(f"manifests/{number:010d}.json")) if number else Manifest()

    def snapshot(self, number: int | None = None) -> Snapshot:
        return Snapshot(self, self.manifest(number))

    def find_run(self, run: str) -> Manifest | None:
        """The manifest of a run, among those that are kept."""
        for number in reversed(self.numbers()):
            found = self.manifest(number)
            if found.run == run:
                return found
        return None

    def frame(self, entry: Entry, parts: list[str] | None = None) -> DataFrame:
        """Rows of a table, of some of its parts only where they are named."""
        schema = T.StructType.fromJson(json.loads(entry.schema))
        paths = [p for k, p in entry.parts.items() if parts is None or k in parts]
        df = self.spark.read.schema(schema).parquet(*map(self.folder.at, paths)) if paths else self.spark.createDataFrame([], schema)
        return from_tagged(df).new_state if entry.tagged else df

    def attempt(self, run: str) -> str:
        """A new folder for the data of a run; an earlier attempt's is not touched."""
        if not RUN_NAME.fullmatch(run):
            raise ValueError(f"not a run name: {run}")
        return f"runs/{run}/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, place: str) -> Entry:
        df.write.mode("errorifexists").parquet(self.folder.at(place))
        return Entry(df.schema.json(), {"all": place})

    def commit(self, based_on: Manifest, run: str, tables: Mapping[str, Entry], changes: Mapping[str, Entry] | None = None) -> Manifest:
        """Make written tables current together, if nothing has become current since ``based_on``."""
        new = Manifest(based_on.number + 1, run, {**based_on.tables, **tables}, changes or {})
        latest = max(self.numbers(), default=0)
        if latest != based_on.number or not self.folder.write_new(f"manifests/{new.number:010d}.json", new.text()):
            raise RunAborted(f"{run}: another run became current after manifest {based_on.number}")
        return new

    def publish(self, changesets: Mapping[str, ChangeSet], run: str, checks: Mapping[str, DataFrame] | None = None, based_on: Manifest | None = None) -> Manifest:
        """Check, write and make current the change-sets of a run; a run that is current already is not repeated.

        ``based_on`` is the manifest whose tables the change-sets were computed from (the current one by default). All checks
        and the change-sets' own repeated source keys are looked at before the first write. A change-set with a ``tagged``
        plan is written once, and both its state and its changes are read from there.
        """
        done = self.find_run(run)
        if done:
            return done
        based_on = based_on or self.manifest()
        require_none({**(checks or {}), **{f"{n}: repeated source key": c.repeated for n, c in changesets.items() if c.repeated is not None}})
        place, tables, logs = self.attempt(run), {}, {}
        for name, c in changesets.items():
            if c.tagged is not None:
                entry = self.write(c.tagged, f"{place}/{name}")
                tables[name] = logs[name] = Entry(entry.schema, entry.parts, True)
            else:
                tables[name], logs[name] = self.write(c.new_state, f"{place}/{name}"), self.write(c.changes, f"{place}/{name}.changes")
        return self.commit(based_on, run, tables, logs)

    def write_parts(self, df: DataFrame, part: str, place: str) -> dict[str, str]:
        """Write rows by the value of a column of whole numbers; the folder of each value that occurs. Only names reach the driver."""
        df.hint("rebalance", part).write.partitionBy(part).mode("errorifexists").parquet(self.folder.at(place))
        names = (n for n in self.folder.listing(place) if n.startswith(f"{part}="))
        return {n.partition("=")[2]: f"{place}/{n}" for n in names}

    def vacuum(self, keep: int = 10, older_than_hours: float = 24.0) -> list[str]:
        """Remove manifests before the last ``keep`` and the data that none of those names; runs begun lately stay. Returns what went."""
        numbers = self.numbers()
        kept = [self.manifest(n) for n in numbers[-max(keep, 1) :]]
        needed = {"/".join(p.split("/")[:3]) for m in kept for p in m.folders()}
        limit, gone = time.time() * 1000 - older_than_hours * 3_600_000, []
        for n in numbers[: -max(keep, 1)]:
            self.folder.delete(f"manifests/{n:010d}.json")
        for run in self.folder.listing("runs"):
            for attempt, changed in self.folder.listing(f"runs/{run}").items():
                place = f"runs/{run}/{attempt}"
                if place not in needed and changed <= limit:
                    self.folder.delete(place)
                    gone.append(place)
        return gone


def bucket_of(key: list[str], buckets: int):
    """The bucket of a row by its key columns."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
