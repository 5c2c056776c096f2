"""How far each source's vocabulary lies from the other sources of its language, recounted over minimal perfect hashes.

Terms are stretches of letters and of signs beyond ASCII, A-Z in small letters. A language keeps the terms that occur in
at least ``min_docs`` of its documents; this filter is exact (document counts, pre-aggregated in each task).

The kept terms go to shards by their hash. Each shard becomes a minimal perfect hash (buckets with a displacement each)
that stores its keys in slot order. The second pass holds for each group (language, source) a dense array with a place
for every kept term; a term is found by one hash, one displacement and a comparison with the stored key, and its place
goes up. Shards are broadcast in rounds of at most ``round_bytes``: one round for some million terms, and one more pass
over the texts for each further ``round_bytes``. Arrays above ``dense_bytes`` in a task are given out and begun anew.
What leaves a task is a row for each group and block of ``BLOCK`` slots, so a hot source sends no more rows than others.

Sums of blocks stream through sorted partitions. Groups are compared block by block and in blocks of about ``SIDE`` sources,
so no task holds a language or a group. All numbers are integers: p = 1 + floor(10^9 (count + 2) / (N + 2 V)) by
long division in three steps, f = floor((p - q)^2 / (p + q)) below 2^63.

Null text, language and source count as ''. Texts without terms still make their group occur. Repeated rows count
each time. Very long texts are taken in stretches, whole. A language without kept terms gives pairs of value 0 and no terms; a
language with one source gives no pairs; an empty table gives an empty result. Ties rank by item. Other columns, of
whatever name, are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm import base, words
from rosterline.llm.token_files import _mix, build_mph

BLOCK = 4096
SIDE = 32
SHARD_KEYS = 50_000
FIRST_SEED = 42  # of Spark's xxhash64
TERMS = words.table(words.LETTERS)
HEAD = np.dtype([("keys", "<u8"), ("buckets", "<u8"), ("seed", "<u8")])
BLOCK_KEY = ["lang", "shard", "block"]


def _own(docs: DataFrame) -> DataFrame:
    """lang, source and text without nulls."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def frequencies(own: DataFrame, held_terms: int = 400_000) -> DataFrame:
    """lang, term, n: documents that hold the term, added up in each task."""

    def run(batches):
        held: dict[str, Counter] = defaultdict(Counter)

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for batch in base.pieces(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), words.encoded(batch)):
                held[lang].update(set().union(*words.runs(text, TERMS)))
            if sum(map(len, held.values())) > held_terms:
                yield from out()
        yield from out()

    return own.select("lang", "text").mapInArrow(run, "lang string, term string, n long")


def kept_terms(own: DataFrame, min_docs: int) -> DataFrame:
    """lang, term of every term in at least ``min_docs`` documents of its language."""
    return frequencies(own).groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("lang", "term")


class Terms:
    """A minimal perfect hash of terms that stores them in slot order."""

    def __init__(self, data: bytes):
        keys, buckets, self.seed = (int(x) for x in np.frombuffer(data, HEAD, 1)[0])
        self.m, at = keys, HEAD.itemsize
        self.shift = np.frombuffer(data, "<u4", buckets, at)
        at += 4 * buckets
        self.ends = np.frombuffer(data, "<u8", keys + 1, at).astype(np.int64)
        self.stored = data[at + 8 * (keys + 1) :]

    @staticmethod
    def build(terms: list[bytes], seed: int = FIRST_SEED) -> bytes:
        while True:  # another seed in the case of equal hashes
            hashes = np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))
            if len(np.unique(hashes)) == len(hashes):
                break
            seed += 1
        shift, slots = build_mph(hashes)
        ordered: list[bytes] = [b""] * len(terms)
        for term, slot in zip(terms, slots.tolist()):
            ordered[slot] = term
        ends = np.concatenate(([0], np.cumsum([len(t) for t in ordered])))
        head = np.array([(len(terms), len(shift), seed)], HEAD)
        return head.tobytes() + shift.astype("<u4").tobytes() + ends.astype("<u8").tobytes() + b"".join(ordered)

    def find(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Slot of each term, -1 where the stored key is another; ``hashes`` are those of ``FIRST_SEED``."""
        if self.seed != FIRST_SEED:
            hashes = np.fromiter((xxhash.xxh64_intdigest(t, self.seed) for t in terms), np.uint64, len(terms))
        d = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        slots = (_mix(hashes, d) % np.uint64(self.m)).astype(np.int64)
        starts, ends, stored = self.ends[slots].tolist(), self.ends[slots + 1].tolist(), self.stored
        same = np.fromiter((stored[i:j] == t for i, j, t in zip(starts, ends, terms)), bool, len(terms))
        return np.where(same, slots, -1)

    def keys(self) -> list[bytes]:
        return [self.stored[i:j] for i, j in zip(self.ends[:-1].tolist(), self.ends[1:].tolist())]


def term_shards(kept: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """lang, shard, m, data: a minimal perfect hash for each shard of each language's kept terms."""
    kept = base.staged(kept, "kept-terms")
    mask = (1 << max(0, (kept.count() // shard_keys).bit_length())) - 1
    shard = F.shiftrightunsigned(F.xxhash64("term"), 48).bitwiseAND(F.lit(mask).cast("long")).cast("int")

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        data = Terms.build([t.encode() for t in group["term"]])
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "mask": [mask], "m": [len(group)], "data": [data]})

    built = kept.withColumn("shard", shard).groupBy("lang", "shard").applyInPandas(build, "lang string, shard int, mask int, m long, data binary")
    return base.staged(built, "term-shards")


class Places:
    """All shards of a round: the dense place of each term, in blocks of ``BLOCK`` that hold one shard only."""

    def __init__(self, rows: list[tuple[str, int, int, bytes]]):
        self.mask = rows[0][2]
        self.shards: dict[str, dict[int, tuple[int, Terms]]] = defaultdict(dict)
        self.blocks: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for lang, shard, _, data in rows:
            terms = Terms(data)
            self.shards[lang][shard] = (len(self.blocks[lang]) * BLOCK, terms)
            self.blocks[lang] += [(shard, b) for b in range(-(-terms.m // BLOCK))]

    def find(self, lang: str, terms: list[bytes]) -> dict[bytes, int]:
        """The places of those terms that are kept."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(t, FIRST_SEED) for t in terms), np.uint64, len(terms))
        shards = (hashes >> np.uint64(48)).astype(np.int64) & self.mask
        out: dict[bytes, int] = {}
        for shard, (first, index) in self.shards[lang].items():
            at = np.flatnonzero(shards == shard)
            asked = [terms[i] for i in at.tolist()]
            slots = index.find(asked, hashes[at])
            out.update((t, first + s) for t, s in zip(asked, slots.tolist()) if s >= 0)
        return out


def _rounds(shards: DataFrame, round_bytes: int) -> Iterator[list[tuple]]:
    """The shards in lists of at most ``round_bytes`` (or one shard)."""
    held, size = [], 0
    for r in shards.toLocalIterator():
        if held and size + len(r["data"]) > round_bytes:
            yield held
            held, size = [], 0
        held.append((r["lang"], r["shard"], r["mask"], bytes(r["data"])))
        size += len(r["data"])
    if held:
        yield held


def recount(own: DataFrame, shards: DataFrame, round_bytes: int = 64 << 20, dense_bytes: int = 96 << 20) -> DataFrame:
    """lang, source, shard, block, slots, counts, n: occurrences of the kept terms in each group, by blocks that hold any."""
    out = None
    for held in _rounds(shards, round_bytes):
        shared = own.sparkSession.sparkContext.broadcast(held)
        part = base.staged(_summed(_recount(own, shared, dense_bytes), ["lang", "source", "shard", "block"]), "recount")
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else own.sparkSession.createDataFrame([], "lang string, source string, shard int, block int, slots binary, counts binary, n long")


def _recount(own: DataFrame, shared, dense_bytes: int) -> DataFrame:
    def run(batches):
        places, dense, size = Places(shared.value), {}, 0

        def out():
            for (lang, source), counts in dense.items():
                at = np.flatnonzero(counts)
                blocks, first = np.unique(at // BLOCK, return_index=True)
                cut = [*first.tolist(), len(at)]
                named = [places.blocks[lang][b] for b in blocks.tolist()]
                slots, counts = (at % BLOCK).astype("<u2"), counts[at].astype("<i8")
                columns = [[lang] * len(named), [source] * len(named), [s for s, _ in named], [b for _, b in named], [slots[i:j].tobytes() for i, j in zip(cut, cut[1:])], [counts[i:j].tobytes() for i, j in zip(cut, cut[1:])]]
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "shard", "block", "slots", "counts"])
            dense.clear()

        for batch in base.pieces(batches):
            seen: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), words.encoded(batch)):
                if lang in places.shards:
                    for run in words.runs(text, TERMS):
                        seen[lang][source].update(run)
            for lang, sources in seen.items():
                place = places.find(lang, list(set().union(*sources.values())))
                width = len(places.blocks[lang]) * BLOCK
                for source, counts in sources.items():
                    found = [(place[t], n) for t, n in counts.items() if t in place]
                    if not found:
                        continue
                    if (lang, source) not in dense:
                        if size and size + 8 * width > dense_bytes:
                            yield from out()
                            size = 0
                        dense[lang, source] = np.zeros(width, np.int64)
                        size += 8 * width
                    at, n = np.array(found, np.int64).T
                    dense[lang, source][at] += n
        yield from out()

    return own.mapInArrow(run, "lang string, source string, shard int, block int, slots binary, counts binary")


def _summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, slots, counts, n: rows of equal keys added up, streaming through sorted partitions."""
    fields = parts.select(*keys).schema
    names = [*keys, "slots", "counts", "n"]

    def run(batches):
        now, sums = None, np.zeros(BLOCK, np.int64)
        ready: list[tuple] = []

        def close():
            if now is not None:
                at = np.flatnonzero(sums)
                ready.append((*now, at.astype("<u2").tobytes(), sums[at].astype("<i8").tobytes(), int(sums.sum())))
                sums[:] = 0

        def out():
            columns = list(zip(*ready))
            kinds = [pa.string() if f.dataType.typeName() == "string" else pa.int32() for f in fields] + [pa.binary(), pa.binary(), pa.int64()]
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for *key, slots, counts in zip(*[batch.column(c).to_pylist() for c in names[:-1]]):
                if tuple(key) != now:
                    close()
                    now = tuple(key)
                    if len(ready) >= 256:
                        yield out()
                sums[np.frombuffer(slots, "<u2")] += np.frombuffer(counts, "<i8")
        close()
        if ready:
            yield out()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", slots binary, counts binary, n long"
    return parts.select(*keys, "slots", "counts").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def share(count, total):
    """1 + floor(10^9 (count + 2) / total), exact for totals below 9 * 10^15: long division by thousands."""
    rest = np.asarray(count, np.int64) + 2
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def distance(p, q):
    """floor((p - q)^2 / (p + q))."""
    return (p - q) * (p - q) // (p + q)


def _pair_values(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Sums over one block of slots for the pairs between two blocks of sources."""
    lang, _, _, low, high = key
    group = group.sort_values("source", ignore_index=True)
    size = int(group["size"].iloc[0])
    p = np.empty((len(group), size), np.int64)
    for i, (slots, counts, total) in enumerate(zip(group["slots"], group["counts"], group["total"])):
        own = np.zeros(size, np.int64)
        if slots is not None:
            own[np.frombuffer(slots, "<u2")] = np.frombuffer(counts, "<i8")
        p[i] = share(own, total)
    side, names = group["side"].to_numpy(), group["source"].to_numpy(object)
    a, b, value = [], [], []
    for i in range(len(group)):
        others = np.flatnonzero((np.arange(len(group)) > i) if low == high else (side != side[i]) & (side[i] == low))
        if len(others):
            a += [names[i]] * len(others)
            b += names[others].tolist()
            value += distance(p[i], p[others]).sum(1).tolist()
    return pd.DataFrame({"lang": pd.Series([lang] * len(a), dtype=object), "a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object), "value": pd.Series(value, dtype="int64")})


def pair_values(groups: DataFrame, shards: DataFrame, counted: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language; ``groups`` as ``group_totals`` gives them."""
    sides = groups.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("sides"))
    sided = groups.join(sides, "lang").withColumn("side", F.pmod(F.xxhash64("source"), F.col("sides")).cast("int"))
    blocks = shards.select("lang", "shard", "m", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / BLOCK).cast("int") - 1)).alias("block"))
    blocks = blocks.select(*BLOCK_KEY, F.least(F.lit(BLOCK), F.col("m") - F.col("block") * BLOCK).cast("int").alias("size"))
    grid = sided.join(blocks, "lang").join(counted.drop("n"), ["lang", "source", "shard", "block"], "left")
    met = grid.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    met = met.select(*BLOCK_KEY, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "source", "side", "size", "total", "slots", "counts")
    once = met.groupBy(*BLOCK_KEY, "low", "high").applyInPandas(_pair_values, "lang string, a string, b string, value long")
    once = once.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    bare = groups.filter("total = 0").select("lang", "source")
    none = bare.withColumnRenamed("source", "item").join(bare, "lang").filter("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    both = [once.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value") for x, y in ("ab", "ba")]
    return both[0].unionByName(both[1]).unionByName(none)


def group_totals(own: DataFrame, shards: DataFrame, counted: DataFrame) -> DataFrame:
    """lang, source, total (N + 2 V), whole (the language's) of every occurring group; both are 0 without kept terms."""
    seen = own.select("lang", "source").distinct()
    kept = shards.groupBy("lang").agg(F.sum("m").alias("v"))
    n = counted.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = counted.groupBy("lang").agg(F.sum("n").alias("all"))
    joined = seen.join(n, ["lang", "source"], "left").join(kept, "lang", "left").join(whole, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.select("lang", "source", (zero("n") + 2 * zero("v")).alias("total"), (zero("all") + 2 * zero("v")).alias("whole"))


def lead_terms(groups: DataFrame, shards: DataFrame, counted: DataFrame, most: int) -> DataFrame:
    """lang, source, item, value of terms that lead in a group; of each block at least the ``most`` first."""
    whole = _summed(counted, BLOCK_KEY).select(*BLOCK_KEY, F.col("slots").alias("all_slots"), F.col("counts").alias("all_counts"))
    rows = counted.join(groups, ["lang", "source"]).join(whole, BLOCK_KEY)

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for lang, source, shard, block, slots, counts, total, every, all_slots, all_counts in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "shard", "block", "slots", "counts", "total", "whole", "all_slots", "all_counts")]):
                dense = np.zeros(BLOCK, np.int64)
                dense[np.frombuffer(all_slots, "<u2")] = np.frombuffer(all_counts, "<i8")
                at = np.frombuffer(slots, "<u2").astype(np.int64)
                p, q = share(np.frombuffer(counts, "<i8"), total), share(dense[at], every)
                ahead = p > q
                at, value = at[ahead], distance(p[ahead], q[ahead])
                if len(at) > most:  # ties with the last one stay
                    first = value >= np.partition(value, -most)[-most]
                    at, value = at[first], value[first]
                out += [(lang, source, shard, block * BLOCK + s, v) for s, v in zip(at.tolist(), value.tolist())]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "shard", "slot", "value"])

    found = rows.mapInArrow(run, "lang string, source string, shard int, slot long, value long")

    def name(batches):
        for batch in batches:
            for lang, shard, data in zip(*[batch.column(c).to_pylist() for c in ("lang", "shard", "data")]):
                terms = Terms(data).keys()
                columns = [pa.array([lang] * len(terms), pa.string()), pa.array([shard] * len(terms), pa.int32()), pa.array(range(len(terms)), pa.int64()), pa.array(terms, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "slot", "item"])

    names = shards.select("lang", "shard", "data").mapInArrow(name, "lang string, shard int, slot long, item string")
    return found.join(names, ["lang", "shard", "slot"]).select("lang", "source", "item", "value")


def audit(docs: DataFrame, min_docs: int = 10, most: int = 10, shard_keys: int = SHARD_KEYS, round_bytes: int = 64 << 20, dense_bytes: int = 96 << 20) -> DataFrame:
    """lang, source, part, item, value, rank: every other source (part ``pair``) and the ``most`` leading terms (``term``)."""
    own = _own(docs)
    shards = term_shards(kept_terms(own, min_docs), shard_keys)
    counted = recount(own, shards, round_bytes, dense_bytes)
    groups = base.staged(group_totals(own, shards, counted), "groups")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    pairs = ranked(pair_values(groups, shards, counted), "pair")
    return pairs.unionByName(ranked(lead_terms(groups, shards, counted, most), "term").filter(F.col("rank") <= most))
