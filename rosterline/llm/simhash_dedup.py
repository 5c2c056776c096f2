"""Near-duplicate texts by 64-bit SimHash fingerprints and an inverted index of positional bytes.

A fingerprint is eight bytes, each with its position. Two fingerprints that differ in at most two bits share at least
six positional bytes, so among the four pairs of neighbouring bytes at least two pairs are shared. The index therefore
keeps lists under two such pairs (four positional bytes): six entries for each different fingerprint, and lists that
stay short at any size, where lists under one byte would hold 1/256 of all rows. Pairs of a list are tallied: kept if
they share six or more positional bytes, then verified by counting differing bits.

Lists above ``list_limit`` members (many fingerprints close together) form no pairs at all. Their members are spread to
the 65 fingerprints within one bit: two differ in at most two bits exactly if they meet at such a centre. A centre
gathers 65 members at most, so this is exact and linear too, and the two ways together lose no link.

Equal fingerprints collapse to one before the index, so groups of copies of any size cost one entry. Links are joined
to components by rounds of large-star and small-star steps, each round written to the shared folder.

Null and empty texts (no words) have fingerprint zero and are linked like any other. Very long texts are hashed whole, in
stretches of shingles; a bit set in exactly half of the shingles is 0. Repeated rows share a component;
null ids take part but never name a component unless all its ids are null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base

RADIUS = 2  # differing bits; what the index and the centres guarantee
WORD_PAIRS = list(combinations(range(4), 2))
#: For each byte value the eight bits, lowest first.
_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_STRETCH = 1 << 16


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half of the hashes of the word shingles."""
    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n < width:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: n - width + 1], ends[width - 1 :]
    total, ones = len(starts), np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _STRETCH):
        a, b = starts[at : at + _STRETCH].tolist(), ends[at : at + _STRETCH].tolist()
        h = np.fromiter((digest(joined[i:j], seed) for i, j in zip(a, b)), np.uint64, len(a)).view(np.uint8).reshape(-1, 8)
        if len(a) < 64:
            ones += _BIT_TABLE[h].sum(0)
        else:
            for k in range(8):
                ones[k] += np.bincount(h[:, k], minlength=256) @ _BIT_TABLE
    return int.from_bytes(np.packbits((2 * ones > total).reshape(-1), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """doc_id, fp: the fingerprint of every whole text as a signed long."""

    def body(batch):
        found = [fingerprint(t or b"", width) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        fp = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], ["doc_id", "fp"])

    return base.map_batches(base.keyed_text(docs, id_col, text_col), body, "doc_id long, fp long")


def _part(column, position: int, bits: int):
    return F.shiftrightunsigned(column, position * bits).bitwiseAND(F.lit((1 << bits) - 1))


def _shared_bytes(a, b):
    """Number of positional bytes that two fingerprints share."""
    return sum((_part(a, k, 8) == _part(b, k, 8)).cast("int") for k in range(8))


def links(fps: DataFrame, list_limit: int = 24) -> DataFrame:
    """u, v (u < v): links of at most two differing bits that join exactly what such links join; ``fp`` is unique.

    Short lists give every linked pair; long ones give at each centre the links to its smallest member.
    """
    fp = F.col("fp")
    entries = F.array(*[F.struct(F.lit(k).alias("slot"), (_part(fp, i, 16) * 65536 + _part(fp, j, 16)).alias("bytes")) for k, (i, j) in enumerate(WORD_PAIRS)])
    postings = fps.select("fp", F.explode(entries).alias("e")).select("fp", "e.slot", "e.bytes")
    sizes = postings.groupBy("slot", "bytes").agg(F.count("*").alias("size")).filter("size > 1")
    lists = base.staged(postings.join(sizes, ["slot", "bytes"]), "lists")
    short = lists.filter(F.col("size") <= list_limit)
    pairs = short.select("slot", "bytes", F.col("fp").alias("u")).join(short.select("slot", "bytes", F.col("fp").alias("v")), ["slot", "bytes"])
    tallied = pairs.filter(F.col("u") < F.col("v")).filter(_shared_bytes(F.col("u"), F.col("v")) >= 8 - RADIUS)
    verified = tallied.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS).select("u", "v")

    crowded = lists.filter(F.col("size") > list_limit).select("fp").distinct()
    flips = [0, *(1 << k for k in range(63)), -(1 << 63)]
    centres = crowded.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")).select("fp", fp.bitwiseXOR(F.col("flip")).alias("centre"))
    met = centres.groupBy("centre").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).filter(F.col("u") < F.col("v"))
    return verified.unionByName(star).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node that every node of ``edges`` (u, v of longs) reaches."""
    edges = base.staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")

    def summary(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = summary(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = base.staged(small.filter("u <> v").distinct(), "edges")
        after = summary(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _rooted(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, fp, root, component_id of every row."""
    marked = base.staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    different = base.staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "different")
    roots = components(links(different))
    rooted = different.join(roots, different.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(named, "root"), "fp").select("doc_id", "fp", "root", "component_id")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every row; the component is named by its smallest doc_id."""
    return _rooted(docs, id_col, text_col, width).select("doc_id", "fp", "component_id")


def kept(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row of ``docs`` for each root of ``found`` (doc_id, fp, root), one with its smallest id; all columns stay.

    Rows are told by id and fingerprint: what shares both shares its root.
    """
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("row")).select("row.doc_id", "row.fp")
    # By the frames' own columns: ``docs`` may hold columns of any name.
    if not found.groupBy("doc_id").agg(F.count("*").alias("copies")).filter("copies > 1").limit(1).count():
        return docs.join(first, docs[id_col].cast("long").eqNullSafe(first["doc_id"]), "left_semi")

    base.small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def print_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with base.task():
            for text in texts:
                yield pd.Series(np.array([fingerprint((t or "").encode(), width) for t in text], np.uint64).view(np.int64))

    # Repeated ids: the fingerprint goes along, in a column of a name that ``docs`` cannot hold.
    own = f"_fp_{uuid.uuid4().hex}"
    wide = docs.withColumn(own, print_of(docs[text_col].cast("string")))
    wide = wide.join(first, wide[id_col].cast("long").eqNullSafe(first["doc_id"]) & (wide[own] == first["fp"]), "left_semi")
    return wide.dropDuplicates([id_col, own]).drop(own)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row of each group, one with its smallest id, whether or not ids repeat or are null. All columns stay."""
    return kept(docs, base.staged(_rooted(docs, id_col, text_col, width), "groups"), id_col, text_col, width)
