"""Token ids of documents as raw binary files with a minimal perfect hash index.

A data set is a folder of two kinds of files:

* ``ids-<shard>-<part>.bin``: ids of documents one after the other, little-endian unsigned, 16 bits where the vocabulary
  fits and else 32 (``files.json`` tells), nothing else. Shards
  are ranges of keys in ascending order, parts cut a shard at ``part_bytes``; all files in name order hold all
  documents in key order.
* ``index-<n>.mph``: an index of the keys whose hash falls to ``n``. A minimal perfect hash (buckets with a displacement
  each) maps m keys to slots 0 to m-1; a slot stores the fingerprint of its key, the file, the offset in it and
  the number of ids. A look-up is one hash, one displacement, one slot and a comparison of fingerprints (a key that is
  not there passes with a chance of 2^-64), then one read at the offset.

Shard bounds are quantiles of the key, so memory and work of a task do not grow with the table; a shard is written in
batches, a file at a time under a name that is its own to the attempt and then renamed, so a repeated task replaces
its files by equal ones. Only one row for each file travels to the driver. Files are reached through ``pyarrow.fs``,
which covers local, HDFS and object stores.

Nulls: a null text has only the end id; null keys come first, as keys of their own. Very long texts are encoded and stored
whole. All rows of one key lie in one shard: a key that holds a large share of the rows is written by one task, as a stream. A key that repeats is told apart by
its number of occurrence (equal keys in order of their texts). An empty table gives an empty data set. Other columns
are not read.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import base

#: The tokenizer's white space, and words in which it finds one stretch of letters: one that white space or an ASCII
#: sign or digit follows. The rest, up to white space, starts at a border of the tokenizer's.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(f"[{LETTERS}]+(?=[{SPACE}!-@\\[-`{{-~]|$)|[^{SPACE}]+")
PLAIN = re.compile(f"[{LETTERS}]+")
SLOT = np.dtype([("print", "<u8"), ("file", "<u4"), ("offset", "<u8"), ("n", "<u4")])
HEAD = np.dtype([("keys", "<u8"), ("buckets", "<u8"), ("seed", "<u8")])


class Known(dict):
    """Ids of words; a word that is not there gives None and is noted."""

    def __init__(self):
        super().__init__()
        self.missing: set[str] = set()

    def __missing__(self, word: str) -> None:
        self.missing.add(word)


class WordIds:
    """Ids of the tokenizers library, word by word.

    No token spans white space or the border between letters and the signs behind them, so words are encoded once and
    remembered. Plain words are encoded many at a time in small letters (as the tokenizer has them), told apart by the
    tokens that end a word.
    """

    def __init__(self, tokenizer_path: str, width: int, memo: int = 1_500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.width, self.kind = width, f"<u{width}"
        self.words = Known()
        self.memo = memo

    def _learn(self, new: list[str]) -> None:
        plain, rest = [], []
        for w in new:
            (plain if w.isalpha() and (w.isascii() or PLAIN.fullmatch(w)) else rest).append(w)
        capitals = {w: w.lower() for w in plain if not w.islower()}
        plain = list(({*plain} - capitals.keys() | {*capitals.values()}) - self.words.keys())
        for at in range(0, len(plain), 500):
            part = plain[at : at + 500]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.width).tolist()
            data = ids.tobytes()
            if len(ends) != len(part) or ends[-1] != len(data):
                rest += part
                continue
            self.words.update(zip(part, map(data.__getitem__, map(slice, [0, *ends], ends))))
        for word, found in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            self.words[word] = np.array(found.ids, self.kind).tobytes()
        for word, key in capitals.items():
            self.words[word] = self.words[key]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text."""
        known = self.words
        if len(known) > self.memo:
            known.clear()
        split = [WORD.findall(small(t)) for t in texts]
        found = [itemgetter(*words)(known) if len(words) > 1 else [known[w] for w in words] for words in split]
        if known.missing:
            new, known.missing = list(known.missing), set()
            self._learn(new)
            found = [[known[w] if x is None else x for w, x in zip(words, own)] if None in own else own for words, own in zip(split, found)]
        return list(map(b"".join, found))


def small(text: str) -> str:
    """The text in small letters where that cannot change its ids: signs up to U+00FF become what the tokenizer makes of them."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def id_width(tokenizer_path: str, end_id: int) -> int:
    """Bytes of an id in the files."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


@lru_cache(maxsize=2)
def word_ids(path: str, width: int) -> WordIds:
    return WordIds(path, width)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, cuts: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, end id last), order (of equal keys), shard (number of ``cuts`` below the key)."""
    width = id_width(tokenizer_path, end_id)

    def body(batch):
        own, end = word_ids(tokenizer_path, width), end_id.to_bytes(width, "little")
        values, keys = base.texts(batch), batch.column("doc_id")
        ids = [x + end for x in own.encode(values)]
        order = [xxhash.xxh64_intdigest(x, 7) >> 1 for x in ids]
        shard = np.where(keys.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(cuts, keys.fill_null(0).to_numpy(), side="left"))
        columns = [keys, pa.array(ids, pa.binary()), pa.array(order, pa.int64()), pa.array(shard, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "order", "shard"])

    return base.map_batches(base.keyed_text(docs, id_col, text_col), body, "doc_id long, ids binary, order long, shard int")


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder)


def bounds(docs: DataFrame, shards: int, id_col: str = "doc_id") -> list[int]:
    """Ascending keys that cut the rows into about equal shards."""
    cuts = docs.select(F.col(id_col).cast("double").alias("k")).approxQuantile("k", [i / shards for i in range(1, shards)], 0.2 / shards)
    return sorted({int(c) for c in cuts})


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", rows_per_shard: int = 4096, part_bytes: int = 1 << 28, keys_per_index: int = 50_000) -> DataFrame:
    """Write the data set; returns file (number in name order), name, first (ids in files before), n_ids, n_docs of each file."""
    spark = docs.sparkSession
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    rows = docs.count()
    # Bounds grow with the table, but slowly: larger shards from a million rows on.
    shards = int(max(1, min(rows / rows_per_shard, 256 + (rows / (256 * rows_per_shard)) ** 0.5 * 16)))
    cuts = np.array(bounds(docs, shards, id_col) if shards > 1 else [], np.int64)
    coded, width = encoded(docs, tokenizer_path, end_id, cuts, id_col, text_col), id_width(tokenizer_path, end_id)
    dealt = coded.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "order")

    def store(batches):
        store_files, root = _open(folder)
        name, stream, temporary = None, None, None
        shard_now, part, offset, occurrence, last_key = None, 0, 0, 0, object()
        rows_out: list[tuple] = []

        def close():
            stream.close()
            store_files.move(temporary, f"{root}/{name}")

        for batch in base.pieces(batches):
            for key, ids, own in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("shard").to_pylist()):
                if own != shard_now or offset >= part_bytes:
                    if stream:
                        close()
                    part = part + 1 if own == shard_now else 0
                    shard_now, offset = own, 0
                    name = f"ids-{own:06d}-{part:06d}.bin"
                    temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
                    stream = store_files.open_output_stream(temporary)
                occurrence = occurrence + 1 if key == last_key else 0
                last_key = key
                stream.write(ids)
                rows_out.append((key, occurrence, name, offset, len(ids) // width))
                offset += len(ids)
            out = pd.DataFrame(rows_out, columns=["doc_id", "occurrence", "name", "offset", "n"])
            rows_out = []
            yield pa.RecordBatch.from_pandas(out, pa.schema([("doc_id", pa.int64()), ("occurrence", pa.int64()), ("name", pa.string()), ("offset", pa.int64()), ("n", pa.int64())]), preserve_index=False)
        if stream:
            close()

    placed = base.staged(dealt.mapInArrow(store, "doc_id long, occurrence long, name string, offset long, n long"), "placed")
    listed = placed.groupBy("name").agg(F.sum("n").alias("n_ids"), F.count("*").alias("n_docs")).orderBy("name").collect()
    table, first = [], 0
    for k, r in enumerate(listed):
        table.append((k, r["name"], first, r["n_ids"], r["n_docs"]))
        first += r["n_ids"]
    listing = spark.createDataFrame(table, "file int, name string, first long, n_ids long, n_docs long")
    _write_index(placed.join(listing.select("name", "file"), "name"), folder, rows // keys_per_index + 1)
    with files.open_output_stream(f"{path}/files.json") as stream:
        stream.write(json.dumps({"width": width, "files": [[n, f] for _, n, f, _, _ in table]}).encode())
    return listing


def key_hash(key, occurrence: int, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(f"{key}:{occurrence}", seed)


def _mix(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Slot hash of a key's hash and its bucket's displacement."""
    with np.errstate(over="ignore"):
        x = (h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def build_mph(hashes: np.ndarray, per_bucket: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of each bucket, and the slot of each key; hashes are different uint64.

    Large buckets first, each gets the smallest displacement that leads its keys to free slots.
    """
    m = len(hashes)
    buckets = max(1, (m + per_bucket - 1) // per_bucket)
    own = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    taken, shift, slots = np.zeros(m, bool), np.zeros(buckets, np.uint32), np.zeros(m, np.int64)
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        members = order[starts[b] : starts[b] + sizes[b]]
        at, width = 0, 32
        while True:
            d = np.arange(at, at + width, dtype=np.uint32)
            tries = (_mix(hashes[members][:, None], d[None, :]) % np.uint64(m)).astype(np.int64)
            free = ~taken[tries].any(0)
            if len(members) > 1:
                ordered = np.sort(tries, axis=0)
                free &= (ordered[1:] != ordered[:-1]).all(0)
            hits = np.flatnonzero(free)
            if len(hits):
                shift[b], slots[members] = d[hits[0]], tries[:, hits[0]]
                taken[slots[members]] = True
                break
            at, width = at + width, min(width * 2, 1 << 14)
    return shift, slots


def _write_index(placed: DataFrame, folder: str, parts: int) -> None:
    """One index file for each part of the keys."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        files, root = _open(folder)
        keys = ["None" if pd.isna(k) else str(int(k)) for k in group["doc_id"]]
        seed = 1
        while True:
            hashes = np.array([key_hash(k, o, seed) for k, o in zip(keys, group["occurrence"])], np.uint64)
            if len(np.unique(hashes)) == len(hashes):
                break
            seed += 1
        shift, slots = build_mph(hashes)
        table = np.zeros(len(group), SLOT)
        table["print"][slots] = [key_hash(k, o, 0) for k, o in zip(keys, group["occurrence"])]
        table["file"][slots], table["offset"][slots], table["n"][slots] = group["file"], group["offset"], group["n"]
        head = np.array([(len(group), len(shift), seed)], HEAD)
        name = f"index-{int(key[0]):06d}.mph"
        temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as stream:
            stream.write(head.tobytes() + shift.astype("<u4").tobytes() + table.tobytes())
        files.move(temporary, f"{root}/{name}")
        return pd.DataFrame({"part": [int(key[0])], "keys": [len(group)]})

    part = index_part(parts)
    built = placed.withColumn("part", part).groupBy("part").applyInPandas(build, "part int, keys long")
    full = sorted(r["part"] for r in built.select("part").collect())
    files, root = _open(folder)
    with files.open_output_stream(f"{root}/index.json") as stream:
        stream.write(json.dumps({"parts": parts, "full": full}).encode())


def index_part(parts: int):
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), F.col("occurrence").cast("string"))
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


class Index:
    """One index file in memory: slots by key."""

    def __init__(self, folder: str, part: int):
        files, root = _open(folder)
        with files.open_input_stream(f"{root}/index-{part:06d}.mph") as stream:
            data = stream.read()
        self.m, buckets, self.seed = (int(x) for x in np.frombuffer(data, HEAD, 1)[0])
        self.shift = np.frombuffer(data, "<u4", buckets, HEAD.itemsize)
        self.slots = np.frombuffer(data, SLOT, self.m, HEAD.itemsize + 4 * buckets)

    def find(self, keys: list, occurrences: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Slot rows of keys, and whether each key is there."""
        names = ["None" if k is None else str(k) for k in keys]
        h = np.array([key_hash(k, o, self.seed) for k, o in zip(names, occurrences)], np.uint64)
        prints = np.array([key_hash(k, o, 0) for k, o in zip(names, occurrences)], np.uint64)
        d = self.shift[(h % np.uint64(len(self.shift))).astype(np.int64)]
        rows = self.slots[(_mix(h, d) % np.uint64(self.m)).astype(np.int64)]
        return rows, rows["print"] == prints


def look_up(keys: DataFrame, folder: str) -> DataFrame:
    """doc_id, occurrence, name, first, offset, n for the keys (doc_id, occurrence) that the data set holds."""
    files, root = _open(folder)
    with files.open_input_stream(f"{root}/index.json") as stream:
        head = json.loads(stream.read())
    parts, full = head["parts"], set(head["full"])

    def find(batches):
        store, own_root = _open(folder)
        with store.open_input_stream(f"{own_root}/files.json") as stream:
            names = json.loads(stream.read())["files"]
        kept: dict[int, Index] = {}
        for batch in batches:
            for part, group in batch.to_pandas().groupby("part"):
                if int(part) not in full:
                    continue
                if part not in kept:
                    kept.clear()
                    kept[part] = Index(folder, int(part))
                ids = [None if pd.isna(k) else int(k) for k in group["doc_id"]]
                rows, there = kept[part].find(ids, group["occurrence"].tolist())
                rows = rows[there]
                out = {"doc_id": [k for k, t in zip(ids, there) if t], "occurrence": group["occurrence"][there], "name": [names[f][0] for f in rows["file"]], "first": [names[f][1] for f in rows["file"]], "offset": rows["offset"].astype("int64"), "n": rows["n"].astype("int64")}
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], list(out))

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("occurrence").cast("long").alias("occurrence")).withColumn("part", index_part(parts))
    if parts > 1:
        asked = asked.repartition(F.col("part")).sortWithinPartitions("part")
    return asked.mapInArrow(find, "doc_id long, occurrence long, name string, first long, offset long, n long")


def read(places: DataFrame, folder: str) -> DataFrame:
    """doc_id, occurrence, start (ids of all documents before), ids (binary, 32 bits each) by ``look_up``'s places."""
    driver_files, driver_root = _open(folder)
    with driver_files.open_input_stream(f"{driver_root}/files.json") as stream:
        width = json.loads(stream.read())["width"]

    def fetch(batches):
        files, root = _open(folder)
        name, stream = None, None
        for batch in base.pieces(batches):
            starts, ids = [], []
            for own, first, offset, n in zip(*[batch.column(c).to_pylist() for c in ("name", "first", "offset", "n")]):
                if own != name:
                    name, stream = own, files.open_input_file(f"{root}/{own}")
                stream.seek(offset)
                ids.append(np.frombuffer(stream.read(width * n), f"<u{width}").astype("<u4").tobytes())
                starts.append(first + offset // width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("occurrence"), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "occurrence", "start", "ids"])

    return places.repartition(F.col("name")).sortWithinPartitions("name", "offset").mapInArrow(fetch, "doc_id long, occurrence long, start long, ids binary")


def digests(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, written, found by key and read back."""
    spark: SparkSession = docs.sparkSession
    folder = folder or base.run_folder(spark, "token-files")
    write(docs, folder, tokenizer_path, end_id)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    repeats = plain.groupBy("doc_id").agg(F.count("*").alias("copies"))
    keys = repeats.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("occurrence"))
    found = read(look_up(keys, folder), folder)
    return found.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
