"""Exact deduplication over an extendible-hash index in shared files.

1. ``keys``: each row gets the 64-bit hash and the SHA-256 of its text without ASCII white space.
2. ``build_index``: tasks first merge the copies they hold themselves (a hot text leaves a task once in HELD bytes),
   then rows go by hash range to owner tasks. An owner keeps a directory of 2^depth slots over buckets; an overfull bucket
   is split and the directory doubled when needed. Keys that are equal in all 64 bits are chained in one bucket, and
   members of a chain are told apart by comparing bytes. Each owner writes its directory and buckets to the shared
   folder under a name of its attempt and returns a row for the manifest.
3. ``read_index``: tasks map the files of the manifest and return an entry per distinct text.
4. ``exact_dedup``: rows are joined to their entries; Spark splits a skewed key's rows, since an entry is one row.

Defined results: null text counts as empty, so null, empty and all-white texts are copies of each other; a null
doc_id sorts after every other; repeated rows count as copies; an empty table gives an empty result. Only the
columns doc_id (integral) and text are read, so further columns and their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import files
from seqloom.llm.common import shared_dir, ship, small, staged

SPACE = b" \t\n\x0b\x0c\r"
BUCKET = 256
#: One entry of a bucket page.
ENTRY = np.dtype([("key", "<i8"), ("keep", "<i8"), ("null", "?"), ("points", "<i8"), ("count", "<i8"), ("sha", "S64")])
MAGIC = b"XHASH001"
#: Bytes of distinct texts in which a task merges copies before it hands them on.
HELD = 32 << 20


def squeeze(text: str | None) -> bytes:
    """The text without ASCII white space, in UTF-8."""
    return (text or "").encode().translate(None, SPACE)


def key_of(data: bytes) -> int:
    """64 bits, signed as Spark has them."""
    n = xxhash.xxh3_64_intdigest(data)
    return n - (1 << 64) if n >> 63 else n


class ExtendibleIndex:
    """Directory of 2^depth slots on the low bits of the key; a bucket is [depth, {key: chain of entries}]."""

    def __init__(self, size: int = BUCKET):
        self.size, self.depth, self.slots = size, 0, [[0, {}]]

    def chain(self, key: int) -> list:
        """The chain of the key, new if there is none; splits the bucket until it has room."""
        while True:
            depth, held = bucket = self.slots[key & ((1 << self.depth) - 1)]
            if key in held or len(held) < self.size:
                return held.setdefault(key, [])
            if depth == self.depth:
                self.slots += self.slots
                self.depth += 1
            low, high = [depth + 1, {}], [depth + 1, {}]
            for k, v in held.items():
                (high if k >> depth & 1 else low)[1][k] = v
            first = key & ((1 << depth) - 1)
            for i in range(first, len(self.slots), 1 << depth):
                self.slots[i] = high if i >> depth & 1 else low
            del bucket

    def pages(self) -> Iterator[bytes]:
        """The file: magic, depth, number of buckets; the directory; where buckets end; their entries."""
        number, buckets = {}, []
        for b in self.slots:
            if id(b) not in number:
                number[id(b)] = len(buckets)
                buckets.append(b)
        rows = [[e for chain in held.values() for e in chain] for _, held in buckets]
        yield MAGIC + np.array([self.depth, len(buckets)], "<u4").tobytes()
        yield np.array([number[id(b)] for b in self.slots], "<u4").tobytes()
        yield np.cumsum([len(r) for r in rows]).astype("<u8").tobytes()
        for r in rows:
            yield np.array([tuple(e) for e in r], ENTRY).tobytes()


def open_index(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directory, ends of buckets and entries of an index file, as views."""
    if bytes(data[:8]) != MAGIC:
        raise ValueError("not an index file")
    depth, n = np.frombuffer(data, "<u4", 2, 8)
    slots = np.frombuffer(data, "<u4", 1 << int(depth), 16)
    at = 16 + 4 * len(slots)
    ends = np.frombuffer(data, "<u8", int(n), at)
    return slots, ends, np.frombuffer(data, ENTRY, int(ends[-1]) if n else 0, at + 8 * int(n))


def look_up(data, key: int) -> np.ndarray:
    """The entries of one key: one directory slot, one bucket."""
    slots, ends, entries = open_index(data)
    b = int(slots[key & (len(slots) - 1)])
    page = entries[int(ends[b - 1]) if b else 0 : int(ends[b])]
    return page[page["key"] == key]


def keys(docs: DataFrame) -> DataFrame:
    """A narrow row per document: doc_id, key, text_sha256, points (code points of the original text)."""
    def run(batches):
        for b in small(batches):
            texts = b.column("text").to_pylist()
            data = [squeeze(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(key_of, data), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()), pa.array([len(t or "") for t in texts], pa.int64())],
                ["doc_id", "key", "text_sha256", "points"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, key long, text_sha256 string, points long")


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (doc_id or None, points): more points, then the smaller id."""
    rank = lambda x: (-x[1], x[0] is None, x[0] or 0)
    return min(a, b, key=rank)


def even_numbers(spark: SparkSession, n: int) -> list[int]:
    """For each of n owners a number of its own, such that hash partitioning by it gives every owner a task of its own."""
    place = F.pmod(F.hash("number"), F.lit(n))
    found = spark.range(24 * n).select(F.col("id").cast("int").alias("number")).groupBy(place.alias("place")).agg(F.min("number").alias("number")).collect()
    free = iter(range(24 * n, 25 * n))
    by_place = dict(map(tuple, found))
    return [by_place[p] if p in by_place else next(free) for p in range(n)]


def build_index(docs: DataFrame, owners: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """Write the index; return its manifest (owner, path, entries). ``owners`` defaults to twice the input splits."""
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    owners = owners or max(8, 2 * narrow.rdd.getNumPartitions())
    root = shared_dir(docs.sparkSession, "exact-index")

    numbers = even_numbers(docs.sparkSession, owners)

    def merged(batches):
        found: dict[bytes, list] = {}
        held = 0

        def handed():
            """Some rows at a time, as texts can be long."""
            names = list(found)
            for at in range(0, len(names), 1000):
                part = names[at : at + 1000]
                key, best = [key_of(x) for x in part], [found[x] for x in part]
                owner = [numbers[(k + (1 << 63)) * owners >> 64] for k in key]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner, pa.int32()), pa.array(key, pa.int64()), pa.array([x[0][0] for x in best], pa.int64()), pa.array([x[0][1] for x in best], pa.int64()), pa.array([x[1] for x in best], pa.int64()), pa.array(part, pa.binary())],
                    ["owner", "key", "keep", "points", "count", "data"],
                )
            found.clear()

        for b in small(batches):
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                data, new = squeeze(t), (d, len(t or ""))
                if (old := found.get(data)) is None:
                    found[data] = [new, 1]
                    held += len(data)
                else:
                    old[0], old[1] = _better(old[0], new), old[1] + 1
            if held > HELD:
                yield from handed()
                held = 0
        yield from handed()

    def owned(batches):
        index, owner, last, chain_data = ExtendibleIndex(bucket), None, None, []

        def close():
            path = files.write(f"{root}/owner-{owner:08d}", index.pages())
            n = sum(len(c) for b in {id(b): b for b in index.slots}.values() for c in b[1].values())
            return pa.RecordBatch.from_arrays([pa.array([owner], pa.int32()), pa.array([path]), pa.array([n], pa.int64())], ["owner", "path", "entries"])

        for b in small(batches):
            for o, k, d, p, c, data in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if o != owner:
                    if owner is not None:
                        yield close()
                    index, owner, last = ExtendibleIndex(bucket), o, None
                if k != last:  # rows come by key, so only one chain's bytes are held
                    last, chain_data = k, []
                chain = index.chain(k)
                at = next((i for i, x in enumerate(chain_data) if x == data), None)
                if at is None:
                    chain_data.append(data)
                    chain.append([k, d or 0, d is None, p, c, hashlib.sha256(data).hexdigest().encode()])
                else:
                    e = chain[at]
                    keep, points = _better((None if e[2] else e[1], e[3]), (d, p))
                    e[1:5] = [keep or 0, keep is None, points, e[4] + c]
        if owner is not None:
            yield close()

    rows = narrow.mapInArrow(merged, "owner int, key long, keep long, points long, count long, data binary")
    dealt = rows.repartition(owners, "owner").sortWithinPartitions("owner", "key")
    return staged(dealt.mapInArrow(owned, "owner int, path string, entries long"), "exact-manifest")


def read_index(manifest: DataFrame) -> DataFrame:
    """An entry per distinct text: key, text_sha256, keep_id, group_size."""
    def run(batches):
        for b in small(batches):
            for path in b.column("path").to_pylist():
                _, _, e = open_index(files.mapped(path))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(e["key"]), pa.array(e["sha"].astype("U64"), pa.string()), pa.array(e["keep"], mask=e["null"]), pa.array(e["count"])],
                    ["key", "text_sha256", "keep_id", "group_size"],
                )

    return manifest.repartition(max(8, manifest.sparkSession.sparkContext.defaultParallelism), "path").mapInArrow(run, "key long, text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256; equal texts share keep_id."""
    ship(docs.sparkSession)
    # entries grow with the documents, whatever Spark guesses of their size: they are never broadcast
    found = keys(docs).join(read_index(build_index(docs)).hint("merge"), ["key", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents, each text once (the row that ``exact_dedup`` keeps), with their own columns, whatever their names.

    Rows that repeat a doc_id and its text are one document: one of them stays.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    ids = exact_dedup(docs).where("kept").select(name.alias("id"), F.col("text_sha256").alias("sha")).distinct()
    squeezed = F.translate(F.coalesce("text", F.lit("")), SPACE.decode(), "")
    rows = docs.select(F.struct("*").alias("row"), name.alias("id"), F.sha2(squeezed, 256).alias("sha"))
    return rows.join(ids, ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
