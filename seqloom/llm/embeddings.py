"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosine checks.

Vectors are brought to length 1, so that a cosine of 0.9 is a distance of 0.447. A table hashes a vector by K quantised
projections floor((a . v + b) / W), a normal and b uniform. K grows with the log of the number of vectors, so that few
strangers share a bucket, and the number of tables follows from K so that a pair at the threshold is missed by all with
a chance of MISS (closer pairs: far less). Tables are at most TABLES: beyond some 10^5 vectors, buckets grow instead. Every
vector is in every table.

Vectors move to buckets of several alone. There, all cosines are taken in double precision, for all buckets of a batch at
once, or as a matrix product in a large one. A pair that collides in an earlier table too is left to that table, so each
link is seen once and counts add up. No pairs leave a task: it reports links per vector and the components within the
bucket. A bucket above BLOCK vectors is cut, and each pair of its parts is a task of its own. Copies of a vector are one
node with a count.

Defined results: vectors that are null, empty or zero or hold null or non-finite components link with nothing, as do
rows without a vec_id and vectors of different lengths; rows that repeat a vec_id count as vectors of their own, so that a
repeated vector is a copy and another one under the same vec_id links by itself; an empty table gives an empty result. Only
vec_id (integral) and embedding are read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components, ship, small, staged

W, MISS, BLOCK = 2.0, 0.01, 2048
#: Most tables; projections beyond those that leave one stranger a bucket; the largest bucket that is not a matrix product.
TABLES, MORE, FEW = 160, 3, 32


def chance(distance: float) -> float:
    """That one quantised projection of width W agrees for two vectors at the distance."""
    r = W / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, cosine: float) -> tuple[int, int]:
    """Projections a table and tables, for n vectors."""
    tables = lambda k: math.ceil(math.log(MISS) / math.log(1 - chance(math.sqrt(2 - 2 * cosine)) ** k))
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(chance(math.sqrt(2))))) + MORE
    while k > 4 and tables(k) > TABLES:
        k -= 1
    return k, tables(k)


@functools.lru_cache(8)
def projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([2024, dim, k])
    return rng.normal(size=(dim, k * tables)), rng.uniform(0, W, k * tables), rng.integers(1, 1 << 62, k * tables) * 2 + 1


def buckets(v: np.ndarray, k: int, tables: int) -> np.ndarray:
    """A 64-bit bucket of each vector in each table."""
    a, b, odd = projections(v.shape[1], k, tables)
    code = np.floor((v @ a + b) / W).astype(np.int64)
    with np.errstate(over="ignore"):
        x = (code * odd).reshape(len(v), tables, k).sum(2) + np.arange(tables) * 0x9E3779B97F4A7C1 + v.shape[1]
        x ^= x >> 31
        x *= 0x7FB5D329728EA185
        return x ^ (x >> 29)


class Vectors:
    """A binary column of vectors, read where Arrow holds it: the bytes of each, and rows of one length as unit vectors."""

    def __init__(self, column, kind: str):
        column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        self.length, self.begin, self.kind = np.diff(ends), ends[:-1], np.dtype(kind)
        self.data = np.frombuffer(column.buffers()[2], np.uint8)
        same = len(self.length) and (self.length == self.length[0]).all()
        self.whole = self.data[ends[0] : ends[-1]].reshape(len(self.length), -1) if same else None

    def unit(self, rows: np.ndarray) -> np.ndarray:
        flat = self.data[self.begin[rows][:, None] + np.arange(int(self.length[rows[0]]))] if self.whole is None else self.whole[rows]
        v = flat.view(self.kind).astype("<f8")
        return v / np.linalg.norm(v, axis=1, keepdims=True)


def read_vectors(table: DataFrame) -> tuple[DataFrame, str]:
    """vec_id, digest and data (null where the vector links with nothing), and the numbers that data holds: those of the table
    where they are 32-bit, else 64-bit ones scaled so that squares neither overflow nor vanish."""
    kind = "<f4" if "float" in dict(table.dtypes)["embedding"] else "<f8"

    def run(batches):
        for b in small(batches):
            digests, data = [], []
            for d, x in zip(b.column("vec_id").to_pylist(), b.column("embedding"), strict=True):
                ok = d is not None and x.is_valid and len(x.values) and not x.values.null_count
                v = x.values.to_numpy(zero_copy_only=False).astype(kind) if ok else np.zeros(0)
                top = np.abs(v).max(initial=0)
                ok = ok and 0 < top < np.inf and np.isfinite(v).all()
                raw = ((v if kind == "<f4" else v / top) + np.zeros(1, kind)).tobytes() if ok else None
                digests.append(hashlib.sha256(raw).digest()[:16] if ok else None)
                data.append(raw)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(digests, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "digest", "data"])

    numbers = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"))
    return numbers.mapInArrow(run, "vec_id long, digest binary, data binary"), kind


def near_duplicates(table: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = table.sparkSession
    ship(spark)
    read, kind = read_vectors(table)
    rows = staged(read, "vectors")
    one = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("data").alias("data"))
    vectors = staged(one.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    classes = vectors.drop("data")
    k, tables = plan(vectors.count(), cosine)

    def hashed(batches):
        for b in small(batches):
            data, node = Vectors(b.column("data"), kind), b.column("node").to_numpy()
            for size in np.unique(data.length):
                at = np.flatnonzero(data.length == size)
                x = buckets(data.unit(at), k, tables)
                yield pa.RecordBatch.from_arrays([pa.array(x.reshape(-1)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))), pa.array(np.repeat(node[at], tables))], ["bucket", "t", "node"])

    member = staged(vectors.mapInArrow(hashed, "bucket long, t int, node long"), "vector-buckets")
    full = member.groupBy("bucket", "t").agg(F.count("*").alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    met = member.join(full.hint("merge"), ["bucket", "t"]).withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = met.join(vectors.hint("merge"), "node").select("bucket", "t", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "copies", "data")
    dealt = met.repartition("bucket", "t", "i", "j").sortWithinPartitions("bucket", "t", "i", "j")
    names = ["bucket", "t", "i", "j"]

    def linked(batches):
        """Runs of equal (bucket, t, i, j) follow each other, also over the ends of batches."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(c).to_numpy() for c in names])
            other = np.flatnonzero((key != key[:, -1:]).any(0))
            if len(other):
                cut = int(other[-1]) + 1
                yield from _links(pa.Table.from_batches([*held, b.slice(0, cut)]), kind, k, tables, cosine)
                b, held = b.slice(cut), []
            held.append(b)
        if held:
            yield from _links(pa.Table.from_batches(held), kind, k, tables, cosine)

    found = staged(dealt.mapInArrow(linked, "node long, links long, root long"), "vector-links")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per = classes.join(total, "node", "left").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = per.groupBy("component").agg(F.min("least").alias("c"))
    place = staged(per.join(least, "component").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "c"), "vector-places")
    # copies of one vector can be a third of all rows: Spark splits them, as a place is one row
    out = rows.drop("data").join(place, "digest", "left")
    whole = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), whole.alias("component_id"), F.coalesce(F.col("vec_id") == whole, F.lit(True)).alias("kept"))


def _links(t: pa.Table, kind: str, k: int, tables: int, cosine: float):
    """Of whole runs: a row per vector with links, its links by copies, and its least fellow."""
    key = np.stack([t.column(c).to_numpy() for c in ("bucket", "t", "i", "j")])
    start = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
    size = np.diff(np.append(start, len(t)))
    part, node, copies = (t.column(c).to_numpy() for c in ("part", "node", "copies"))
    data = Vectors(t.column("data"), kind)
    length = data.length
    few = np.repeat(size <= FEW, size)
    group = np.repeat(np.arange(len(size)), size)
    for n in np.unique(length):  # vectors of one length do not share buckets with others
        rows = np.flatnonzero(few & (length == n))
        if len(rows):
            pairs = []
            v = data.unit(rows)
            for d in range(1, FEW):
                p = np.flatnonzero(group[rows[d:]] == group[rows[:-d]])
                if not len(p):
                    break
                x, y = rows[p], rows[p + d]
                p = p[(key[2][x] == key[3][x]) | (part[x] != part[y])]
                p = p[np.einsum("ij,ij->i", v[p], v[p + d]) >= cosine]
                pairs.append((p, p + d))
            p, q = (np.concatenate([x[c] for x in pairs]) if pairs else np.zeros(0, np.int64) for c in (0, 1))
            if len(p):
                used, back = np.unique(np.concatenate([p, q]), return_inverse=True)
                code = buckets(v[used], k, tables)
                table = key[1][rows]
                keep = np.ones(len(p), bool)
                for at in range(0, len(p), 4096):
                    keep[at : at + 4096] = _first(code, back[: len(p)][at : at + 4096], back[len(p) :][at : at + 4096], table[p[at : at + 4096]])
                yield from _told(rows, p[keep], q[keep], node, copies)
    for g in np.flatnonzero(size > FEW):
        rows = np.arange(start[g], start[g] + size[g])
        v = data.unit(rows) if (length[rows] == length[rows[0]]).all() else None
        if v is None:
            continue
        near = v @ v.T >= cosine
        if key[2, start[g]] != key[3, start[g]]:
            near &= part[rows][:, None] != part[rows]
        near = np.triu(near, 1)
        at = np.flatnonzero(near.any(0) | near.any(1))
        if len(at):
            near, code = near[np.ix_(at, at)], buckets(v[at], k, tables)
            for s in range(int(key[1, start[g]])):
                near &= code[:, s][:, None] != code[:, s]
            yield from _told(rows[at], *np.nonzero(near), node, copies)


def _first(code: np.ndarray, p: np.ndarray, q: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether a pair shares no table before the one it was met in."""
    return ~((code[p] == code[q]) & (np.arange(code.shape[1]) < table[:, None])).any(1)


def _told(rows: np.ndarray, p: np.ndarray, q: np.ndarray, node: np.ndarray, copies: np.ndarray):
    """What the links between rows[p] and rows[q] come to, per row."""
    if not len(p):
        return
    mine = node[rows]
    links = np.bincount(p, copies[rows[q]], len(rows)) + np.bincount(q, copies[rows[p]], len(rows))
    root = mine.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, p, root[q])
        np.minimum.at(new, q, root[p])
        if (new == root).all():
            break
        root = new
    has = links > 0
    yield pa.RecordBatch.from_arrays([pa.array(mine[has]), pa.array(links[has].astype(np.int64)), pa.array(root[has])], ["node", "links", "root"])
