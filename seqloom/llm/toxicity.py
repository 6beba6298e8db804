"""Toxicity scores by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is a bag of itself and its character n-grams between word marks, hashed into BUCKETS rows of an embedding table,
so that a misspelt or inflected word shares most of its rows with the word. A document's vector is the average over its
bags; two linear outputs go through a softmax. Table and outputs are trained together with AdaGrad on a bounded sample
of the labelled rows: SAMPLE rows of each label at most, by the hash of doc_id; everything else is scored whole.

With two outputs, only the difference of their weights matters to a score, and the average is linear: a word's share of
the score is one number. Tasks keep it for words they meet again.

Defined results: null and empty texts score by the bias alone; words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, without
ASCII marks at either end (a word of marks alone keeps them); rows without a doc_id or a label are scored but not learned from; without labels every score is
0; repeated rows give repeated results; of labelled rows that repeat a doc_id the least text is learned from; texts of any
length are scored whole, a word at a time; an empty table gives an empty result. Only doc_id and text are read, and toxic of the labels.
"""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.llm.common import ship, small, staged

BUCKETS = 1 << 19
DIM = 8
GRAMS = (3, 4, 5)
#: Most rows of each label that the model is fitted on.
SAMPLE = 4000
EPOCHS, BATCH, RATE, DAMP = 5, 64, 0.5, 1e-2
#: Averages of hundreds of words are small; this brings them to the size that the rates are made for.
SCALE = 20.0
#: Rows that fewer documents of the sample use are left out; the others weigh by the log of their rarity.
LEAST = 10
#: A task's table of words is emptied at this size; words longer than LONG bytes are not kept.
HELD, LONG = 300_000, 64
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split(text: str | None) -> list[bytes]:
    return [w.strip(MARKS) or w for w in (text or "").encode().lower().split()]


def bag(word: bytes) -> list[int]:
    """Rows of the word and of its n-grams, in characters."""
    marked = "<" + word.decode(errors="replace") + ">"
    grams = {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [xxhash.xxh3_64_intdigest(g) % BUCKETS for g in sorted(grams)]


class Bags:
    """Bags of words, looked up where a word comes again."""

    def __init__(self):
        self.held: dict[bytes, np.ndarray] = {}

    def document(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their shares in the average."""
        parts = []
        for w in split(text):
            ids = self.held.get(w)
            if ids is None:
                ids = np.array(bag(w), np.int32)
                if len(self.held) < HELD // 3 and len(w) <= LONG:
                    self.held[w] = ids
            parts.append(ids)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        rows, n = np.unique(np.concatenate(parts), return_counts=True)
        return rows.astype(np.int32), (n * (SCALE / n.sum())).astype(np.float32)


def fit(texts: list[str | None], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Takes the texts out of their list. The score of each row (its weight, times its vector, times the difference of the outputs) and the bias."""
    bags, docs = Bags(), []
    while texts:
        docs.append(bags.document(texts.pop()))
    docs.reverse()
    used = np.zeros(BUCKETS, np.float32)
    for rows, _ in docs:
        used[rows] += 1
    weight = np.where(used >= min(LEAST, len(docs) / 50), np.log(len(docs) / np.maximum(used, 1)), 0).astype(np.float32)
    del bags
    for i, (rows, share) in enumerate(docs):  # in place: the sample's rows are most of the memory
        keep = weight[rows] > 0
        docs[i] = rows[keep], (share * weight[rows])[keep]
    rng = np.random.default_rng(seed)
    table = rng.uniform(-0.1 / DIM, 0.1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 1, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen, seen_out, seen_bias = np.full(BUCKETS, DAMP, np.float32), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            rows, share = (np.concatenate([docs[i][k] for i in pick]) for k in (0, 1))
            owner = np.repeat(np.arange(len(pick)), [len(docs[i][0]) for i in pick])
            mean = np.stack([np.bincount(owner, share * table[rows, d], len(pick)) for d in range(DIM)], 1)
            z = mean @ out.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            p /= len(pick)
            grad_out, grad_bias = p.T @ mean, p.sum(0)
            # with two outputs, a row's gradient lies along the difference of their weights
            line = out[1] - out[0]
            met, back = np.unique(rows, return_inverse=True)
            grad = np.bincount(back, share * p[owner, 1], len(met)).astype(np.float32)
            seen[met] += grad * grad * float(line @ line) / DIM
            table[met] -= (rate * grad / np.sqrt(seen[met]))[:, None] * line
            seen_out += grad_out * grad_out
            seen_bias += grad_bias * grad_bias
            out -= 0.1 * rate * grad_out / np.sqrt(seen_out)
            bias -= rate * grad_bias / np.sqrt(seen_bias)
    line = out[1] - out[0]
    return (weight * (table @ line)).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on labelled rows with crc32(doc_id as text) mod 5 above 0: ``sample`` of each label at most, lowest hashes first.

    The sample is bounded, so one task trains on it; what comes back is BUCKETS numbers."""
    spark = docs.sparkSession
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = staged(marked.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).withColumn("h", F.xxhash64("doc_id")), "toxic-labels")
    toxic, rest = (usable.where(which).count() for which in ("toxic = 1", "toxic <> 1"))
    parts = [usable.where(which).orderBy("h", "doc_id").limit(sample) for which in ("toxic = 1", "toxic <> 1")]
    chosen = parts[0].union(parts[1]).select("doc_id", F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic"), "h")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of rows that repeat a doc_id, the least text counts, so that reruns agree
    rows = rows.groupBy("h", "doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def one(batches):
        kept = sorted((h, d, t, y) for b in batches for h, d, t, y in zip(*(b.column(c).to_pylist() for c in ("h", "doc_id", "text", "toxic")), strict=True))
        if not kept or len({y for *_, y in kept}) < 2:
            return
        marks, texts = np.array([x[3] for x in kept]), [x[2] for x in kept]
        del kept
        score, bias = fit(texts, marks)
        # the sample's share of either label is not the rows' own: the bias is moved to theirs
        bias += math.log(marks.size / marks.sum() - 1) - math.log(rest / toxic)
        yield pa.RecordBatch.from_arrays([pa.array([score.tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["score", "bias"])

    got = rows.coalesce(1).select("h", "doc_id", "text", "toxic").mapInArrow(one, "score binary, bias double").collect()
    return (np.frombuffer(got[0][0], np.float32), got[0][1]) if got else (np.zeros(BUCKETS, np.float32), -math.inf)


@functools.lru_cache(1)
def _words(model: str) -> dict[bytes, tuple[float, int]]:
    """A worker's table of words for one model."""
    return {}


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The documents' doc_id and score, 0 to 1."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    name = uuid.uuid4().hex

    def run(batches):
        weight, bias = held.value
        known = _words(name)

        def word(w):
            ids = bag(w)
            found = (float(weight[ids].sum()), len(ids))
            if len(w) <= LONG:
                if len(known) >= HELD:
                    known.clear()
                known[w] = found
            return found

        for b in small(batches):
            out = []
            for t in b.column("text").to_pylist():
                total, n, get = 0.0, 0, known.get
                for w in split(t):
                    s, k = get(w) or word(w)
                    total += s
                    n += k
                z = (SCALE * total / n if n else 0.0) + bias
                out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns)), pa.array(out, pa.float64())], [*b.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with their own columns (their own score column too, if they have one)."""
    model = train(docs, labels)
    marked = score(docs.select(F.struct("*").alias("row"), "text"), model)
    return marked.where("score < 0.5").select("row.*")
