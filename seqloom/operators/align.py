"""Alignment of nucleotide sequences by seeds and extension without gaps.

Seeds are minimisers: of every ``word`` letters, the word of K letters with the least hash is kept, so two sequences
that share ``word`` letters share a kept word at the same place of them. Kept words are joined as rows, of the queries only
those that subjects have, where these are few enough for all tasks; what words of one pair and diagonal there are is counted before pairs meet their letters. In Arrow batches the
diagonal is looked at between its first and last seed for runs of ``word`` equal letters, and each run is extended to both
sides until its score falls by more than ``drop`` below its best. So the result is exactly the distinct extensions of all runs
of ``word`` equal letters; no seed is left out for being frequent. Rows of a frequent word are dealt out in blocks, each block of
one side meeting each of the other, so that none makes a large task.

Letters other than A, C, G, T equal nothing. Case does not count. Null and short sequences have no alignments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import sequences as Q
from seqloom.plans.stages import BROADCAST_ROWS, batches_bounded, stage

#: Longest seed: 31 letters of two bits are a whole number of 64 bits.
LONGEST = 31
#: Rows of a seed that make a block.
BLOCK = 2000
#: What equal and unequal letters score, and by how much a score may fall.
MATCH, MISMATCH, DROP = 2, 3, 20
CODES = np.full(256, 4, np.uint8)
CODES[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3, 0, 1, 2, 3]
HSP = "query string, subject string, pident double, length long, mismatches long, gaps long, qstart long, qend long, sstart long, send long, raw long"


def coded(text: str | None) -> np.ndarray:
    """0 to 3 for the four bases, 4 for all else."""
    return CODES[np.frombuffer((text or "").encode("latin-1", "replace"), np.uint8)]


def joined(texts: list[str | None], gap: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts of a batch one after the other, ``gap`` unknown letters behind each, and where each begins and ends."""
    ends = np.cumsum([len(t or "") + gap for t in texts], dtype=np.int64)
    return coded("".join((t or "") + "N" * gap for t in texts)), np.concatenate([[0], ends[:-1]]), ends - gap


def packed(x: np.ndarray, k: int) -> np.ndarray:
    """The words of k letters from every start, two bits a letter, put together from those of half as many letters."""
    part, size, whole, done = x.astype(np.uint64) & np.uint64(3), 1, None, 0
    while True:
        if k & size:
            n = max(len(x) - done - size + 1, 0)
            whole = part[:n] if whole is None else whole[:n] << np.uint64(2 * size) | part[done : done + n]
            done += size
        if done == k:
            return whole
        part, size = part[: max(len(part) - size, 0)] << np.uint64(2 * size) | part[size:], 2 * size


def least_of(hashes: np.ndarray, w: int) -> np.ndarray:
    """The place of the least (the first, of equal ones) of every w neighbours."""
    n = len(hashes) - w + 1
    best, where = hashes[:n], np.zeros(n, np.int64)
    for i in range(1, w):
        less = hashes[i : i + n] < best
        best, where = np.where(less, hashes[i : i + n], best), np.where(less, i, where)
    return where + np.arange(n)


def few(codes: DataFrame):
    """The distinct codes, in order, for all tasks, if they have been counted to be few; else None."""
    found = stage(codes.select("code").distinct())
    if found.count() > BROADCAST_ROWS:
        return None
    return codes.sparkSession.sparkContext.broadcast(np.sort(np.array([r["code"] for r in found.collect()], np.int64)))


def among(codes: np.ndarray, some) -> np.ndarray:
    """Which of the codes are among ``few``'s; all, where that is None."""
    if some is None or not len(some.value):
        return np.full(len(codes), some is None)
    known, codes = some.value, codes.view(np.int64)
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


def minimisers(x: np.ndarray, k: int, word: int, part: int = 1 << 18, some=None) -> tuple[np.ndarray, np.ndarray]:
    """Places and words (of k letters) that are the least in some ``word`` letters without unknown ones, and among ``some``."""
    w = word - k + 1
    places, words = [], []
    for begin in range(0, max(len(x) - word + 1, 0), part):
        piece = x[begin : begin + part + word - 1]
        code = packed(piece, k)
        unknown = np.concatenate([[0], np.cumsum(piece > 3)])
        fine = unknown[word:] == unknown[:-word]
        at = np.unique(least_of(Q.scrambled(code), w)[fine])
        at = at[among(code[at], some)]
        places.append(at + begin)
        words.append(code[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, words = np.concatenate(places), np.concatenate(words)
    at = np.unique(places, return_index=True)[1]  # parts overlap
    return places[at], words[at]


def seeds(seqs: DataFrame, word: int, some=None) -> DataFrame:
    """name, code, pos of the minimisers of (name, seq), of those among ``some``, a batch's texts at once. Seeds are a few letters
    shorter than ``word``, so that one in some of them is kept."""
    k = min(LONGEST, word - max(1, word // 6))

    def run(batches):
        for b in batches:
            x, begins, _ = joined(b.column("seq").to_pylist())
            at, code = minimisers(x, k, word, some=some)
            row = np.searchsorted(begins, at, side="right") - 1
            yield pa.RecordBatch.from_arrays([b.column("name").take(pa.array(row)), pa.array(code.view(np.int64)), pa.array(at - begins[row])], ["name", "code", "pos"])

    return seqs.select("name", "seq").mapInArrow(run, "name string, code long, pos long")


def dealt(left: DataFrame, right: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Both tables of seeds with i and j, for a join by code, i and j: the rows of a frequent code are in blocks, each
    repeated for every block of the other side."""
    count = lambda t, c: t.groupBy("code").agg(F.count("*").alias(c))
    many = count(left, "n").join(count(right, "m"), "code").where(F.greatest("n", "m") > block)
    many = stage(many.select("code", F.ceil(F.col("n") / block).alias("left"), F.ceil(F.col("m") / block).alias("right")))
    one = F.lit(1).cast("long")

    def side(t: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        rows = t.join(many, "code", "left").withColumns({own: F.coalesce(own, one), other: F.coalesce(other, one)})
        return rows.select(*t.columns, F.pmod(F.xxhash64("name", "pos"), F.col(own)).alias(mine), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(theirs))

    if many.isEmpty():
        return (t.withColumns({"i": F.lit(0).cast("long"), "j": F.lit(0).cast("long")}) for t in (left, right))
    return side(left, "left", "right", "i", "j"), side(right, "right", "left", "j", "i")


def diagonals(queries: DataFrame, subjects: DataFrame, word: int) -> DataFrame:
    """query, subject, diag (place in the query less place in the subject), lo, hi (first and last seed's place in the query)."""
    theirs = stage(seeds(subjects, word))
    q, s = dealt(stage(seeds(queries, word, few(theirs))), theirs)
    met = q.select("code", "i", "j", F.col("name").alias("query"), F.col("pos").alias("qpos")).join(s.select("code", "i", "j", F.col("name").alias("subject"), F.col("pos").alias("spos")), ["code", "i", "j"])
    return met.groupBy("query", "subject", (F.col("qpos") - F.col("spos")).alias("diag")).agg(F.min("qpos").alias("lo"), F.max("qpos").alias("hi"))


def reach(scored, n: int, drop: int, part: int = 256) -> int:
    """How many of n letters an extension takes: up to its best score, before the score falls by over ``drop`` below that.
    ``scored(i, j)`` are the scores of letters i to j."""
    best, where, score, at = 0, 0, 0, 0
    while at < n:
        run = score + np.cumsum(scored(at, min(at + part, n)))
        top = np.maximum(np.maximum.accumulate(run), best)
        over = np.flatnonzero(top - run > drop)
        stop = int(over[0]) if len(over) else len(run)
        if stop and run[:stop].max() > best:
            best, where = int(run[:stop].max()), at + int(run[:stop].argmax()) + 1
        if len(over):
            break
        score, at, part = int(run[-1]), at + part, 4 * part
    return where


def extensions(x: np.ndarray, y: np.ndarray, diag: int, lo: int, hi: int, word: int, match: int = MATCH, mismatch: int = MISMATCH, drop: int = DROP) -> list[tuple[int, int, int]]:
    """Begin and end (in x) of the extended runs on a diagonal, and their equal letters. All runs of ``word`` letters lie within
    ``word`` letters of the seeds from ``lo`` to ``hi``."""
    first, last = max(0, diag), min(len(x), len(y) + diag)

    def same(a: int, b: int) -> np.ndarray:
        return (x[a:b] == y[a - diag : b - diag]) & (x[a:b] < 4)

    def scores(a: int, b: int) -> np.ndarray:
        return np.where(same(a, b), match, -mismatch)

    # a run may go on for long on both sides of the seeds
    a, b = max(first, lo - word), min(last, hi + 2 * word)
    while a > first and same(a, a + 1)[0]:
        a = max(first, a - 4 * word)
    while b < last and same(b - 1, b)[0]:
        b = min(last, b + 4 * word)
    edge = np.diff(np.concatenate([[0], same(a, b).astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1) + a, np.flatnonzero(edge == -1) + a
    found = set()
    for s, e in zip(begins.tolist(), ends.tolist(), strict=True):
        if e - s >= word:
            back = reach(lambda i, j: scores(s - j, s - i)[::-1], s - first, drop)  # noqa: B023
            on = reach(lambda i, j: scores(e + i, e + j), last - e, drop)  # noqa: B023
            found.add((s - back, e + on))
    return [(s, e, int(np.count_nonzero(same(s, e)))) for s, e in sorted(found)]


def aligned(queries: DataFrame, subjects: DataFrame, word: int = 27, match: int = MATCH, mismatch: int = MISMATCH, drop: int = DROP) -> DataFrame:
    """Alignments of (name, seq) with (name, seq) on the same strand, as the tables of ``hsps`` with raw and bits: a row for each
    pair, diagonal and stretch. Places count from 1. A sequence meets itself where it is on both sides."""
    batches_bounded(queries.sparkSession)
    found = diagonals(queries, subjects, word)
    pairs = found.groupBy("query", "subject").agg(F.collect_list(F.struct("diag", "lo", "hi")).alias("spots"))
    rows = pairs.join(queries.select(F.col("name").cast("string").alias("query"), F.col("seq").alias("x")), "query").join(subjects.select(F.col("name").cast("string").alias("subject"), F.col("seq").alias("y")), "subject")
    names = [c.split()[0] for c in HSP.split(", ")]

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                x, y = coded(r["x"]), coded(r["y"])
                for spot in r["spots"]:
                    for s, e, good in extensions(x, y, spot["diag"], spot["lo"], spot["hi"], word, match, mismatch, drop):
                        d, bad = spot["diag"], e - s - good
                        out.append((r["query"], r["subject"], 100.0 * good / (e - s), e - s, bad, 0, s + 1, e, s - d + 1, e - d, match * good - mismatch * bad))
            if out:
                kinds = [pa.string(), pa.string(), pa.float64(), *[pa.int64()] * 8]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.select("query", "subject", "x", "y", "spots").mapInArrow(run, HSP).withColumn("bits", S.raw_to_bits(F.col("raw").cast("double")))


def both_strands(queries: DataFrame, subjects: DataFrame, word: int = 27) -> DataFrame:
    """As ``aligned``, with the queries' other strand too; where that is aligned, sstart is beyond send, as aligners write it.
    evalue is the number of such scores that chance would give over all subjects."""
    named = queries.select(F.col("name").alias("def"), "seq")
    rows = aligned(Q.both_strands(named).select(F.col("def").alias("name"), "seq"), subjects, word)
    back = F.col("query").endswith(";rev=1")
    letters = subjects.agg(F.sum(F.length("seq")).alias("n")).first()["n"] or 0
    lengths = queries.select(F.col("name").cast("string").alias("query"), F.length("seq").alias("n"))
    told = rows.withColumns({"back": back, "query": F.regexp_replace("query", ";rev=1$", "")}).join(lengths, "query")
    flipped = {"qstart": F.col("n") - F.col("qend") + 1, "qend": F.col("n") - F.col("qstart") + 1, "sstart": F.col("send"), "send": F.col("sstart")}
    places = {c: F.when(F.col("back"), v).otherwise(F.col(c)) for c, v in flipped.items()}
    return told.withColumn("evalue", F.col("n") * float(letters) * F.pow(F.lit(2.0), -F.col("bits"))).select(*[places.get(c, F.col(c)).alias(c) for c in rows.columns], "evalue")
