"""Improvement of sequences by their own reads, cycle by cycle, until they no longer change.

A cycle merges the sequences, pads them, maps the reads onto them, and rebuilds each from the reads' votes. Early cycles map
loosely on wide pads; the radius grows until it is strict, and then pads are gone and merging is strict, too. After each
cycle a sequence is compared with what it was: settled ones are kept as they then are, and go on in the cycles, as others may
still merge with them. Cycles end when all are settled and none has gone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import align, pileup, zipper
from seqloom.operators import sequences as Q
from seqloom.plans.stages import batches_bounded, stage

#: Longest sequences that are compared letter by letter with swaps.
EDITED = 5000
#: Letters that alignments of longer ones share at least.
WORD = 50
#: Cycles after which one seen before, or nearly the same, is settled; and its share of differing letters then.
SEEN, LATE, NEAR, NEAR_LATE = 2, 5, 0.005, 0.01


@dataclass(frozen=True)
class Setting:
    """What a cycle maps with."""

    cycle: int
    radius: float
    pad: int
    strict: bool


def schedule(cycles: int = 40, first: float = 0.80, last: float = 0.97, pad: int = 300):
    """The settings of the cycles: the radius grows so that it would pass ``last`` after half of them."""
    radius = first
    for cycle in range(cycles):
        strict = radius > last
        radius = min(radius, last)
        yield Setting(cycle, radius, 0 if strict else pad, strict)
        radius += (last - first) / (cycles / 2)


def distance(before: str, after: str, edited: int = EDITED, word: int = WORD) -> int:
    """Differing letters of two sequences without N and in upper case: place by place where they are equally long, edits and
    swaps up to ``edited`` letters, beyond that what alignments of ``word`` letters and more leave over of both."""
    if before == after:
        return 0
    x, y = (np.frombuffer(s.encode(), np.uint8) for s in (before, after))
    if len(x) == len(y):
        return int(np.count_nonzero(x != y))
    if max(len(x), len(y)) <= edited:
        return S.damerau_distance(before, after)
    found = sorted(alignments(before, after, word), key=lambda h: (-h[3], h[:2]))
    # an alignment that lies within a better one does not count again
    kept = [h for i, h in enumerate(found) if not any(o[0] <= h[0] and h[1] <= o[1] for o in found[:i])]
    left = len(x) + len(y) - sum(int(good / (e - s) * 2 * (e - s)) for s, e, good, _ in kept)
    if kept and left >= 0:
        return left
    # alignments that overlap leave less than nothing
    if found and len(x) + len(y) < 2 * found[0][2]:
        return len(y)
    return S.damerau_distance(before, after, swaps=False)


def alignments(before: str, after: str, word: int) -> list[tuple[int, int, int, int]]:
    """Begin, end (in before), equal letters and score of the alignments of two sequences."""
    x, y, k = align.coded(before), align.coded(after), min(align.LONGEST, word - max(1, word // 6))
    (px, cx), (py, cy) = (align.minimisers(s, k, word) for s in (x, y))
    order = np.argsort(cy, kind="stable")
    lo, hi = (np.searchsorted(cy[order], cx, side) for side in ("left", "right"))
    spots: dict[int, list[int]] = {}
    for p, i, j in zip(px.tolist(), lo.tolist(), hi.tolist(), strict=True):
        for q in py[order[i:j]].tolist():
            spots.setdefault(p - q, []).append(p)
    return [(s, e, good, align.MATCH * good - align.MISMATCH * (e - s - good)) for d, at in spots.items() for s, e, good in align.extensions(x, y, d, min(at), max(at), word)]


def compared(rows: DataFrame) -> DataFrame:
    """``rows`` (before, after, …) with distance, as a share of the letters of after."""
    batches_bounded(rows.sparkSession)
    bare = lambda c: F.upper(F.translate(c, "Nn", ""))
    kinds, names = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes), rows.columns

    def run(batches):
        for b in batches:
            d = [distance(x, y) / max(len(y), 1) for x, y in zip(b.column("_x").to_pylist(), b.column("_y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(d, pa.float64())], [*names, "distance"])

    return rows.withColumns({"_x": bare("before"), "_y": bare("after")}).mapInArrow(run, f"{kinds}, distance double")


def mapped(reads: DataFrame, scaffolds: DataFrame, identity: float, word: int = 15) -> DataFrame:
    """reference, pos, cigar, seq, size, id: each read (name, seq, size) on the scaffold (reference, seq) where it scores best, on
    either strand, as far as it aligns; of equal places one by a hash. Letters beyond are clipped."""
    named = reads.select(F.col("name").cast("string").alias("name"), "seq", "size")
    strands = Q.both_strands(named.select(F.col("name").alias("def"), "seq")).select(F.col("def").alias("name"), "seq")
    found = align.aligned(strands, scaffolds.select(F.col("reference").alias("name"), F.upper("seq").alias("seq")), word).where(F.col("pident") >= 100 * identity)
    read = F.regexp_replace("query", ";rev=1$", "")
    chance = F.xxhash64("query", "subject", "sstart")
    place = Window.partitionBy("read").orderBy(F.desc("raw"), chance, "query", "subject", "sstart", "qstart")
    best = found.withColumn("read", read).withColumn("rn", F.row_number().over(place)).where("rn = 1")
    rows = best.join(strands.select(F.col("name").alias("query"), "seq"), "query").join(named.select(F.col("name").alias("read"), "size"), "read")
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    cigar = F.concat(clip(F.col("qstart") - 1), F.col("length").cast("string"), F.lit("M"), clip(F.length("seq") - F.col("qend")))
    return rows.select(F.col("subject").alias("reference"), F.col("sstart").alias("pos"), cigar.alias("cigar"), "seq", "size", F.col("read").alias("id"))


def rebuilding(reads: DataFrame) -> Callable[[DataFrame, Setting], DataFrame]:
    """A cycle by reads (name, seq, size): merge, pad, map, rebuild."""

    def step(seqs: DataFrame, setting: Setting) -> DataFrame:
        one = zipper.merged(seqs, "strict" if setting.strict else "default")
        padded = stage(one.select(F.col("def").alias("reference"), S.pad_n("seq", setting.pad).alias("seq")))
        return pileup.rebuilt(mapped(reads, padded, setting.radius), padded, setting.pad).select(F.col("reference").alias("def"), "seq")

    return step


def improved(seqs: DataFrame, step: Callable[[DataFrame, Setting], DataFrame], cycles: int = 40, seconds: float | None = None) -> DataFrame:
    """def, seq after cycles of ``step(seqs, setting)``, from def and seq (names have an accession).

    A sequence is settled when it has not changed, after cycle SEEN also when it was the same before any cycle since or
    changed in under NEAR of its letters, after cycle LATE in under NEAR_LATE. What is settled is kept as it was when last
    settled; the others are as the last cycle left them. After ``seconds`` all count as settled."""
    began = time.monotonic()
    text = lambda c: F.coalesce(S.accession("def"), F.col("def")).alias(c)
    now = stage(seqs.select(F.col("def").cast("string").alias("def"), "seq"))
    seen, kept = None, None
    for setting in schedule(cycles):
        before = now.select(text("acc"), F.col("seq").alias("before"))
        if setting.cycle > SEEN:
            marks = before.select("acc", F.md5("before").alias("mark"))
            seen = stage(marks if seen is None else seen.union(marks).distinct())
        now = stage(step(now, setting).where("seq <> ''").select("def", "seq"))
        after = now.select(text("acc"), "def", F.col("seq").alias("after"))
        told = compared(before.join(after, "acc"))
        known = F.lit(False)
        if seen is not None:
            told = told.withColumn("mark", F.md5("after")).join(seen.withColumn("_seen", F.lit(True)), ["acc", "mark"], "left")
            known = F.coalesce("_seen", F.lit(False))
        share = F.col("distance")
        late = time.monotonic() - began > seconds if seconds is not None else False
        done = F.lit(late) | (share == 0) | (F.lit(setting.cycle > SEEN) & (known | (share < NEAR))) | (F.lit(setting.cycle > LATE) & (share < NEAR_LATE))
        judged = stage(told.select("acc", "def", F.col("after").alias("seq"), done.alias("done")))
        fresh = judged.where("done").select("acc", "def", "seq")
        kept = fresh if kept is None else stage(kept.join(fresh.select("acc"), "acc", "left_anti").unionByName(fresh))
        if before.join(judged.where("done").select("acc"), "acc", "left_anti").isEmpty():
            break
    if kept is None:
        return now
    rest = now.withColumn("acc", text("acc")).join(kept.select("acc"), "acc", "left_anti")
    return kept.select("def", "seq").unionByName(rest.select("def", "seq"))
