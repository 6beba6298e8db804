"""Merging of overlapping sequences: two of them closed like a zipper, in job order, round by round until nothing merges.

A round aligns the changed sequences with all, on both strands. Contigs that lie within another sequence are absorbed. Every
pair that is left is a job; jobs have an order, and a sequence merges in the first of its jobs that succeeds.
That sequential walk is done in parallel: a job that is the first of both its sequences depends on no other, so all
such jobs are tried at once; what succeeds takes its sequences' other jobs away, and so on (``matched``). The result is
that of the walk. Later rounds search with what the last one changed.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import align, hsps
from seqloom.operators.merge import LEAST_OVERLAP, MODES, Mode
from seqloom.plans.stages import numbered, stage

REV = ";rev=1"
#: Error share that two contigs are allowed at most, whatever the mode.
CONTIGS = 0.01
LETTER = {c: np.uint8(ord(c)) for c in "Nn"}


def is_contig(name: str) -> bool:
    return name.startswith("contig")


def negotiated(left: str, right: str, a: list[int], b: list[int]) -> tuple[str, str, int] | None:
    """Both sequences with the letters N that bring the parts of their alignment, which begin at ``a`` in left and at ``b`` in
    right (from 1, in order), to the same places; and how far into left right begins.

    Where a later part comes early on one side, that side gets letters N before it, unless the other side, counting
    unknown letters in as many letters before its part, has some and no fewer: then letters go there. None where places lie
    beyond an end, or more letters moved than the shorter sequence has."""
    pad = a[0] - b[0]
    sides, moved, total = [left, "N" * pad + right], [0, pad], 0
    for part in zip(a[1:], b[1:], strict=True):
        at = [p + m for p, m in zip(part, moved, strict=True)]
        n = abs(at[1] - at[0])
        if not n:
            continue
        total += n
        early, late = (0, 1) if at[0] < at[1] else (1, 0)
        # where there are fewer letters than that, all count as unknown
        unknown = [math.inf if p < n else s[p - n : p].upper().count("N") for s, p in zip(sides, at, strict=True)]
        if unknown[late] and unknown[late] >= unknown[early]:
            if at[late] + n > len(sides[late]):
                return None
            sides[late] = sides[late][: at[late]] + sides[late][at[late] + n :]
            moved[late] -= n
        else:
            if at[early] > len(sides[early]):
                return None
            sides[early] = sides[early][: at[early]] + "N" * n + sides[early][at[early] :]
            moved[early] += n
    return None if total > min(len(left), len(right)) else (*sides, pad)


def closed(left: str, right: str, pad: int, contig: tuple[bool, bool], most_open: int, mode: Mode, least: int = LEAST_OVERLAP) -> str | None:
    """One sequence of two that lie on each other from letter ``pad`` on, or None where they differ too much.

    Unknown letters of one side are filled from the other. Differing letters become n. What a contig alone has is in lower
    case beside a reference. Overlaps agree or differ where both sides are known; with few open places, the errors are held
    against the overlap, else against it and half of the open places."""
    stop = min(len(left), len(right))
    if stop <= pad:
        return None
    x, y = (np.frombuffer(s[pad:stop].encode(), np.uint8) for s in (left, right))
    up, low = np.uint8(0xDF), np.uint8(0x20)
    no_x, no_y = (x & up) == LETTER["N"], (y & up) == LETTER["N"]
    known = ~no_x & ~no_y
    same = known & ((x & up) == (y & up))
    differ = known & ~same
    good, bad, fit = int(same.sum()), int(differ.sum()), int((no_x ^ no_y).sum())
    if differ[:-1].sum() / len(x) > mode.overlap or (~known[:-1]).sum() > most_open or good + bad < max(least, 1):
        return None
    share = min(mode.exact, CONTIGS) if all(contig) else mode.exact
    wide = min(mode.zipper, CONTIGS) if all(contig) else mode.zipper
    weight = good + bad + 0.5 * fit
    if bad / (good + bad) > share and (good + bad > 0.9 * weight or bad / weight > wide or (bad / weight < wide and bad / (good + bad) > mode.overlap)):
        return None
    upper = lambda v: (v & low) == 0
    alone = (contig[0] and not contig[1], contig[1] and not contig[0])
    agreed = np.where(upper(x) | upper(y), y & up, y) if not any(contig) else np.where(~upper(x), y | low, y) if contig[1] else y
    out = np.where((x == LETTER["N"]) & (y == LETTER["N"]), LETTER["N"], LETTER["n"])
    out = np.where(no_x & ~no_y, y | low if alone[1] else y, out)
    out = np.where(no_y & ~no_x, x | low if alone[0] else x, out)
    out = np.where(same, agreed, out)
    rest = right[stop:].lower() if alone[1] else right[stop:]
    if len(left) >= len(right):
        rest = left[stop:].lower() if alone[0] else left[stop:]
    head = left[:pad].lower() if alone[0] else left[:pad]
    return head + out.astype(np.uint8).tobytes().decode() + rest


def known(seq: str) -> int:
    return len(seq) - seq.count("N") - seq.count("n")


def named(left: str, right: str, sizes: tuple[int, int], n: int) -> str:
    """What two merged sequences are called, n letters together. Two contigs keep the left one's number, and coverage by
    letters; a contig takes the reference's name; of two references on one strand the larger one's name counts (of
    equal ones the left one's), of two on different strands the forward one's."""
    if is_contig(left) and is_contig(right):
        parts = [re.search(r"(contig_\d+);src=([a-z]+);length=(\d+);cov=(\d+\.?\d?)", s) for s in (left, right)]
        if all(parts):
            (number, one, m, c), (_, two, k, d) = (p.groups() for p in parts)
            cover = int((int(m) * float(c) + int(k) * float(d)) / n)
            return f"{number};src={one if one == two else 'mixed'};length={n};cov={cover};merged=1;taxId=10239"
    contig = [is_contig(s) for s in (left, right)]
    if contig[0] != contig[1]:
        chosen = right if contig[0] else left
    elif left.endswith(REV) == right.endswith(REV):
        chosen = right if sizes[0] < sizes[1] else left
    else:
        chosen = right if left.endswith(REV) else left
    return re.sub(r"length=\d+", f"length={n}", chosen, count=1)


TURN = str.maketrans("ACGTacgt", "TGCAtgca")


def zipped(one: tuple[str, str], two: tuple[str, str], a: list[int], b: list[int], mode: Mode, least: int = LEAST_OVERLAP) -> tuple[str, str] | None:
    """Name and letters of two sequences (name, letters) merged, or None. ``a`` and ``b`` are where the parts of their alignment
    begin. The left one is that whose first part begins later. A result that is called after a reverse strand is turned."""
    if len(a) != len(b):
        return None
    if a[0] < b[0]:
        one, two, a, b = two, one, b, a
    laid = negotiated(one[1], two[1], a, b)
    if not laid:
        return None
    text = closed(*laid, (is_contig(one[0]), is_contig(two[0])), min(len(one[1]), len(two[1])), mode, least)
    if text is None:
        return None
    name = named(one[0], two[0], (known(one[1]), known(two[1])), len(text))
    return (name.removesuffix(REV), text.translate(TURN)[::-1]) if name.endswith(REV) else (name, text)


# jobs


def jobs(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """job, query, subject and the other columns of ``pairs`` (query, subject, bits, …; both ways): each pair once, from its
    larger sequence (name, size; of equal ones the smaller name), in the order in which pairs are tried: each sequence's
    best partner (by bits, size, name), then each one's second, and so on; within a turn those from forward strands
    first, then from larger ones. Places come from sorted partitions, so no task sees all pairs or all of a sequence."""
    of = lambda c: sizes.select(F.col("name").alias(c), F.col("size").alias(f"{c}_size"))
    rows = pairs.join(of("query"), "query").join(of("subject"), "subject")
    larger = F.struct(-F.col("query_size"), F.col("query").alias("name")) < F.struct(-F.col("subject_size"), F.col("subject").alias("name"))
    by_query = numbered(rows.where(larger), "place", "query", F.desc("bits"), F.desc("subject_size"), "subject")
    first = by_query.groupBy("query").agg(F.min("place").alias("first"))
    turns = by_query.join(first, "query").withColumns({"turn": F.col("place") - F.col("first") + 1, "back": F.col("query").endswith(REV).cast("int")})
    told = numbered(turns, "job", "turn", "back", F.desc("query_size"), "query")
    return told.select("job", *pairs.columns)


def matched(open_: DataFrame, tried: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The jobs that the walk in order of ``job`` takes: each whose ends (x, y) no earlier taken job has, and that succeeds.
    ``tried`` gives the rows of those that do, with job, x and y; without it all do.

    Jobs that are the first of both their ends are tried together; a turn is an aggregation and joins by ends."""
    taken, left = [], stage(open_)
    while not left.isEmpty():
        first = left.select("job", F.explode(F.array("x", "y")).alias("end")).groupBy("end").agg(F.min("job").alias("job"))
        now = stage(left.join(first.groupBy("job").agg(F.count("*").alias("n")).where("n = 2"), "job", "left_semi"))
        fine = now if tried is None else stage(tried(now))
        taken.append(fine)
        gone = fine.select(F.explode(F.array("x", "y")).alias("end"))
        rest = left.join(now.select("job"), "job", "left_anti")
        left = stage(rest.join(gone.select(F.col("end").alias("x")), "x", "left_anti").join(gone.select(F.col("end").alias("y")), "y", "left_anti").select(left.columns))
    return functools.reduce(DataFrame.unionByName, taken) if taken else left if tried is None else tried(left)


def bare(c: str):
    return F.regexp_replace(c, f"{REV}$", "")


def merged_once(seqs: DataFrame, mode: Mode, least: int = LEAST_OVERLAP) -> DataFrame:
    """def, seq, changed after a round over (def, seq, changed): what merged is changed, all else is not."""
    forward = seqs.select(F.col("def").alias("name"), "seq", "changed")
    back = seqs.select(F.concat("def", F.lit(REV)).alias("name"), S.reverse_complement_cased("seq").alias("seq"), "changed")
    both = stage(forward.unionByName(back))
    found = align.aligned(both.where("changed"), both, mode.seed)
    found = stage(hsps.forward(hsps.mirrored(found, both.where("NOT changed").select("name"))))
    inside = stage(hsps.absorbed(found).select("name"))
    for side in ("query", "subject"):
        found = found.join(inside.select(F.col("name").alias("_of")), bare(side) == F.col("_of"), "left_anti")
    starts = lambda c: F.sort_array(F.collect_list(c))
    pairs = found.groupBy("query", "subject").agg(F.sum("bits").alias("bits"), starts("qstart").alias("a"), starts("sstart").alias("b"))
    order = jobs(pairs, both.select("name", S.known_length("seq").alias("size"))).withColumns({"x": bare("query"), "y": bare("subject")})
    letters = lambda c: both.select(F.col("name").alias(c), F.col("seq").alias(f"{c}_seq"))

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                made = zipped((r["query"], r["query_seq"]), (r["subject"], r["subject_seq"]), r["a"], r["b"], mode, least)
                if made:
                    out.append((r["job"], r["x"], r["y"], *made))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["job", "x", "y", "def", "seq"])

    def tried(now: DataFrame) -> DataFrame:
        return now.join(letters("query"), "query").join(letters("subject"), "subject").mapInArrow(run, "job long, x string, y string, def string, seq string")

    made = matched(order, tried)
    gone = made.select(F.explode(F.array("x", "y")).alias("def")).union(inside.select("name"))
    kept = seqs.join(gone, "def", "left_anti").select("def", "seq", F.lit(False).alias("changed"))
    return kept.unionByName(made.select("def", "seq", F.lit(True).alias("changed")))


def merged(seqs: DataFrame, kind: str = "default", least: int = LEAST_OVERLAP) -> DataFrame:
    """def, seq after merging until nothing merges. The inner loop searches with what its last round changed, until the number of
    sequences stays; then all are searched with again, until that changes nothing either. ``kind``: default, strict, or
    init, which is strict from the second outer turn on. More sequences than before are an error."""
    now = stage(seqs.select(F.col("def").cast("string").alias("def"), "seq", F.lit(True).alias("changed")))
    n, outer = now.count(), 0
    while True:
        mode, before = MODES["strict" if kind == "init" and outer else kind], n
        while True:
            now = stage(merged_once(now, mode, least))
            m = now.count()
            if m > n:
                raise ValueError(f"a round made {m} sequences of {n}")
            n, done = m, m == n
            if done:
                break
        if n == before:
            return now.select("def", "seq")
        now = now.withColumn("changed", F.lit(True))
        outer += 1
