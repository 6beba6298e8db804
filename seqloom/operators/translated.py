"""Search of nucleotide reads in protein references: six frames, seeds in a reduced alphabet, extension by BLOSUM62.

Reads are translated in all six frames. Seeds are spaced words of proteins in which like acids are one letter, so that they
bear exchanges; read and reference meet in a join by seed, and diagonals are counted before letters meet. In Arrow batches
each seed is extended without gaps to both sides until its score falls by more than DROP below its best. The
result is exactly the distinct extensions of all shared seeds that reach ``least`` raw score; frequent seeds are dealt out as
in ``align``, none is left out.

Letters that are no codon are X; words with X or a stop are no seeds. Null and short reads have no alignments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators.align import among, coded, dealt, few, joined, reach
from seqloom.plans.stages import batches_bounded, stage

ACIDS = "ARNDCQEGHILKMFPSTWYVX*"
# BLOSUM62 below its diagonal, a row an acid in the order of ACIDS, up to the acid before it.
BELOW = """
-1
-2 0
-2 -2 1
0 -3 -3 -3
-1 1 0 0 -3
-1 0 0 2 -4 2
0 -2 0 -1 -3 -2 -2
-2 0 1 -1 -3 0 0 -2
-1 -3 -3 -3 -1 -3 -3 -4 -3
-1 -2 -3 -4 -1 -2 -3 -4 -3 2
-1 2 0 -1 -3 1 1 -2 -1 -3 -2
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1
"""
# Acids that are one letter in seeds; which places of a word count; by how much a score may fall.
LIKE = ["KREDQN", "C", "G", "H", "ILV", "M", "F", "Y", "W", "P", "STA"]
SHAPE = "1110110111"
DROP = 20
#: Most proteins that a read meets in one row.
PAIRS = 500
PROTEIN = "qname string, rname string, pos long, cigar string, zr int, zi double, zf int, zs int"


def blosum() -> np.ndarray:
    """The whole matrix in the order of ACIDS: an unknown acid scores -1, a stop -4 but for another stop."""
    out = np.full((22, 22), -1, np.int64)
    for i, row in enumerate(BELOW.split("\n")[1:-1], 1):
        for j, v in enumerate(row.split()):
            out[i, j] = out[j, i] = int(v)
    for i, acid in enumerate(ACIDS[:20]):
        out[i, i] = S.BLOSUM_SELF[acid]
    out[21, :] = out[:, 21] = -4
    out[21, 21] = S.BLOSUM_SELF["*"]
    return out


MATRIX = blosum()
ACID = np.full(256, ACIDS.index("X"), np.uint8)
ACID[np.frombuffer(ACIDS.encode(), np.uint8)] = range(22)
CODON = np.array([ACIDS.index(S.CODON_TABLE[a + b + c]) for a in "ACGT" for b in "ACGT" for c in "ACGT"], np.uint8)
REDUCED = np.full(22, len(LIKE), np.uint8)
for _i, _group in enumerate(LIKE):
    REDUCED[[ACIDS.index(a) for a in _group]] = _i


def frames(text: str | None) -> dict[int, np.ndarray]:
    """The acids of each of the frames 1 to 3 and -1 to -3."""
    x = coded(text)
    out = {}
    for sign, strand in ((1, x), (-1, np.where(x < 4, 3 - x, x)[::-1])):
        for f in range(3):
            c = strand[f : f + (len(strand) - f) // 3 * 3].reshape(-1, 3).astype(np.int64)
            known = (c < 4).all(axis=1)
            out[sign * (f + 1)] = np.where(known, CODON[np.where(known, c @ [16, 4, 1], 0)], ACIDS.index("X"))
    return out


def acids(text: str | None) -> np.ndarray:
    return ACID[np.frombuffer((text or "").upper().encode("latin-1", "replace"), np.uint8)]


def words(x: np.ndarray, shape: str = SHAPE) -> tuple[np.ndarray, np.ndarray]:
    """Places and words of the reduced acids, by the places of ``shape`` that count."""
    n = len(x) - len(shape) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    r, code, fine = REDUCED[x], np.zeros(n, np.int64), np.ones(n, bool)
    for i, counts in enumerate(shape):
        if counts == "1":
            piece = r[i : i + n]
            code = code * len(LIKE) + piece
            fine &= piece < len(LIKE)
    at = np.flatnonzero(fine)
    return at, code[at]


def seeds(seqs: DataFrame, of, shape: str) -> DataFrame:
    """name, frame, code, pos of all seeds; ``of`` gives a text's proteins by frame."""

    def run(batches):
        for b in batches:
            for i, text in enumerate(b.column("seq").to_pylist()):
                for frame, x in of(text).items():
                    at, code = words(x, shape)
                    if len(at):
                        name = b.column("name").take(pa.array(np.full(len(at), i)))
                        yield pa.RecordBatch.from_arrays([name, pa.array(np.full(len(at), frame, np.int32)), pa.array(code), pa.array(at)], ["name", "frame", "code", "pos"])

    return seqs.select(F.col("name").cast("string").alias("name"), "seq").mapInArrow(run, "name string, frame int, code long, pos long")


def read_seeds(reads: DataFrame, shape: str = SHAPE, some=None) -> DataFrame:
    """``seeds`` of reads in all six frames, of those among ``some``, a batch's texts at once: a word's acids begin at every third
    letter, so each letter begins one, and its place tells the frame."""
    span = 3 * len(shape)

    def run(batches):
        for b in batches:
            # behind each text so many unknown letters that no word goes on into the next one
            x, begins, ends = joined(b.column("seq").to_pylist(), span)
            for sign, strand, first in ((1, x, begins), (-1, np.where(x < 4, 3 - x, x)[::-1], (len(x) - ends)[::-1])):
                n = len(strand) - span + 1
                if n <= 0:
                    continue
                c = [strand[i : len(strand) - 2 + i].astype(np.int64) for i in range(3)]
                r = np.where((c[0] < 4) & (c[1] < 4) & (c[2] < 4), REDUCED[CODON[(c[0] << 4 | c[1] << 2 | c[2]) & 63]], len(LIKE))
                code, fine = np.zeros(n, np.int64), np.ones(n, bool)
                for i in (i for i, counts in enumerate(shape) if counts == "1"):
                    piece = r[3 * i : 3 * i + n]
                    code = code * len(LIKE) + piece
                    fine &= piece < len(LIKE)
                at = np.flatnonzero(fine)
                at = at[among(code[at], some)]
                row = np.searchsorted(first, at, side="right") - 1
                place = at - first[row]
                name = b.column("name").take(pa.array(row if sign > 0 else len(first) - 1 - row))
                yield pa.RecordBatch.from_arrays([name, pa.array((sign * (place % 3 + 1)).astype(np.int32)), pa.array(code[at]), pa.array(place // 3)], ["name", "frame", "code", "pos"])

    return reads.select(F.col("name").cast("string").alias("name"), "seq").mapInArrow(run, "name string, frame int, code long, pos long")


def protein_frames(text: str | None) -> dict[int, np.ndarray]:
    return {0: acids(text)}


def spread(x: np.ndarray, y: np.ndarray, diag: int, at: int, width: int, drop: int = DROP) -> tuple[int, int, int]:
    """Begin and end (in x) of the extension of the seed at ``at`` along a diagonal, and its raw score. The seed is whole within."""
    first, last = max(0, diag), min(len(x), len(y) + diag)
    score = lambda i, j: MATRIX[x[i:j], y[i - diag : j - diag]]
    back = reach(lambda i, j: score(at - j, at - i)[::-1], at - first, drop)
    on = reach(lambda i, j: score(at + width + i, at + width + j), last - at - width, drop)
    s, e = at - back, at + width + on
    return s, e, int(score(s, e).sum())


def aligned(reads: DataFrame, proteins: DataFrame, least: int = 30, shape: str = SHAPE, drop: int = DROP) -> DataFrame:
    """Alignments of reads (name, seq) with proteins (name, seq): qname, rname, pos (acid of the reference, from 1), cigar, zr (raw
    score), zi (percent equal), zf (frame), zs (where in the read the first codon begins, from 1 on its forward strand)."""
    batches_bounded(reads.sparkSession)
    theirs = stage(seeds(proteins, protein_frames, shape))
    q, s = dealt(stage(read_seeds(reads, shape, few(theirs))), theirs)
    met = q.select("code", "i", "j", F.col("name").alias("qname"), F.col("frame").alias("zf"), F.col("pos").alias("qpos")).join(s.select("code", "i", "j", F.col("name").alias("rname"), F.col("pos").alias("spos")), ["code", "i", "j"])
    per = met.groupBy("qname", "rname", "zf", (F.col("qpos") - F.col("spos")).alias("diag")).agg(F.sort_array(F.collect_set("qpos")).alias("at"))
    pairs = per.groupBy("qname", "rname").agg(F.collect_list(F.struct("zf", "diag", "at")).alias("spots"))
    # a read's letters move once for PAIRS of its proteins, and are put into frames once
    met = pairs.join(proteins.select(F.col("name").cast("string").alias("rname"), F.col("seq").alias("y")), "rname")
    block = F.floor((F.row_number().over(Window.partitionBy("qname").orderBy("rname")) - 1) / PAIRS)
    lists = met.withColumn("_block", block).groupBy("qname", "_block").agg(F.collect_list(F.struct("rname", "y", "spots")).alias("pairs"))
    rows = lists.join(reads.select(F.col("name").cast("string").alias("qname"), F.col("seq").alias("x")), "qname")
    width = len(shape)

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                x, n = frames(r["x"]), len(r["x"])
                for pair in r["pairs"]:
                    y = acids(pair["y"])
                    for spot in pair["spots"]:
                        f, d = spot["zf"], spot["diag"]
                        for s, e, score in sorted({spread(x[f], y, d, at, width, drop) for at in spot["at"]}):
                            if score >= least:
                                same = np.count_nonzero(x[f][s:e] == y[s - d : e - d])
                                offset = abs(f) - 1 + 3 * s
                                out.append((r["qname"], pair["rname"], s - d + 1, f"{e - s}M", score, 100.0 * same / (e - s), f, offset + 1 if f > 0 else n - offset))
            if out:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in PROTEIN.split(", ")])

    return rows.select("qname", "x", "pairs").mapInArrow(run, PROTEIN)


def top(found: DataFrame, percent: float = 8.0, identity: float = 0.0) -> DataFrame:
    """Alignments of ``identity`` percent at least whose bits are within ``percent`` of the read's best."""
    bits = S.raw_to_bits(F.col("zr").cast("double"), True)
    fine = found.where(F.col("zi") >= identity).withColumn("_best", F.max(bits).over(Window.partitionBy("qname")))
    return fine.where(bits >= (1 - percent / 100) * F.col("_best")).drop("_best")
