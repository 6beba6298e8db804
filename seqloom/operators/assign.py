"""Taxa of sequences by their minimisers: a table of words with the common ancestor of all references that have them, and the
path of the tree that most of a sequence's words lie on.

A word counts as one with its other strand. The common ancestor is an aggregate over the closure: an ancestor of all
taxa of a word counts as many as there are, and the deepest such one is taken; partial counts leave each task. A sequence goes
to the taxon whose path from the root has most of its words; of several, to their common ancestor. No sequence
is held against a reference, and the tree is never walked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.align import LONGEST, among, coded, few, joined, least_of, packed
from seqloom.operators.sequences import scrambled
from seqloom.plans.stages import batches_bounded, stage


def canonical(x: np.ndarray, k: int, word: int, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Places and words of k letters, the lesser of both strands, that are the least by hash in some ``word`` letters without unknown
    ones. With ``word`` = k these are all words."""
    w = word - k + 1
    places, words = [], []
    for begin in range(0, max(len(x) - word + 1, 0), part):
        piece = x[begin : begin + part + word - 1]
        code = np.minimum(packed(piece, k), packed(3 - (piece & 3)[::-1], k)[::-1])
        unknown = np.concatenate([[0], np.cumsum(piece > 3)])
        fine = unknown[word:] == unknown[:-word]
        at = np.flatnonzero(fine) if w == 1 else np.unique(least_of(scrambled(code), w)[fine])
        places.append(at + begin)
        words.append(code[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, words = np.concatenate(places), np.concatenate(words)
    if w == 1:
        return places, words
    places, first = np.unique(places, return_index=True)  # parts overlap
    return places, words[first]


def words(seqs: DataFrame, key: str, k: int, word: int, some=None) -> DataFrame:
    """``key``, code, n: a row for each kept word of (``key``, seq) that is among ``some``, with n 0, and one without a code for each
    row, whose n is the number of all its kept words. A batch's texts are read at once."""
    batches_bounded(seqs.sparkSession)
    kind = dict(seqs.dtypes)[key]

    def run(batches):
        for b in batches:
            x, begins, _ = joined(b.column("seq").to_pylist())
            at, code = canonical(x, k, word)
            row = np.searchsorted(begins, at, side="right") - 1
            held = among(code, some)
            codes = pa.concat_arrays([pa.array(code[held].view(np.int64)), pa.nulls(len(begins), pa.int64())])
            n = np.concatenate([np.zeros(np.count_nonzero(held), np.int64), np.bincount(row, minlength=len(begins))])
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(np.concatenate([row[held], np.arange(len(begins))]))), codes, pa.array(n)], [key, "code", "n"])

    return seqs.select(key, "seq").mapInArrow(run, f"`{key}` {kind}, code long, n long")


def common_ancestors(taxa: DataFrame, closed: DataFrame, key: list[str]) -> DataFrame:
    """``key``, taxid: the deepest taxon that all taxa of a key (key, taxid) are, or lie below. Keys whose taxa have nothing in common
    get 1, the root."""
    distinct = taxa.select(*key, "taxid").distinct()
    n = distinct.groupBy(*key).agg(F.count("*").alias("n"))
    depth = closed.groupBy("taxid").agg(F.max("hops").alias("depth")).withColumnRenamed("taxid", "ancestor")
    up = distinct.join(closed.select("taxid", "ancestor"), "taxid").groupBy(*key, "ancestor").agg(F.count("*").alias("m"))
    shared = up.join(n, key).where("m = n").join(depth, "ancestor")
    best = shared.groupBy(*key).agg(F.max_by("ancestor", F.struct("depth", "ancestor")).alias("taxid"))
    return n.join(best, key, "left").select(*key, F.coalesce("taxid", F.lit(1)).cast("long").alias("taxid"))


def table_of(references: DataFrame, closed: DataFrame, k: int = LONGEST, word: int = 35) -> DataFrame:
    """code, taxid: the words of references (taxid, seq) with their common ancestor."""
    return common_ancestors(words(references, "taxid", k, word).where("code IS NOT NULL").select("taxid", "code").distinct(), closed, ["code"])


def classified(seqs: DataFrame, table: DataFrame, closed: DataFrame, k: int = LONGEST, word: int = 35, least: int = 1) -> DataFrame:
    """name, taxid, hits, words for every sequence (name, seq): the taxon whose path has most of its words, the hits on that path (at
    least ``least``), and all its words. Without enough hits the taxon is 0. Words of taxa outside the tree count for none."""
    table = stage(table)
    found = stage(words(seqs, "name", k, word, few(table)))
    counts = stage(found.join(table, "code").groupBy("name", "taxid").agg(F.count("*").alias("n")))
    root = F.when(F.col("taxid") == 1, F.col("n")).otherwise(0)
    on_root = counts.groupBy("name").agg(F.sum(root).alias("root"))
    above = counts.select("name", F.col("taxid").alias("ancestor"), "n")
    paths = counts.select("name", "taxid").join(closed.select("taxid", "ancestor"), "taxid").join(above, ["name", "ancestor"])
    scores = paths.groupBy("name", "taxid").agg(F.sum("n").alias("hits"))
    # words of the root alone are a path of their own
    alone = on_root.where("root > 0").join(scores.select("name").distinct(), "name", "left_anti").select("name", F.lit(1).cast("long").alias("taxid"), F.lit(0).cast("long").alias("hits"))
    scored = scores.unionByName(alone).join(on_root, "name").withColumn("hits", F.col("hits") + F.col("root"))
    top = scored.withColumn("top", F.max("hits").over(Window.partitionBy("name"))).where(F.col("hits") == F.col("top"))
    best = common_ancestors(top, closed, ["name"]).join(top.groupBy("name").agg(F.max("hits").alias("hits")), "name").where(F.col("hits") >= least)
    total = found.where("code IS NULL").groupBy("name").agg(F.sum("n").alias("words"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return seqs.select("name").distinct().join(total, "name", "left").join(best, "name", "left").select("name", zero("taxid"), zero("hits"), zero("words"))
