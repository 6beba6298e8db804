"""Genomes put together from their own scaffold and the scaffolds of their proteins.

Children lie where their record's location says: ranges in the order of the genome, walked from the first letter up, or, on
the other strand, from the last range's end down, with complemented letters. A genome's pieces meet in its row, and numpy
settles the positions of a batch of genomes at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators.hits import tasks
from seqloom.plans.stages import batches_bounded

#: The genome's own letters come before all children's.
OWN = -(1 << 62)


def walked(location, codon_start, reverse):
    """Positions of a child's letters, in their order. The frame's start moves all ranges: up, or down on the other strand.
    Parts that are no range are passed over."""
    ends = [F.regexp_extract_all(location, F.lit(r"(\d+)\.\.>?(\d+)"), F.lit(i)) for i in (1, 2)]
    shift = (codon_start - 1).cast("long")
    ranges = F.arrays_zip(ends[0].alias("a"), ends[1].alias("b"))
    up = F.transform(ranges, lambda r: F.sequence(r["a"].cast("long") + shift, r["b"].cast("long") + shift))
    down = F.transform(F.reverse(ranges), lambda r: F.sequence(r["b"].cast("long") - shift, r["a"].cast("long") - shift, F.lit(-1).cast("long")))
    return F.flatten(F.when(reverse, down).otherwise(up))


def placed(children: DataFrame) -> DataFrame:
    """parent, priority, where (positions), letters and first (the least coordinate that the location names) of children (parent,
    priority, location, codon_start, seq). Letters beyond the ranges have no place."""
    reverse = F.col("location").contains("complement")
    letters = F.when(reverse, F.translate("seq", "ACGT", "TGCA")).otherwise(F.col("seq"))
    numbers = F.transform(F.regexp_extract_all("location", F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("long"))
    where = walked(F.col("location"), F.col("codon_start"), reverse)
    return children.where("parent IS NOT NULL").select("parent", F.col("priority").cast("long").alias("priority"), where.alias("where"), letters.alias("letters"), F.array_min(numbers).alias("first"))


def settled(parts: pa.ListArray, first: np.ndarray) -> list[str | None]:
    """The letters of each genome from its first place to its last, by ``superscaffolds``' rule. ``parts`` has a list of (priority,
    where, letters) for each genome; places before ``first`` do not count."""
    flat = parts.flatten()
    where, n = flat.field("where"), len(parts)
    counts = where.value_lengths().to_numpy(zero_copy_only=False)
    of = np.repeat(np.repeat(np.arange(n), parts.value_lengths().to_numpy(zero_copy_only=False)), counts)
    pos, priority = where.flatten().to_numpy(zero_copy_only=False), np.repeat(flat.field("priority").to_numpy(zero_copy_only=False), counts)
    letter = np.frombuffer("".join(flat.field("letters").to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    kept = np.flatnonzero(pos >= first[of])
    kept = kept[np.lexsort((priority[kept], pos[kept], of[kept]))]
    of, pos, letter = of[kept], pos[kept], letter[kept]
    if not len(of):
        return [None] * n
    begins = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (pos[1:] != pos[:-1])]))
    known = (letter != ord("N")) & (letter != ord("n"))
    places = np.where(known, np.arange(len(letter)), len(letter))
    one = np.minimum.reduceat(places, begins)
    some, differ = one < len(letter), np.minimum.reduceat(np.where(known, letter, 1 << 32), begins) != np.maximum.reduceat(np.where(known, letter, 0), begins)
    last = letter[np.concatenate([begins[1:], [len(letter)]]) - 1]
    told = np.where(some, letter[np.minimum(one, len(letter) - 1)], last)
    told = np.where(some & differ & (told >= 65) & (told <= 90), told + 32, told)
    of, pos, out = of[begins], pos[begins], [None] * n
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        row = np.full(pos[b - 1] - pos[a] + 1, ord("N"), np.uint32)
        row[pos[a:b] - pos[a]] = told[a:b]
        out[of[a]] = row.tobytes().decode("utf-32-le")
    return out


def superscaffolds(parents: DataFrame, children: DataFrame) -> DataFrame:
    """def, seq of genomes: ``parents`` (def, start, seq) are their own scaffolds, ``children`` (parent, priority, location, codon_start,
    seq) lie on them or, where a genome has none, on nothing.

    At each position the genome's own letter counts if it is known, else the known letter of the first child by priority;
    where a later one differs, it is lower case. Unknown everywhere, it is as the last one says; places of none are N. Unknown
    letters at the ends are cut off; genomes without known letters are left out."""
    batches_bounded(parents.sparkSession)
    size, start = F.length("seq"), F.col("start").cast("long")
    steps = F.when(size > 0, F.sequence(start, start + size - 1))
    own = parents.select(F.col("def").alias("parent"), F.lit(OWN).alias("priority"), steps.alias("where"), F.col("seq").alias("letters"), start.alias("first"))
    # a genome begins with its own scaffold, or where the first coordinate of a child lies before that
    where, letters = F.coalesce("where", F.array().cast("array<bigint>")), F.coalesce("letters", F.lit(""))
    n = F.least(F.size(where), F.length(letters))
    part = F.struct("priority", F.slice(where, F.lit(1), n).alias("where"), F.substr(letters, F.lit(1), n).alias("letters"))
    dealt = own.unionByName(placed(children)).repartition(tasks(children), "parent")
    lists = dealt.groupBy("parent").agg(F.min("first").alias("first"), F.collect_list(part).alias("parts")).where("first IS NOT NULL")

    def run(batches):
        for b in batches:
            texts = settled(b.column("parts"), b.column("first").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("parent"), pa.array(texts, pa.string())], ["def", "seq"])

    rows = lists.mapInArrow(run, f"def {lists.schema['parent'].dataType.simpleString()}, seq string")
    return rows.select("def", S.trim_n("seq").alias("seq")).where("seq <> ''")
