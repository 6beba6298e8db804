"""Reads on references: best hits, unique reads, priorities, votes, consensus and abundance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.stages import numbered


def best_hits(alignments: DataFrame) -> DataFrame:
    """Each read's alignments of fewest mismatches, ties kept."""
    low = F.min("mismatch").over(Window.partitionBy("read"))
    return alignments.withColumn("low", low).where("mismatch = low").drop("low")


def best_per_reference(alignments: DataFrame) -> DataFrame:
    """For each read and reference, the alignment of fewest mismatches, then of the first position and largest size."""
    order = Window.partitionBy("read", "reference").orderBy("mismatch", "pos", F.col("size").desc())
    return alignments.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def solo_reads(alignments: DataFrame) -> DataFrame:
    """reference, solo: how many reads have their best hit on this reference alone; references without any are dropped."""
    best = best_hits(alignments).select("read", "reference").distinct()
    alone = best.groupBy("read").agg(F.count("*").alias("n"), F.min("reference").alias("reference")).where("n = 1")
    return alone.groupBy("reference").agg(F.count("*").alias("solo"))


def centroid_order(alignments: DataFrame) -> DataFrame:
    """reference, reads, hits, priority: most distinct reads first, then most hits, then by name."""
    per = alignments.groupBy("reference").agg(F.countDistinct("read").alias("reads"), F.count("*").alias("hits"))
    return numbered(per, "priority", F.desc("reads"), F.desc("hits"), "reference").withColumn("priority", F.col("priority").cast("int"))


def reciprocal(pairs: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Rows whose mirror image is in the table too; ``keys`` are the columns that change places."""
    mirror = pairs.select(*[F.col(a).alias(b) for a, b in keys], *[F.col(b).alias(a) for a, b in keys]).distinct()
    return pairs.join(mirror, [c for k in keys for c in k], "left_semi")


def votes(placed: DataFrame) -> DataFrame:
    """reference, pos, base, votes from rows (reference, pos, base, size)."""
    return placed.groupBy("reference", "pos", "base").agg(F.sum("size").alias("votes"))


def consensus(voted: DataFrame) -> DataFrame:
    """reference, start, seq: the base of most votes at each position from the first to the last; n where bases tie, N
    where a deletion (D) wins or no read is."""
    best = voted.groupBy("reference", "pos").agg(F.max("votes").alias("top"), F.max_by("base", F.struct("votes", "base")).alias("base"))
    tied = voted.join(best.select("reference", "pos", "top"), ["reference", "pos"]).where("votes = top").groupBy("reference", "pos").agg(F.count("*").alias("ties"))
    letter = F.when(F.col("ties") > 1, "n").when(F.col("base") == "D", "N").otherwise(F.col("base"))
    called = best.join(tied, ["reference", "pos"]).select("reference", "pos", letter.alias("letter"))
    gap = F.col("pos") - F.coalesce(F.lag("pos").over(Window.partitionBy("reference").orderBy("pos")) + 1, F.col("pos"))
    part = F.concat(F.repeat(F.lit("N"), gap.cast("int")), F.col("letter"))
    pieces = called.withColumn("part", part).groupBy("reference").agg(F.min("pos").alias("start"), F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    return pieces.select("reference", "start", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("seq"))


def abundance(placed: DataFrame, key: list[str], reference: str, weight: str) -> DataFrame:
    """reference, weight, rows: sums over rows that are distinct in ``key``."""
    return placed.select(*key).distinct().groupBy(reference).agg(F.sum(weight).alias("weight"), F.count("*").alias("rows"))


def with_parents(hits: DataFrame, parents: DataFrame) -> DataFrame:
    """Hits (accession, ...) with the full name of their parent (accession, name), one made up where there is none."""
    made = F.concat(F.lit("gi|NoNucHits|gb|"), F.col("accession").cast("string"))
    return hits.join(parents, "accession", "left").withColumn("name", F.coalesce("name", made))
