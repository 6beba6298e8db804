"""Reads on protein references: the reference that a read goes to, codon votes and pseudo-scaffolds of codons.

Alignments have read, reference, mismatch, score, pos (the first codon, from 1), cigar, frame, dna (where in the read the first
codon begins, from 1), size and place (their order in the file); reads have read and seq."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators.pileup import placed

#: A read whose deletions are more than this share of its codons does not vote for them.
MOST_DELETED = 0.3


def first_best(alignments: DataFrame) -> DataFrame:
    """Of each read, the alignment of fewest mismatches that comes first in the file: a later one of as many mismatches
    does not take its place."""
    first = Window.partitionBy("read").orderBy("mismatch", "place")
    return alignments.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def on_accepted(alignments: DataFrame, references: DataFrame, reads: DataFrame) -> DataFrame:
    """Alignments on accepted references, with the letters of their reads. Only reads that have one are fetched."""
    some = alignments.join(references.select("reference").distinct(), "reference", "left_semi")
    fetched = reads.join(some.select("read").distinct(), "read", "left_semi")
    return some.join(fetched, "read")


def weighted_reads(alignments: DataFrame) -> DataFrame:
    """reference, reads: the sum of sizes of distinct reads."""
    return alignments.select("reference", "read", "size").distinct().groupBy("reference").agg(F.sum("size").alias("reads"))


def codon_votes(alignments: DataFrame) -> DataFrame:
    """reference, pos (codons, from 0), codon, votes; a deleted codon is DDD. ``alignments`` have seq. Inserted codons do not
    vote, nor do deletions of reads that lose over MOST_DELETED of their codons; reads are cut at whole codons. Reads are brought
    together by reference first, so that a task sums up their votes; Spark splits the reads of a frequent reference."""
    alignments = alignments.hint("rebalance", F.col("reference"))
    strand = F.when(F.col("frame") < 0, S.reverse_complement("seq")).otherwise(F.col("seq"))
    begin = F.when(F.col("frame") < 0, F.length("seq") - F.col("dna") + 1).otherwise(F.col("dna"))
    rows = alignments.withColumn("read_codons", S.codons(F.substr(strand, begin.cast("int")))).withColumn("steps", placed("cigar", clip=False))
    lost = F.aggregate("steps", F.lit(0), lambda a, s: a + F.when(s["op"] == "D", s["n"]).otherwise(0))
    rows = rows.withColumn("counts", (lost <= MOST_DELETED * F.size("read_codons")) & (F.size("read_codons") > 0)).where(F.size("read_codons") > 0)
    flat = rows.select("reference", "size", "counts", "read_codons", (F.col("pos") - 1).alias("begin"), F.inline("steps")).withColumn("at", F.col("at") + F.col("begin"))
    flat = flat.where("op IN ('M', 'S') OR (op = 'D' AND counts)")
    each = flat.select("reference", "size", "at", "off", "read_codons", "op", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    codon = F.when(F.col("op") == "D", "DDD").otherwise(F.get("read_codons", F.col("off") + F.col("i")))
    named = each.select("reference", (F.col("at") + F.col("i")).cast("long").alias("pos"), codon.alias("codon"), "size")
    return named.where("codon IS NOT NULL AND pos >= 0").groupBy("reference", "pos", "codon").agg(F.sum("size").alias("votes"))


def codon_consensus(voted: DataFrame) -> DataFrame:
    """reference, codons, seq: from the first codon of the reference to the last with votes, the codon of most votes; nnn where
    several have as many, NNN where a deletion wins or nothing votes."""
    best = voted.groupBy("reference", "pos").agg(F.max("votes").alias("top"))
    tops = voted.join(best, ["reference", "pos"]).where("votes = top").groupBy("reference", "pos").agg(F.max("codon").alias("codon"), F.count("*").alias("ties"))
    told = F.when(F.col("ties") > 1, "nnn").when(F.col("codon") == "DDD", "NNN").otherwise(F.col("codon"))
    gap = F.col("pos") - F.coalesce(F.lag("pos").over(Window.partitionBy("reference").orderBy("pos")) + 1, F.lit(0))
    part = F.concat(F.repeat(F.lit("NNN"), gap.cast("int")), told)
    lists = tops.withColumn("part", part).groupBy("reference").agg((F.max("pos") + 1).alias("codons"), F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    return lists.select("reference", "codons", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("seq"))


def with_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Children (accession, ...) with the full name of their parent (accession, name). A child without a parent is an error
    when the row is read."""
    joined = children.join(parents.select("accession", "name"), "accession", "left")
    missing = F.raise_error(F.concat(F.col("accession").cast("string"), F.lit(" has no parent")))
    return joined.withColumn("name", F.when(F.col("name").isNull(), missing.cast("string")).otherwise(F.col("name")))


def child_starts(children: DataFrame) -> DataFrame:
    """parent, first: the least coordinate of all locations (``location`` of children (parent, location))."""
    ranges = S.location_ranges("location")
    return children.select("parent", F.array_min(F.transform(ranges, lambda r: r["start"])).alias("first")).groupBy("parent").agg(F.min("first").alias("first"))
