"""Pileup of aligned reads: votes by CIGAR step, rebuilt sequences and abundance.

Alignments have reference, pos (from 1), cigar, seq and size; scaffolds have reference and seq. Scaffolds named contig… keep
their case as it is; on others, what lies within ``pad`` letters of an end, or beyond one, is lower case.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions import seq as S
from seqloom.plans.stages import lookup, stage

#: A deletion of more than this share of the matches parts a read; reads match over half of their letters; deletions
#: of more than this share of a read's letters do not vote.
PARTS, LEAST_MATCH, MOST_DELETED = 0.5, 0.5, 0.2


STEPS = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("hidden", T.BooleanType()), T.StructField("at", T.LongType()), T.StructField("off", T.IntegerType())]))


@functools.lru_cache(100_000)
def cigar_places(cigar: str, clip: bool = True) -> list[dict]:
    """The steps of a CIGAR with where each begins: at (on the reference) and off (in the read), both from 0.

    With ``clip``, hidden says what of a read does not show: of one whose largest deletion is over half of its matches, all
    but the side of more matches; without a heavier side, everything."""
    found = [(op, int(n)) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    matches = lambda part: sum(n for op, n in part if op == "M")
    hole = max((n for op, n in found if op == "D"), default=0)
    shown = range(len(found))
    if clip and hole > PARTS * matches(found):
        i = found.index(("D", hole))
        left, right = matches(found[:i]), matches(found[i + 1 :])
        shown = range(i) if left > right else range(i + 1, len(found)) if right > left else range(0)
    out, at, off = [], 0, 0
    for k, (op, n) in enumerate(found):
        out.append({"op": op, "n": n, "hidden": k not in shown, "at": at, "off": off})
        at += n if op in "MDS" else 0
        off += n if op in "MIS" else 0
    return out


@F.pandas_udf(STEPS)
def _clipped(cigar: pd.Series) -> pd.Series:
    return cigar.map(cigar_places, na_action="ignore")


@F.pandas_udf(STEPS)
def _whole(cigar: pd.Series) -> pd.Series:
    return cigar.map(lambda c: cigar_places(c, False), na_action="ignore")


def placed(cigar, clip: bool = True) -> Column:
    """``cigar_places`` of a column, read once a row: what is pushed through projections does not read it again."""
    return (_clipped if clip else _whole).asNondeterministic()(S.col(cigar))


def steps(alignments: DataFrame) -> DataFrame:
    """Every CIGAR step that shows, with at and off, and the read's reference, seq, size and holed. A soft clip at the beginning
    lies before the alignment's position. Places are summed up within a row, so nothing is shuffled."""
    rows = alignments.select("reference", "pos", "seq", "size", placed("cigar").alias("steps"))
    shown = lambda op: F.aggregate("steps", F.lit(0), lambda a, s: a + F.when((s["op"] == op) & ~s["hidden"], s["n"]).otherwise(0))
    rows = rows.where(shown("M") >= LEAST_MATCH * F.length("seq")).withColumn("holed", shown("D") > MOST_DELETED * F.length("seq"))
    head = F.when(F.col("steps")[0]["op"] == "S", F.col("steps")[0]["n"]).otherwise(0)
    flat = rows.select("reference", "seq", "size", "holed", (F.col("pos") - head).alias("begin"), F.inline(F.filter("steps", lambda s: ~s["hidden"])))
    return flat.withColumn("at", F.col("at") + F.col("begin")).drop("hidden", "begin")


def ends(scaffolds: DataFrame, pad: int) -> DataFrame:
    """reference, first and last position whose letters keep their case."""
    contig = F.col("reference").cast("string").startswith("contig")
    return scaffolds.select("reference", F.when(contig, F.lit(-(1 << 31))).otherwise(pad + 1).alias("first"), F.when(contig, F.lit(1 << 31)).otherwise(F.length("seq") + 1 - pad).alias("last"))


def tallied(alignments: DataFrame, scaffolds: DataFrame, pad: int = 0) -> DataFrame:
    """reference, pos, inserted, letters, votes of letters, deletions and insertions, in one pass over the reads. A deletion is D; a
    soft-clipped letter is S.x, but before the first position a letter like any other. Insertions stand at the base
    behind them; at a read's end they do not count.

    Reads are brought together by reference first, so that what leaves a task is a row a position and letter, not a row a
    read's base; Spark splits the reads of a frequent reference."""
    together = alignments.select("reference", "pos", "cigar", "seq", "size").hint("rebalance", F.col("reference"))
    s = lookup(steps(together).where("op IN ('M', 'S') OR (op = 'D' AND NOT holed) OR (op = 'I' AND off + n < length(seq))"), ends(scaffolds, pad), "reference")
    whole = F.array(F.struct(F.lit(0).alias("i"), F.col("n").alias("m")))
    single = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(i.alias("i"), F.lit(1).alias("m")))
    each = s.select("*", F.inline(F.when(F.col("op") == "I", whole).otherwise(single))).withColumn("pos", F.col("at") + F.col("i"))
    plain = F.substring("seq", F.col("off") + F.col("i") + 1, F.col("m"))
    letter = F.when((F.col("pos") < F.col("first")) | (F.col("pos") > F.col("last")), F.lower(plain)).otherwise(plain)
    told = F.when(F.col("op") == "D", "D").when(F.col("op").isin("M", "I") | (F.col("pos") < F.col("first")), letter).when(F.col("pos") >= 1, F.concat(F.lit("S."), letter))
    rows = each.select("reference", "pos", (F.col("op") == "I").alias("inserted"), told.alias("letters"), "size").where("letters IS NOT NULL")
    return rows.groupBy("reference", "pos", "inserted", "letters").agg(F.sum("size").alias("votes"))


def votes(alignments: DataFrame, scaffolds: DataFrame, pad: int = 0) -> DataFrame:
    """reference, pos, base, votes."""
    return tallied(alignments, scaffolds, pad).where("NOT inserted").select("reference", "pos", F.col("letters").alias("base"), "votes")


def insertions(alignments: DataFrame, scaffolds: DataFrame, pad: int = 0) -> DataFrame:
    """reference, pos (the base behind), letters, votes."""
    return tallied(alignments, scaffolds, pad).where("inserted").select("reference", "pos", "letters", "votes")


def called(voted: DataFrame) -> DataFrame:
    """reference, pos, base, top, ties: the most votes at each position. Soft-clipped letters count where nothing else is."""
    soft = F.col("base").startswith("S.")
    alone = F.min(soft.cast("int")).over(Window.partitionBy("reference", "pos")) == 1
    usable = voted.withColumn("alone", alone).where(~soft | F.col("alone")).withColumn("base", F.when(soft, F.expr("substring(base, 3)")).otherwise(F.col("base")))
    top = usable.withColumn("top", F.max("votes").over(Window.partitionBy("reference", "pos"))).where("votes = top")
    return top.groupBy("reference", "pos").agg(F.max("base").alias("base"), F.max("top").alias("top"), F.count("*").alias("ties"))


def rebuilt(alignments: DataFrame, scaffolds: DataFrame, pad: int = 0) -> DataFrame:
    """reference, seq, length: from the first position with votes to the last, each by its votes. Ties are n, deletions that
    win fall out, positions without votes are N (n where the scaffold has n). An insertion of as many votes as are left
    for the base, less those of all insertions, comes before it; several of as many votes are n. What the scaffold has
    in lower case, or does not have, is lower case. Scaffolds without reads are left out."""
    told = stage(tallied(alignments, scaffolds, pad))
    tops = called(told.where("NOT inserted").select("reference", "pos", F.col("letters").alias("base"), "votes"))
    ins = told.where("inserted")
    here = Window.partitionBy("reference", "pos")
    most = ins.withColumns({"most": F.max("votes").over(here), "all": F.sum("votes").over(here)}).where("votes = most")
    best = most.groupBy("reference", "pos").agg(F.max("letters").alias("letters"), F.count("*").alias("same"), F.max("most").alias("most"), F.max("all").alias("all"))
    spots = tops.join(best, ["reference", "pos"], "full")
    after = F.lead("pos").over(Window.partitionBy("reference").orderBy("pos"))
    rows = spots.withColumn("gap", F.coalesce(after - F.col("pos") - 1, F.lit(0))).join(scaffolds.withColumnRenamed("seq", "old"), "reference")
    inside = (F.col("pos") >= 1) & (F.col("pos") <= F.length("old"))
    was = F.when(inside, F.substring("old", F.col("pos").cast("int"), F.lit(1))).when(F.col("pos") == 0, "a")
    contig = F.col("reference").cast("string").startswith("contig")
    low = ~contig & F.coalesce(was.rlike("[acgt]"), F.lit(False))
    more = F.when(F.col("most").isNotNull() & (F.col("top").isNull() | (F.col("most") >= F.col("top") - F.col("all"))), F.when(F.col("same") > 1, F.repeat(F.lit("n"), F.length("letters"))).otherwise(F.col("letters"))).otherwise("")
    told = F.when(F.col("top").isNull() | ((F.col("base") == "D") & (F.col("ties") == 1)), "").when(F.col("ties") > 1, "n").when(low | was.isNull(), F.lower("base")).otherwise(F.col("base"))
    # positions up to the next with votes: N, or n where the scaffold has n
    begin = (F.col("pos") + 1).cast("int")
    seen = F.when(begin >= 1, F.substr(F.col("old"), begin, F.col("gap").cast("int"))).otherwise(F.substr(F.col("old"), F.lit(1), F.greatest(F.col("gap") + begin - 1, F.lit(0)).cast("int")))
    kept = F.when(contig, F.regexp_replace(seen, ".", "N")).otherwise(F.regexp_replace(seen, "[^n]", "N"))
    lead = F.repeat(F.lit("N"), F.when(begin < 1, F.least(F.col("gap"), 1 - begin)).otherwise(0).cast("int"))
    blank = F.rpad(F.concat(lead, F.coalesce(kept, F.lit(""))), F.col("gap").cast("int"), F.lit("N"))
    part = F.concat(F.when(low, F.lower(more)).otherwise(more), told, F.when(F.col("gap") > 0, blank).otherwise(""))
    lists = rows.select("reference", "pos", part.alias("part")).groupBy("reference").agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("l"))
    out = lists.select("reference", F.array_join(F.transform("l", lambda x: x["part"]), "").alias("seq"))
    return out.withColumn("length", F.length("seq"))


def quantified(alignments: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """reference, seq, size: scaffolds with the sum of sizes of distinct alignments; those without any are left out."""
    sums = alignments.select("id", "reference", "pos", "cigar", "seq", "size").distinct().groupBy("reference").agg(F.sum("size").alias("size"))
    return scaffolds.join(sums, "reference")
