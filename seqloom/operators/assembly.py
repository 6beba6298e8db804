"""Unitigs of a de Bruijn graph: words of k bases that follow each other without a branch are put together.

Every word of either strand is a node; a word leads to the one that shares all but its first letter, if no other word
does and no other word leads there. Chains are found by pointers that double their reach each turn, so a chain of n words
takes log2(n) joins. The strand of a unitig that comes first by letters stands for both. Errors make tips and bubbles, which
are taken away; longer words then part what shorter ones confuse.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.operators import sequences as Q


def words(seqs: DataFrame, k: int, least: int) -> DataFrame:
    """word, n: words without N that occur at least ``least`` times on both strands together, each in both directions."""
    one = Q.both_strands(seqs.select("def", F.upper("seq").alias("seq")))
    padded = F.concat("seq", F.lit("N"))  # as the last start is left out
    return one.select(F.explode(S.kmers(padded, k)).alias("word")).where(~F.col("word").contains("N")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def unitigs(seqs: DataFrame, k: int, stage: Callable[[DataFrame], DataFrame], least: int = 1) -> DataFrame:
    """seq, length, depth (mean count of its words), circular: the unitigs of the words of k bases (odd, so that no word is its
    own other strand). Circles are cut before their least word."""
    return unitigs_of(stage(words(seqs, k, least)), k, stage)


def unitigs_of(nodes: DataFrame, k: int, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The unitigs of words (word, n), of which both strands are there."""
    ends = nodes.select("word", F.substring("word", 1, k - 1).alias("head"), F.substring("word", 2, k - 1).alias("tail"))
    out = ends.groupBy(F.col("tail").alias("mid")).agg(F.count("*").alias("froms"), F.min("word").alias("a"))
    into = ends.groupBy(F.col("head").alias("mid")).agg(F.count("*").alias("tos"), F.min("word").alias("b"))
    links = stage(out.join(into, "mid").where("froms = 1 AND tos = 1").select("a", "b"))
    # each word's predecessor as far as known, how far it is, and the least word on the way
    start = nodes.select("word").join(links.select(F.col("b").alias("word"), F.col("a").alias("before")), "word", "left")
    now = stage(start.select("word", F.coalesce("before", "word").alias("first"), F.col("before").isNotNull().cast("long").alias("steps"), F.least("word", F.coalesce("before", "word")).alias("low")))
    total = now.count()
    reach = 1
    while reach < total:
        ahead = now.select(F.col("word").alias("first"), F.col("first").alias("far"), F.col("steps").alias("more"), F.col("low").alias("low2"))
        new = stage(now.join(ahead, "first").select("word", F.col("far").alias("first"), (F.col("steps") + F.col("more")).alias("steps"), F.least("low", "low2").alias("low")))
        moved = new.join(now.select("word", F.col("first").alias("old")), "word").where("first <> old").limit(1).count()
        now, reach = new, 2 * reach
        if not moved:
            break
    heads = links.select(F.col("b").alias("first"), F.lit(True).alias("circle")).distinct()
    marked = now.join(heads, "first", "left").withColumn("circle", F.coalesce("circle", F.lit(False)))
    lines = marked.where("NOT circle").select("word", F.col("first").alias("chain"), F.col("steps").alias("place"), "circle")
    rings = rings_of(marked.where("circle").select("word", F.col("low").alias("chain")), links, stage)
    whole = lines.union(rings).join(nodes, "word")
    letters = F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"])
    chains = whole.groupBy("chain", "circle").agg(letters.alias("words"), F.avg("n").alias("depth"))
    seq = F.concat(F.col("words")[0], F.array_join(F.transform(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), lambda w: F.substring(w, -1, 1)), ""))
    both = chains.select(seq.alias("seq"), "depth", F.col("circle").alias("circular"))
    named = both.select(F.least("seq", S.reverse_complement("seq")).alias("seq"), "depth", "circular")
    return named.groupBy("seq", "circular").agg(F.max("depth").alias("depth")).select("seq", F.length("seq").alias("length"), "depth", "circular")


def weak(found: DataFrame, k: int) -> DataFrame:
    """seq of the unitigs that errors make: tips and the lesser sides of bubbles.

    A tip is shorter than two words, begins where nothing leads to, and ends where a better unitig ends, too. A bubble's sides
    begin and end alike, are at most three words long, and differ by a word in length at most. Better is the deeper one, then
    the longer, then the greater by letters, so of unitigs that compete at one place the best always stays."""
    rows = found.where("NOT circular").select("seq", "depth", "length")
    ways = rows.select("seq", "depth", "length", F.explode(F.array("seq", S.reverse_complement("seq"))).alias("way"))
    sides = ways.select("seq", "depth", "length", F.substring("way", 1, k - 1).alias("head"), F.expr(f"substring(way, -{k - 1})").alias("tail"))
    rank = F.struct("depth", "length", "seq")
    dead = sides.join(sides.select(F.col("tail").alias("head")).distinct(), "head", "left_anti").where(F.col("length") < 2 * k)
    leading = dead.join(sides.select(F.col("head").alias("tail")).distinct(), "tail", "left_semi")
    tips = leading.join(sides.groupBy("tail").agg(F.max(rank).alias("best")), "tail").where("best.seq <> seq").select("seq")
    best = sides.groupBy("head", "tail").agg(F.max(rank).alias("best"), F.countDistinct("seq").alias("n")).where("n > 1")
    bubbles = sides.join(best, ["head", "tail"]).where((F.col("best.seq") != F.col("seq")) & (F.col("length") <= 3 * k) & (F.abs(F.col("length") - F.col("best.length")) <= k)).select("seq")
    return tips.union(bubbles).distinct()


def cleaned(nodes: DataFrame, k: int, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The unitigs of words (word, n) when tips and bubbles are gone: what is weak leaves, what then follows without a branch is put
    together, until nothing is weak."""
    while True:
        found = stage(unitigs_of(nodes, k, stage))
        gone = stage(weak(found, k))
        if gone.isEmpty():
            return found
        both = gone.select(F.explode(F.array("seq", S.reverse_complement("seq"))).alias("seq"))
        dead = both.select(F.explode(S.kmers(F.concat("seq", F.lit("N")), k)).alias("word"))
        nodes = stage(nodes.join(dead, "word", "left_anti"))


def assembled(reads: DataFrame, stage: Callable[[DataFrame], DataFrame], ks: tuple[int, ...] = (29, 43, 57, 71, 85), least: int = 2) -> DataFrame:
    """def, seq, length, depth, circular of contigs from reads (def, seq): cleaned unitigs of the shortest words first; those of one
    length are reads of the next, whose words count as seen ``least`` times. Their names carry depth for ``renamed_contigs``."""
    contigs = None
    for k in ks:
        nodes = words(reads, k, 1)
        if contigs is not None:
            held = contigs.where(F.col("length") >= k).select(F.monotonically_increasing_id().alias("def"), F.when(F.col("circular"), F.concat("seq", F.substring("seq", 1, k - 1))).otherwise(F.col("seq")).alias("seq"))
            nodes = nodes.unionByName(words(held, k, 1).select("word", F.lit(least).cast("long").alias("n")))
        nodes = stage(nodes.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        contigs = cleaned(nodes, k, stage)
    name = F.concat(F.lit(f"k{ks[-1]}_"), F.substring(F.md5("seq"), 1, 12), F.lit(" multi="), F.format_string("%.4f", "depth"), F.lit(" len="), F.col("length").cast("string"))
    return contigs.select(name.alias("def"), "seq", "length", "depth", "circular")


def rings_of(members: DataFrame, links: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """word, chain, place, circle: words of circles (word, chain: its least word) numbered from the least one on, again by
    pointers that double, now cut before the least word."""
    held = stage(members)
    back = held.join(links.select(F.col("b").alias("word"), F.col("a").alias("before")), "word")
    now = stage(back.select("word", "chain", F.when(F.col("word") == F.col("chain"), F.col("word")).otherwise(F.col("before")).alias("first"), (F.col("word") != F.col("chain")).cast("long").alias("place")))
    while not now.where("first <> chain").isEmpty():
        ahead = now.select(F.col("word").alias("first"), F.col("first").alias("far"), F.col("place").alias("more"))
        now = stage(now.join(ahead, "first").select("word", "chain", F.col("far").alias("first"), (F.col("place") + F.col("more")).alias("place")))
    return now.select("word", "chain", "place", F.lit(True).alias("circle"))
