"""Hit-table analytics: filters, top-N, elementary segments, densities, scores and the group contest.

Positions that the same hits cover behave alike, so nothing is expanded to single positions: a query is cut at every
start and after every end, and sums over positions are sums over segments times their length.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.stages import lookup

NEAR = 0.9
#: Hits that one task takes, about.
DEALT = 25_000


def usable(hits: DataFrame, evalue: float = 0.1) -> DataFrame:
    return hits.where((F.col("evalue") <= evalue) & F.col("taxon").isNotNull() & (F.col("taxon") != 0))


def ranked(hits: DataFrame, order: list[str]) -> DataFrame:
    """Adds rn, the place of a hit within its query."""
    keys = [F.col(o.split()[0]).desc() if o.endswith("DESC") else F.col(o).asc() for o in order]
    return hits.withColumn("rn", F.row_number().over(Window.partitionBy("query").orderBy(*keys)))


def top_n(hits: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The n best hits of each query, with their place rn."""
    return ranked(hits, order).where(F.col("rn") <= n)


def tasks(hits: DataFrame) -> int:
    """As many tasks as there are hits for."""
    return max(int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-hits.count() // DEALT))


def by_query(hits: DataFrame, n: int | None = None) -> DataFrame:
    """Hits dealt out by query, to ``n`` tasks. All that follows works within a query, by windows and sums that need no other
    shuffle, so the hits are all that moves."""
    return hits.repartition(n or tasks(hits), "query")


def cut(hits: DataFrame) -> DataFrame:
    """Every hit in every segment that it covers: the hit's columns, start, stop (inclusive) and length. Segments are maximal
    stretches that the same hits cover; a query is cut at every start and after every end."""
    ends = F.flatten(F.collect_list(F.array("qstart", F.col("qend") + 1)).over(Window.partitionBy("query")))
    place = lambda at: F.expr(f"cast(array_position(_cuts, {at}) as int)")
    held = hits.withColumn("_cuts", F.array_sort(F.array_distinct(ends))).where("query IS NOT NULL AND qend >= qstart")
    inside = F.transform(F.sequence(place("qstart"), place("qend + 1") - 1), lambda i: F.struct(F.element_at("_cuts", i).alias("start"), (F.element_at("_cuts", i + 1) - 1).alias("stop")))
    return held.select(*hits.columns, F.inline(inside)).withColumn("length", F.col("stop") - F.col("start") + 1)


def covered(hits: DataFrame) -> DataFrame:
    """``cut`` with density (bits a position)."""
    return cut(hits.withColumn("density", F.col("bits") / (F.col("qend") - F.col("qstart") + 1)))


def near_top(cover: DataFrame, *also: str) -> DataFrame:
    """Hits of taxa near the top, in all their segments, with the segment's top: a taxon that is near the top somewhere in the
    query (and in ``also``) counts wherever it covers."""
    tops = cover.withColumn("top", F.max("density").over(Window.partitionBy("query", *also, "start")))
    near = F.max((F.col("density") >= NEAR * F.col("top")).cast("int")).over(Window.partitionBy("query", *also, "taxon"))
    return tops.withColumn("near", near).where("near = 1").drop("near")


def top_taxa(cover: DataFrame) -> DataFrame:
    """query, start, stop, length, taxon, density, top: each taxon's best density in a segment where it is near the top,
    and in every other segment that the taxon covers if it is near the top somewhere in the query."""
    return near_top(cover).groupBy("query", "start", "stop", "length", "taxon").agg(F.max("density").alias("density"), F.max("top").alias("top"))


def representation(cover: DataFrame, scale: int = 1) -> DataFrame:
    """query, taxon, rep: over the positions, the sum of (density / top) ^ (3 ^ scale) / scale of all hits of good taxa."""
    power = F.pow(F.col("density") / F.col("top"), F.pow(F.lit(3.0), F.lit(float(scale)))) / scale
    return near_top(cover).groupBy("query", "taxon").agg(F.sum(power * F.col("length")).alias("rep"))


def running_max(cover: DataFrame) -> DataFrame:
    """Hits that raised the running best density of some segment, in hit order (column rn): query, rn."""
    before = Window.partitionBy("query", "start").orderBy("rn").rowsBetween(Window.unboundedPreceding, -1)
    raised = F.col("density") > F.coalesce(F.max("density").over(before), F.lit(0.0))
    return cover.withColumn("raised", raised).where("raised").select("query", "rn").distinct()


def taxon_scores(cover: DataFrame) -> DataFrame:
    """query, taxon, score (sum of best densities over positions), positions."""
    return top_taxa(cover).groupBy("query", "taxon").agg(F.sum(F.col("density") * F.col("length")).alias("score"), F.sum("length").alias("positions"))


def group_scores(cover: DataFrame, groups: DataFrame) -> DataFrame:
    """query, group, score: over positions, the best density that any taxon of the group (taxon, group) has."""
    best = lookup(top_taxa(cover), groups, "taxon").groupBy("query", "start", "length", "group").agg(F.max("density").alias("density"))
    return best.groupBy("query", "group").agg(F.sum(F.col("density") * F.col("length")).alias("score"))


def radius_bits(best, attainable, protein: bool = False):
    """How many bits below the best score a taxon may lie and still count as a candidate, from the best score and what a
    perfect alignment would attain; null for scores of 1 and less, where the logs vanish.

    Identity is estimated from the share of attainable bits, blurred by the length of the evidence."""
    best, share = F.col(best) * 1.0, F.col(best) / F.col(attainable)
    identity = share if protein else (2 * share + 3) / 5
    floor = 2 ** (1 / 3) / 40 if protein else math.e / (math.pi * math.sqrt(2)) / 10
    blur = -F.log(identity) / (F.log(best) * F.log10(best)) + floor
    radius = math.e / F.log10(best) * blur + -F.log10(identity) / F.log10(100 * blur) * blur
    return F.when(best > 1, radius * best)
