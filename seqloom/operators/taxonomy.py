"""Taxonomy: ancestor closure, groups, collapse, repair of ids, and the weighted-majority ancestor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.stages import lookup, stage

# Taxon groups by their root.
GROUPS = {10239: "virus", 28384: "others", 12884: "viroids", 12908: "unclassified", 131567: "cellularOrganisms"}
ROOT, HOPS = 1, 100


def closure(taxonomy: DataFrame, hops: int = HOPS) -> DataFrame:
    """taxid, ancestor, hops for every taxon and every ancestor below the root, itself included at 0 hops.

    Paths double in length each turn, so a tree of depth d takes log2(d) joins; paths above ``hops`` are left out.
    """
    edges = taxonomy.where(f"taxid <> {ROOT} AND parent <> {ROOT} AND parent <> taxid").select("taxid", F.col("parent").alias("ancestor"), F.lit(1).alias("hops"))
    # each turn's paths are written and read back, so that a plan scans each once, whatever the depth
    paths, length = stage(edges), 1
    while length < hops:
        right = paths.select(F.col("taxid").alias("ancestor"), F.col("ancestor").alias("far"), F.col("hops").alias("more"))
        longer = stage(paths.where(F.col("hops") == length).join(right, "ancestor").select("taxid", F.col("far").alias("ancestor"), (F.col("hops") + F.col("more")).alias("hops")))
        if longer.isEmpty():
            break
        paths, length = paths.union(longer), 2 * length
    return taxonomy.where(f"taxid <> {ROOT}").select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("hops")).union(paths.where(F.col("hops") <= hops))


def depths(closed: DataFrame) -> DataFrame:
    """taxid, depth: 0 for children of the root."""
    return closed.groupBy("taxid").agg(F.max("hops").alias("depth"))


def trace_to_group(closed: DataFrame, roots: dict[int, str]) -> DataFrame:
    """taxid, group: the nearest ancestor among the groups' roots; unknown where there is none."""
    names = F.create_map(*[F.lit(x) for kv in roots.items() for x in kv])
    near = closed.where(F.col("ancestor").isin(*roots)).groupBy("taxid").agg(F.min_by("ancestor", "hops").alias("root"))
    return closed.select("taxid").distinct().join(near, "taxid", "left").select("taxid", F.coalesce(names[F.col("root")], F.lit("unknown")).alias("group"))


def collapse(taxonomy: DataFrame, closed: DataFrame, roots: dict[int, int]) -> DataFrame:
    """taxid, target: taxa below a root climb to the ancestor so many layers above the nearest ranked one, the root at
    most; others stay. ``roots`` has the layers of each root."""
    ranked = taxonomy.where("rank = 'species'").select(F.col("taxid").alias("ancestor"))
    below = closed.where(F.col("ancestor").isin(*roots)).groupBy("taxid").agg(F.min_by("ancestor", "hops").alias("root"), F.min("hops").alias("room"))
    layer = F.create_map(*[F.lit(x) for kv in roots.items() for x in kv])[F.col("root")]
    first = closed.join(ranked, "ancestor", "left_semi").groupBy("taxid").agg(F.min("hops").alias("rank_hops"))
    climb = below.join(first, "taxid").select("taxid", F.least(F.col("rank_hops") + layer, F.col("room")).alias("hops"))
    moved = closed.join(climb, ["taxid", "hops"]).select("taxid", F.col("ancestor").alias("target"))
    return closed.select("taxid").distinct().join(moved, "taxid", "left").select("taxid", F.coalesce("target", "taxid").alias("target"))


def repair(wanted: DataFrame, nodes: DataFrame, merged: DataFrame, deleted: DataFrame) -> DataFrame:
    """taxid, resolved, status for distinct wanted ids: merged ids are replaced, deleted ones hang below the root, and
    what no table has is missing. Ids 0 and null are ignored."""
    ids = wanted.where("taxid IS NOT NULL AND taxid <> 0").select("taxid").distinct()
    named = ids.join(merged.select(F.col("old").alias("taxid"), "new"), "taxid", "left").withColumn("resolved", F.coalesce("new", "taxid"))
    known = nodes.select(F.col("taxid").alias("resolved"), F.lit(True).alias("known")).distinct()
    gone = deleted.select(F.col("taxid").alias("resolved"), F.lit(True).alias("gone")).distinct()
    found = named.join(known, "resolved", "left").join(gone, "resolved", "left")
    status = F.when(F.col("known"), F.when(F.col("new").isNotNull(), "merged").otherwise("current")).when(F.col("gone"), "deleted").otherwise("missing")
    return found.select("taxid", "resolved", status.alias("status"))


def weighted_lca(reps: DataFrame, closed: DataFrame, stop: int | None = None) -> DataFrame:
    """query, taxid, rep, flag: the deepest ancestor whose share of the query's representation is a majority.

    ``reps`` has query, taxid, rep. A node's representation is the sum over its subtree. The majority is half the total
    plus a margin that falls with its log; below two thirds the result is flagged noSupermajority. ``stop`` (the root of a
    group) does not count. Without a majority, the second by representation, depth and taxid is taken: noMajority.
    """
    total = F.sum("rep").over(Window.partitionBy("query"))
    up = reps.groupBy("query", "taxid").agg(F.sum("rep").alias("rep")).withColumn("total", total)
    above = closed.groupBy("taxid").agg(F.collect_list("ancestor").alias("above"))
    up = lookup(up, above, "taxid").withColumn("ancestor", F.explode("above"))
    nodes = up.groupBy("query", "ancestor").agg(F.sum("rep").alias("rep"), F.max("total").alias("total"))
    nodes = lookup(nodes, depths(closed).select(F.col("taxid").alias("ancestor"), "depth"), "ancestor")
    majority = (0.5 + (2 / 3 - 0.5) / F.log2(F.greatest("total", F.lit(2.718281828459045)))) * F.col("total")
    wins = (F.col("rep") > majority) & (F.col("ancestor") != F.lit(stop if stop is not None else -1))
    by_depth = Window.partitionBy("query").orderBy(F.col("wins").desc(), F.col("depth").desc(), F.round("rep", 9).desc(), "ancestor")
    by_rep = Window.partitionBy("query").orderBy(F.round("rep", 9).desc(), F.col("depth").desc(), "ancestor")
    every = Window.partitionBy("query")
    placed = nodes.withColumn("wins", wins).withColumns({"first": F.row_number().over(by_depth), "second": F.row_number().over(by_rep), "any": F.max("wins").over(every), "n": F.count("*").over(every)})
    chosen = placed.where(F.when(F.col("any"), F.col("first") == 1).otherwise(F.col("second") == F.least(F.lit(2), "n")))
    flag = F.when(~F.col("any"), "noMajority").when(F.col("rep") < 2 / 3 * F.col("total"), "noSupermajority").otherwise("")
    return chosen.select("query", F.col("ancestor").alias("taxid"), "rep", flag.alias("flag"))


def without_calls(calls: DataFrame, groups: DataFrame, kept: list[str]) -> DataFrame:
    """Contigs (contig, taxid) without those called (taxid above 1) to a group (taxid, group) that is not kept; a call
    that has no group goes, too."""
    named = calls.join(groups, "taxid", "left")
    return named.where((F.col("taxid") <= 1) | F.coalesce(F.col("group").isin(*kept), F.lit(False))).select("contig", "taxid")
