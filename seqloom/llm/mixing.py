"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Each row has a 60-bit hash of its doc_id. Sizes are summed by source and by the hash's first 12 bits; a running sum
over at most 4,096 buckets finds the bucket in which a source's budget ends, and only the rows of that bucket are
summed again by the next 12 bits, down to the last. A row is in a budget if its hash is below the threshold, so
budgets are nested (a larger budget takes what a smaller one takes) and no rows are sorted.

A source's target is min(2 * size, level * weight), the level such that targets add up to 150 % of all sizes. A target
up to the size takes rows below the threshold once; the rest of a larger target takes rows a second time.

Defined results: null text has size 0; null source is a source of its own, after all others; rows that share a doc_id
share a hash and are taken alike; sources without words have target 0; an empty table gives an empty result.
Only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import join_lookup, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
#: Bits of the hash that a level of the histogram looks at, and levels.
BITS, LEVELS = 12, 5


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target. ``sizes`` has a row per source: source, source_size. One row per source is
    ordered in one task; it never holds documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1).cast("double"))
    # sources that reach EPOCHS times their size come first in this order; the level is set by those that do not
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (SHARE * F.sum("source_size").over(every) - EPOCHS * before) / after
    stepped = weighed.withColumn("level", level)
    free = F.col("level") * F.col("weight") < EPOCHS * F.col("source_size")
    first = F.min(F.when(free, F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(every)["level"]
    cap = EPOCHS * F.col("source_size").cast("double")
    return stepped.select("source", "source_size", F.coalesce(F.least(cap, first * F.col("weight")), cap).alias("target"))


def hashed(doc_id: str = "doc_id") -> Column:
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def key(source: str = "source") -> Column:
    """A source's code, so that null is a key like any other."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit(""))


def cuts(rows: DataFrame) -> DataFrame:
    """Per source: key, source_size, target, limit (of the hash). ``rows``: source, key, hash, size."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = F.when(F.col("target") > F.col("source_size"), F.col("target") - F.col("source_size")).otherwise(F.col("target"))
    aims = staged(targets(sums).withColumn("key", key()).withColumn("budget", budget), "mix-aims")
    # per source: the hash prefix reached so far, and what is below it
    edge = aims.select("key", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for depth in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - depth)
        inside = join_lookup(rows, edge, ["key"]) if depth == 1 else join_lookup(rows, edge, ["key"]).where(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        bars = inside.groupBy("key", "budget", "below", F.shiftright("hash", shift).alias("bar")).agg(F.sum("size").alias("n"))
        run = Window.partitionBy("key").orderBy("bar")
        upto = bars.withColumn("from", F.col("below") + F.sum("n").over(run) - F.col("n"))
        # the last bucket that begins within the budget is the one in which it ends
        edge = staged(upto.where(F.col("from") <= F.col("budget")).groupBy("key", "budget").agg(F.max("bar").alias("prefix"), F.max("from").alias("below")), "mix-edge")
    # the rows of the last bucket share all bits: they come in if that leaves the sum nearer to the budget
    last = join_lookup(rows, edge, ["key"]).where(F.col("hash") == F.col("prefix")).groupBy("key").agg(F.sum("size").alias("rest"))
    cut = edge.join(last, "key").withColumn("limit", F.when(F.col("below") + F.col("rest") - F.col("budget") <= F.col("budget") - F.col("below"), F.col("prefix") + 1).otherwise(F.col("prefix")))
    return staged(aims.join(cut.select("key", "limit"), "key", "left").select("key", "source_size", "target", "limit"), "mix-cuts")


def copies() -> Column:
    once = F.when(F.col("target") > F.col("source_size"), 1).otherwise(0)
    return F.least(once + F.when(F.col("hash") < F.col("limit"), 1).otherwise(0), F.lit(EPOCHS))


def measured(docs: DataFrame) -> DataFrame:
    return staged(docs.select("doc_id", "source", words("text").alias("size"), hashed().alias("hash"), key().alias("key")), "mix-rows")


def mix(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target (its source's), taken (words, repeats counted)."""
    rows = measured(docs)
    return join_lookup(rows, cuts(rows), ["key"]).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"), copies().alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them: dropped, once or twice, with their own columns, whatever their names. Documents
    without words are copied like any other; rows that share a doc_id and a source are taken alike. Texts are not shuffled."""
    per = cuts(measured(docs))
    rows = join_lookup(docs.select(F.struct("*").alias("row"), hashed().alias("hash"), key().alias("key")), per, ["key"])
    taken = rows.select("row", F.explode(F.when(copies() > 0, F.sequence(F.lit(1), copies()))).alias("copy"))
    return taken.select("row.*")
