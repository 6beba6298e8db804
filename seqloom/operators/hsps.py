"""Tables of alignments between sequences (HSPs): query, subject, pident, length, mismatches, gaps, qstart, qend, sstart,
send, bits. What the merging rounds and the improvement loop decide is taken from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.plans.stages import numbered

REVERSED = ";rev=1"


def mirrored(hsps: DataFrame, unchanged: DataFrame) -> DataFrame:
    """The rows, and those whose subject is unchanged (name) once more from its side, as unchanged sequences were not
    searched with."""
    back = hsps.join(unchanged.select(F.col("name").alias("subject")).distinct(), "subject", "left_semi")
    names = {"query": "subject", "subject": "query", "qstart": "sstart", "qend": "send", "sstart": "qstart", "send": "qend"}
    return hsps.unionByName(back.select(*[F.col(names.get(c, c)).alias(c) for c in hsps.columns]))


def forward(hsps: DataFrame) -> DataFrame:
    """Without hits of a sequence on itself or on its own other strand, and without hits on the subject's other strand."""
    bare = lambda c: F.regexp_replace(c, f"{REVERSED}$", "")
    return hsps.where((bare("query") != bare("subject")) & (F.col("send") >= F.col("sstart")))


def absorbed(hsps: DataFrame, share: float = 0.99, pident: float = 99.0) -> DataFrame:
    """name, into: contigs (…length=n) that an alignment of over ``share`` of their length and over ``pident`` lays within
    another sequence's forward strand, each into the one of most bits; a contig that takes others in is not absorbed itself.

    Chains are cut at the longer contig: of two that absorb each other, the longer (then the smaller name) stays."""
    def side(one: str, other: str) -> DataFrame:
        n = F.nullif(F.regexp_extract(one, r"length=(\d+)", 1), F.lit("")).cast("long")
        fits = F.col(one).rlike(r"^contig.*length=\d+") & ~F.col(other).endswith(REVERSED) & (F.col("pident") > pident) & (F.col("length") > share * n)
        of = F.coalesce(F.nullif(F.regexp_extract(other, r"length=(\d+)", 1), F.lit("")).cast("long"), F.lit(1 << 40))
        return forward(hsps).where(fits).select(F.regexp_replace(one, f"{REVERSED}$", "").alias("name"), F.col(other).alias("into"), "bits", n.alias("n"), of.alias("m"))

    found = side("query", "subject").union(side("subject", "query"))
    down = found.where((F.col("m") > F.col("n")) | (F.col("m") == F.col("n")) & (F.col("into") < F.col("name")))
    return down.groupBy("name").agg(F.max_by("into", F.struct("bits", "m", "into")).alias("into"))


def reciprocal(hsps: DataFrame) -> DataFrame:
    """HSPs whose mirror image is in the table, too."""
    keys = [("query", "subject"), ("qstart", "sstart"), ("qend", "send")]
    mirror = hsps.select(*[F.col(a).alias(b) for a, b in keys], *[F.col(b).alias(a) for a, b in keys]).distinct()
    return hsps.join(mirror, [c for k in keys for c in k], "left_semi")


def sums(hsps: DataFrame) -> DataFrame:
    """query, subject, bits (their sum), left (the least query start), ranges: [qstart, qend, sstart, send] of the pair's
    HSPs in order."""
    ranges = F.sort_array(F.collect_list(F.array("qstart", "qend", "sstart", "send")))
    return hsps.groupBy("query", "subject").agg(F.sum("bits").alias("bits"), F.min("qstart").alias("left"), ranges.alias("ranges"))


def jobs(pairs: DataFrame) -> DataFrame:
    """job: pairs (query, subject, bits) in the order in which they are tried: each query's best subject, then each one's
    second, and so on; within a turn forward subjects before others, then by bits and names.

    Places in either order come from sorted partitions, so no task sees all pairs, nor all of a query."""
    own = numbered(pairs, "place", "query", F.desc("bits"), "subject")
    first = own.groupBy("query").agg(F.min("place").alias("first"))
    rows = own.join(first, "query").withColumns({"turn": (F.col("place") - F.col("first") + 1).cast("int"), "back": F.col("subject").endswith(REVERSED).cast("int")})
    return numbered(rows, "job", "turn", "back", F.desc("bits"), "query", "subject").select("query", "subject", "bits", "turn", "job")


def distances(hsps: DataFrame, lengths: DataFrame) -> DataFrame:
    """query, subject, distance: letters of both (name, length) less what alignments agree on, and their gaps."""
    agreed = F.sum(F.floor(F.col("pident") / 100 * 2 * F.col("length")))
    per = hsps.groupBy("query", "subject").agg(agreed.alias("agreed"), F.sum("gaps").alias("gaps"))
    q, s = (lengths.select(F.col("name").alias(c), F.col("length").alias(f"{c}_length")) for c in ("query", "subject"))
    both = per.join(q, "query").join(s, "subject")
    return both.select("query", "subject", (F.col("query_length") + F.col("subject_length") - F.col("agreed") + F.col("gaps")).cast("long").alias("distance"))


def convergence(found: DataFrame) -> DataFrame:
    """cycle, sequences, settled, mean_distance, most_distance of rows (cycle, distance, length): settled are those that
    changed by less than a 200th of their letters after cycle 2, by less than a 100th after cycle 5, or not at all."""
    share = F.col("distance") / F.greatest("length", F.lit(1))
    done = (F.col("distance") == 0) | ((F.col("cycle") > 2) & (share < 0.005)) | ((F.col("cycle") > 5) & (share < 0.01))
    return found.groupBy("cycle").agg(F.count("*").alias("sequences"), F.count(F.when(done, 1)).alias("settled"), F.avg("distance").alias("mean_distance"), F.max("distance").alias("most_distance"))


def merged_coverage(pairs: DataFrame) -> DataFrame:
    """Adds coverage: that of two merged contigs (length, cover, length2, cover2) over the merged letters (merged)."""
    total = F.col("length") * F.col("cover") + F.col("length2") * F.col("cover2")
    return pairs.withColumn("coverage", F.floor(total / F.greatest("merged", F.lit(1))))


def strong(hsps: DataFrame, pident: float, word: int) -> DataFrame:
    """HSPs that an aligner with these thresholds would report: least identity, and a length of its word at least."""
    return hsps.where((F.col("pident") >= pident) & (F.col("length") >= word))
