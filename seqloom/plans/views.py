"""Views of the driver's tables as sequences, taxonomy, hits, alignments and abundance, in Spark and in SQL.

The SQL of each view is what DuckDB runs; the DataFrames hold the same rows.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.plans.stages import batches_bounded

#: Lower-case letters become bases, upper-case letters bases of lower case, a newline n and all else N.
LETTERS = string.ascii_lowercase + string.ascii_uppercase
BASES = ("ACGT" * 7)[:26] + ("acgt" * 7)[:26]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """def, seq: a sequence for each document's whole text."""
    batches_bounded(spark)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("def"), S.lettered("text").alias("seq"))


SEQS = f"""seqs AS (SELECT doc_id AS def, translate(regexp_replace(text, '[^a-zA-Z\\n]', 'N', 'g'), '{LETTERS}' || chr(10), '{BASES}n') AS seq FROM documents)"""


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """taxid, parent, rank, name: suppliers below nations below regions below the root."""
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100_000).alias("taxid"), (F.col("s_nationkey") + 1000).cast("long").alias("parent"), F.lit("species").alias("rank"), F.col("s_name").alias("name"))
    n = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1000).cast("long"), (F.col("n_regionkey") + 10).cast("long"), F.lit("genus"), F.col("n_name"))
    r = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 10).cast("long"), F.lit(1).cast("long"), F.lit("family"), F.col("r_name"))
    root = table(spark, sf_dir, "region").select(F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit("no rank"), F.lit("root")).distinct()
    return s.union(n).union(r).union(root)


TAXONOMY = """taxonomy AS (
    SELECT s_suppkey + 100000 AS taxid, (s_nationkey + 1000)::BIGINT AS parent, 'species' AS rank, s_name AS name FROM supplier
    UNION ALL SELECT (n_nationkey + 1000)::BIGINT, (n_regionkey + 10)::BIGINT, 'genus', n_name FROM nation
    UNION ALL SELECT (r_regionkey + 10)::BIGINT, 1::BIGINT, 'family', r_name FROM region
    UNION ALL SELECT DISTINCT 1::BIGINT, 1::BIGINT, 'no rank', 'root' FROM region)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query, taxon, qstart, qend, bits, pident, evalue, and what orders equal hits."""
    i = table(spark, sf_dir, "lineitem")
    return i.select(
        F.col("l_orderkey").alias("query"), (F.col("l_suppkey") + 100_000).alias("taxon"), F.col("l_linenumber").cast("long").alias("qstart"),
        (F.col("l_linenumber") + F.col("l_quantity") - 1).cast("long").alias("qend"), (F.col("l_extendedprice") / 1000).alias("bits"),
        F.round(100 * (1 - F.col("l_discount")), 2).alias("pident"), (F.col("l_tax") * 2).alias("evalue"), F.col("l_partkey").alias("subject"),
    )


HITS = """hits AS (
    SELECT l_orderkey AS query, l_suppkey + 100000 AS taxon, l_linenumber::BIGINT AS qstart,
           (l_linenumber + l_quantity - 1)::BIGINT AS qend, l_extendedprice / 1000 AS bits,
           round(100 * (1 - l_discount), 2) AS pident, l_tax * 2 AS evalue, l_partkey AS subject FROM lineitem)"""

#: What orders hits within a query: best first, then every column, so that equal rows alone are interchangeable.
HIT_ORDER = ["bits DESC", "pident DESC", "taxon", "qstart", "qend", "subject", "evalue"]


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read, reference, pos, mismatch, size."""
    i = table(spark, sf_dir, "lineitem")
    return i.select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("reference"), F.col("l_linenumber").cast("long").alias("pos"), F.round(F.col("l_discount") * 100).cast("int").alias("mismatch"), F.col("l_quantity").cast("long").alias("size"))


ALIGNMENTS = """alignments AS (
    SELECT l_orderkey AS read, l_suppkey AS reference, l_linenumber::BIGINT AS pos,
           round(l_discount * 100)::INT AS mismatch, l_quantity::BIGINT AS size FROM lineitem)"""


def dual_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits with kind, by the line's flag: NUC or AA."""
    i = table(spark, sf_dir, "lineitem").withColumn("kind", F.when(F.col("l_returnflag") == "N", "NUC").otherwise("AA"))
    return i.select(
        F.col("l_orderkey").alias("query"), "kind", (F.col("l_suppkey") + 100_000).alias("taxon"), F.col("l_linenumber").cast("long").alias("qstart"),
        (F.col("l_linenumber") + F.col("l_quantity") - 1).cast("long").alias("qend"), (F.col("l_extendedprice") / 1000).alias("bits"),
        F.round(100 * (1 - F.col("l_discount")), 2).alias("pident"), (F.col("l_tax") * 2).alias("evalue"), F.col("l_partkey").alias("subject"),
    )


DUAL_HITS = """dhits AS (
    SELECT l_orderkey AS query, CASE WHEN l_returnflag = 'N' THEN 'NUC' ELSE 'AA' END AS kind, l_suppkey + 100000 AS taxon, l_linenumber::BIGINT AS qstart,
           (l_linenumber + l_quantity - 1)::BIGINT AS qend, l_extendedprice / 1000 AS bits,
           round(100 * (1 - l_discount), 2) AS pident, l_tax * 2 AS evalue, l_partkey AS subject FROM lineitem)"""


def scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query, seq: for each order, letters from its key's digest, with some N and lower case."""
    hexes = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    size = (60 + F.floor("o_totalprice") % 37).cast("int")
    seq = F.substring(F.translate(F.concat(hexes, hexes, hexes), "0123456789abcdef", "ACGTACGTACGTACNa"), F.lit(1), size)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query"), seq.alias("seq"))


SCAFFOLDS = """scaf AS (SELECT o_orderkey AS query, substr(translate(repeat(md5(o_orderkey::VARCHAR), 3), '0123456789abcdef', 'ACGTACGTACGTACNa'), 1, (60 + floor(o_totalprice)::BIGINT % 37)::BIGINT) AS seq FROM orders)"""
