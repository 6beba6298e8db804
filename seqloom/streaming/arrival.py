"""Reads that arrive as files: running dereplication and abundance, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import seq as S


def arriving_fasta(spark: SparkSession, folder: str) -> DataFrame:
    """def, seq of the FASTA files that come to a folder."""
    rows = spark.readStream.option("lineSep", "\n>").text(folder)
    text = F.regexp_replace("value", r"^>", "")
    return rows.where("value <> ''").select(F.regexp_extract(text, r"^([^\n]*)", 1).alias("def"), F.regexp_replace(F.regexp_replace(text, r"^[^\n]*", ""), r"[\r\n]", "").alias("seq"))


def dereplicated(reads: DataFrame) -> DataFrame:
    """seq, size, first: running counts over both strands; for output modes update and complete."""
    strand = F.least(F.upper("seq"), S.reverse_complement(F.upper("seq")))
    return reads.select("def", strand.alias("seq")).groupBy("seq").agg(F.count("*").alias("size"), F.min("def").alias("first"))


def abundance(placed: DataFrame) -> DataFrame:
    """reference, weight: running sums of sizes (reference, size)."""
    return placed.groupBy("reference").agg(F.sum("size").alias("weight"))
