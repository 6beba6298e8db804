"""From raw documents to token digests: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs
of the next one. All but the last return the columns of documents, whatever else these have and however it is named
(score, row, key, hash and the like, too).

Null texts count as empty. Empty and white texts have no toxic word, are one group of exact copies, have no shingles (so they are
near to nothing), weigh nothing in the mix and have no tokens. Repeated rows are copies like any other. Where a doc_id has several
texts, the near-dedup keeps all of its rows or none, and the mix takes those of one source alike. A null doc_id comes last among
exact copies and is near to nothing; a null source is a source of its own, the last. Texts are read whole, however long. An empty table gives an empty table at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import bpe, exact_dedup, minhash, mixing, toxicity
from seqloom.llm.common import documents, shared_dir
from seqloom.llm.queries import TIKTOKEN_FILE


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores 0.5 or above go; the model learns from the labelled rows of docs."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, one stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8), the smallest doc_id stays."""
    return minhash.one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their targets: rows are left out, or come twice."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's doc_id and token count, and the digests of its ids and of the bytes decoded from them; other columns end here."""
    return bpe.round_trip(docs, TIKTOKEN_FILE, public_tokenizers.PATTERN)


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", encode)]

#: SQL can express neither the trained model nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_dir(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
