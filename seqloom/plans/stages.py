"""Tables between the turns of iterative operators, in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where it is unset, a local session gets a temporary folder; a cluster's machines would
    not see each other's, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """Written and read back, so that plans stay short and a lost executor costs a re-read."""
    path = f"{folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows of a table that goes to all tasks whole.
BROADCAST_ROWS = 500_000


def lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows joined to a table of short rows, one a key, which is written once. It goes to all tasks if it has been counted to
    be small, so that rows stay where they are."""
    table = stage(table)
    return rows.join(F.broadcast(table) if table.count() <= BROADCAST_ROWS else table, key)


def dealt(df: DataFrame, key: str, n: int) -> DataFrame:
    """``stage`` in ``n`` buckets by the key, so that what reads it works within the key without moving rows again. The table's
    name leaves the catalog at once; its files stay in the shared folder."""
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(n, key).option("path", f"{folder(spark)}/{name}").saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held


def batches_bounded(spark: SparkSession, most: int = 4 << 20) -> None:
    """Before Python tasks on whole sequences: Arrow batches of so many bytes at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).lower().rstrip("b")) > most:
        spark.conf.set(name, f"{most}b")


def numbered(rows: DataFrame, name: str, *order) -> DataFrame:
    """Rows with their place in the order, from 1. Sorted partitions are numbered within themselves and by what stands before
    them, so that no task sees all rows; one row a partition is summed up in one."""
    columns = {"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}
    placed = stage(rows.orderBy(*order).withColumns(columns))
    parts = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    skip = parts.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    number = F.col("_at") - F.col("_first") + F.col("_skip") + 1
    return placed.join(skip, "_part").select(*rows.columns, number.alias(name))
