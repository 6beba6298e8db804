"""What the operators of this subpackage share: the shared folder, staged tables, skew-proof joins, components.

Nothing here collects rows to the driver, and every table that is reused is written to the folder in
``spark.checkpoint.dir`` so that a lost executor costs a re-read, never a result.
"""

from __future__ import annotations

import contextlib
import functools
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many rows (of a few longs each, so some MB) may be broadcast.
BROADCAST_ROWS = 200_000
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a local session gets a temporary one; a cluster's
    machines would not see each other's, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written here leaves no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, and fixes what is random."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: all that came of them has itself been written."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bucketed(df: DataFrame, key: str, some: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the rows of ``df`` whose key is in ``some`` (a row a key) as a table in the shared folder, bucketed by ``key`` as
    finely as ``df`` is split and as shuffles are (Spark deals coarser buckets out anew), and read it back: joins by ``key``
    then move the other side alone. The table's name comes with it; whoever is done with it drops it from the catalog."""
    spark = df.sparkSession
    n = max(8, df.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"{name}_{uuid.uuid4().hex}"
    held = df.repartition(n, key).join(some.repartition(n, key).hint("merge"), key, "left_semi")
    with shuffles_removed(spark):
        held.write.format("parquet").bucketBy(n, key).option("path", shared_dir(spark, name)).saveAsTable(table)
    return spark.table(table), table


def join_lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = 32, rows: int | None = None) -> DataFrame:
    """Join to ``right``, which has one row per key, whatever the skew of ``left``.

    ``rows`` is a bound on the rows of ``right``, if one is known; else they are counted, so ``right`` should be cheap to
    count. Up to BROADCAST_ROWS rows it is broadcast. Beyond that, every row of it is repeated once per salt and the
    rows of ``left`` are spread over the salts, so that a key that holds a third of all rows is dealt to ``salts``
    tasks. ``how`` is inner or left.
    """
    if (right.limit(BROADCAST_ROWS + 1).count() if rows is None else rows) <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected ``edges`` (a long, b long): rows (node, component = smallest member).

    Alternates the large-star and small-star steps, each a minimum with map-side combining and a skew-proof join; the
    edge set is staged each round, until every edge leads from a node of one edge to a root. Self loops and repeated
    edges are allowed; nodes without edges do not appear.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), name)
    while True:
        ends = now.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
        roles = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("root"))
        n, loose = roles.agg(F.count("*"), F.count(F.when((F.col("ups") > 1) | (F.col("ups") > 0) & (F.col("root") == 0), 1))).first()
        if not loose:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_lookup(both.where("v > u"), low, ["u"], rows=n).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        if n > BROADCAST_ROWS:
            large = staged(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = join_lookup(large, low, ["u"], rows=n)
        small = hung.select(F.inline(F.array(F.struct(F.greatest("v", "m").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        now = staged(small.where("u <> v").distinct(), name)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


@functools.cache
def _shipped(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="seqloom-")), "seqloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(path)


def ship(spark: SparkSession) -> None:
    """Before Python tasks: give the running application's tasks this package, wherever they run, once, as a zip. Arrow
    batches stay at BATCH_BYTES, which whole documents need and short rows do not feel, unless a smaller bound is set."""
    _shipped(spark.sparkContext.applicationId)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def small(batches, rows: int = 1000):
    """Arrow batches of at most so many rows, as whole documents become Python objects a batch at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def large(batches, rows: int = 50_000):
    """Arrow batches of short rows put together to at least so many, but for the last."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
