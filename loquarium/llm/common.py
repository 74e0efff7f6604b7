"""What several operators of this subpackage share: the shared folder, materialised steps, connected components."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII capitals; contracts of this subpackage lower-case these alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it lies; one of fewer files than there are cores is dealt out, as one row group is one task else."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Where it is unset, a temporary one on a single machine (master local[…]); on a cluster, whose
    executors would each write to a disk of their own, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (master := spark.sparkContext.master).startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loquarium-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: computed once, whatever reads it or is lost."""
    spark = df.sparkSession
    path = new_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that an operator has written and needs no more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidied(kernel: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A kernel for mapInPandas after whose last batch the worker gives memory back; workers outlive tasks."""

    @functools.wraps(kernel)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from kernel(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Frees what a task has left: garbage, Arrow's pool and the allocator's free pages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # no glibc
        pass


#: Rows in an Arrow batch of whole texts; Spark's own 10 000 can be hundreds of megabytes.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows, for kernels that get whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drawn(df: DataFrame, key: Column, rows: int, most: int) -> DataFrame:
    """About twice ``most`` of a table's counted rows, by a hash (all of a smaller table); then the ``most`` least hashes.

    Tasks rank what was drawn alone, so what they return does not grow with their number.
    """
    share = int(min(1.0, 2 * most / max(rows, 1)) * (1 << 30))
    some = df.withColumn("_key", key).where(F.pmod("_key", F.lit(1 << 30)) < share)
    return some.orderBy("_key").limit(most).drop("_key")


def plan_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """A broadcast hint where the counted rows are few enough; else Spark chooses a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def connected_components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge between two different nodes.

    Alternating large-star and small-star steps (each edge list shrinks towards stars); every step is
    written to the shared folder, so a lost executor costs one step.  The number of steps grows with
    the logarithm of the longest path.  Null ends and self-loops are ignored.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    spark, before, old = e.sparkSession, None, []

    def kept(df: DataFrame) -> DataFrame:
        out = written(df, f"{label}-edges")
        old.extend({f.rpartition("/")[0] for f in out.inputFiles()[:1]})
        return out

    e = kept(e)
    while True:
        # The least neighbours are written before they are joined: a plain join of a star's many edges with one row can be split by AQE.
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = kept(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low2 = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(low2.select("u", F.col("m").alias("v"))).distinct()
        past, old = old, []
        e = kept(small)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        for path in past:
            removed(spark, path)
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
