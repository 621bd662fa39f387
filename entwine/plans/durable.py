"""Cutting lineage, bounded broadcasts and partition counts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes, as the optimizer knows them, up to which a side of a join may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
#: Spark's setting by which shuffle files go when their query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Only where it names none on a single machine (tests) a temporary folder is set; on a cluster that is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = tempfile.mkdtemp(prefix="entwine-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from its files; they go when the application ends.

    A table is compressed and read by column, which a checkpoint of rows is not, and as durable. What was shuffled for
    it goes as soon as it is written, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/entwine-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is proven to hold at most `rows` rows of BROADCAST_BYTES in all, else unchanged.

    The proof reads no more than `rows` + 1 rows and adds up their texts. Beyond the bound Spark shuffles both
    sides and AQE splits skewed partitions, so the result is the same either way.
    """
    size = sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    n, held = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= BROADCAST_BYTES else df


def shuffled(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that Spark must not broadcast by its own guess.

    The optimizer counts an exploded row once and an array as one element, so keys and blocks pass for small and fill the driver.
    """
    return df.hint("merge")


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Even out `df` over all cores before costly per-row work on few input splits."""
    spark: SparkSession = df.sparkSession
    want = max(least, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(want)
