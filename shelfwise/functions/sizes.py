"""Broadcast only what was counted, and where intermediate tables are kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
#: rows of the largest table that a partition of a shuffle is made for; small ones are merged again
PARTITION_ROWS = 250_000
#: what a task reads of a shuffle and of files, compressed: sorted in memory it is some forty times as much
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}
#: rows of a join's smaller side that a task keeps in a hash table
HASHED_ROWS = 500_000
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if df has at most max_rows rows, by a count that combines on the map side."""
    return df.count() <= max_rows


def small_ones(frames: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> set[str]:
    """The names of the frames with at most max_rows rows, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
        for n, df in frames.items()
    ]
    merged = counts[0]
    for count in counts[1:]:
        merged = merged.unionByName(count)
    return {r["name"] for r in merged.collect() if r["rows"] <= max_rows}


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after the count; otherwise leave the join to AQE."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def hash_if_bounded(df: DataFrame, partitions: int) -> DataFrame:
    """Hint a hash table of df a partition, so that the other side need not be sorted, if it stays bounded."""
    return df.hint("shuffle_hash") if is_small(df, HASHED_ROWS * partitions) else df


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that have ended.

    It does so when the driver's garbage is collected, which may not happen for hours in a large heap.
    """
    spark._jvm.System.gc()


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Settings of the session that keep what a task sorts in memory the same however many rows there are.

    What the session has been told by its user stays. Shuffles start with more partitions where
    there are more rows, and Spark merges them up to the size a task takes.
    """
    told = spark.conf.getAll
    for key, value in TASK_BYTES.items():
        if key not in told:
            spark.conf.set(key, value)
    now = int(told.get(_PARTITIONS, spark.conf.get("spark.sql.shuffle.partitions")))
    if rows // PARTITION_ROWS > now:
        spark.conf.set(_PARTITIONS, rows // PARTITION_ROWS)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting (a test) uses the warehouse folder instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """Intermediate tables of one job, written as Parquet in the shared folder.

    A kept frame survives the loss of executors, has no lineage, and is read
    back with column pruning and filter pushdown. Use it as a context manager
    to drop the tables when the job ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/shelfwise-{uuid.uuid4().hex}"
        self._tables = 0

    def keep(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """df as a table; ``by`` names a column whose values have a folder each."""
        self._tables += 1
        path = f"{self.folder}/{self._tables}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(path, True)
