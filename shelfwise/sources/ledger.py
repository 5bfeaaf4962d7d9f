"""The keys of all stored sales, bucketed, so that a batch meets them bucket by bucket."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.merges import SALES_KEY
from shelfwise.schemas import SALES
from shelfwise.sources.storage import _files, read_table, table_path

_GENERATION = re.compile(r"g(\d+)-b(\d+)$")


class SalesKeys:
    """A table of (key, batch) in buckets by key.

    A load joins its keys with it bucket by bucket: only the batch is shuffled, however long
    the history is. Loads append; a key may be stored twice, which changes no answer.
    ``compact`` writes the next generation of the table, each key once and a file a bucket,
    and may change the number of buckets. A generation counts when it is whole, so a
    compaction that is cut short leaves the one before.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        """buckets: of a table that does not exist yet; the number of shuffle partitions if not given."""
        self.spark, self.folder = spark, table_path(root, "sales_keys")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        whole = self._generations()
        self.number, self.buckets = max(whole) if whole else (0, buckets)
        self.name = self._registered(self.number, self.buckets)
        if not whole:  # a table of its own is made of what is stored
            self.add(read_table(spark, root, "sales"), "before")

    def _generations(self) -> list[tuple[int, int]]:
        files, here = _files(self.spark, self.folder)
        if not files.exists(here):
            return []
        found = []
        for status in files.listStatus(here):
            path = status.getPath().toString()
            if (m := _GENERATION.search(path)) and files.exists(_files(self.spark, f"{path}/_SUCCESS")[1]):
                found.append((int(m[1]), int(m[2])))
        return found

    def _path(self, number: int, buckets: int) -> str:
        return f"{self.folder}/g{number:06d}-b{buckets}"

    def _registered(self, number: int, buckets: int) -> str:
        """The name of a generation in the session's catalog, which only knows its folder and buckets."""
        path = self._path(number, buckets)
        name = f"sales_keys_{hashlib.md5(path.encode()).hexdigest()}"
        kinds = ", ".join(f"{k} {SALES[k].dataType.simpleString()}" for k in SALES_KEY)
        keys = ", ".join(SALES_KEY)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({kinds}, batch_id string) USING parquet "
            f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def stored(self, without: str | None = None) -> DataFrame:
        """Keys with their batches; a batch that is repeated does not meet its own."""
        rows = self.spark.table(self.name)
        return rows if without is None else rows.filter(F.col("batch_id") != F.lit(without))

    def _insert(self, rows: DataFrame, name: str, buckets: int) -> None:
        rows.repartition(buckets, *SALES_KEY).write.insertInto(name)

    def add(self, sales: DataFrame, batch: str) -> None:
        """Store the keys of sales that have a whole one."""
        rows = sales.select(*SALES_KEY).dropna().withColumn("batch_id", F.lit(batch))
        self._insert(rows, self.name, self.buckets)
        self.spark.catalog.refreshTable(self.name)

    def compact(self, buckets: int | None = None) -> None:
        """One row a key, whose batch is the first by name; batches in work must have ended."""
        number, buckets = self.number + 1, buckets or self.buckets
        name = self._registered(number, buckets)
        self._insert(self.stored().groupBy(*SALES_KEY).agg(F.min("batch_id").alias("batch_id")), name, buckets)
        old = self._path(self.number, self.buckets)
        self.spark.sql(f"DROP TABLE {self.name}")
        self.number, self.buckets, self.name = number, buckets, name
        files, gone = _files(self.spark, old)
        files.delete(gone, True)
