"""Recurring ingest as Structured Streaming: new files since the last run, then stop."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.sizes import Scratch, free_shuffles
from shelfwise.plans.load import (
    SALES_TAG,
    STOCK_TAG,
    keep_bad_payloads,
    load_sales,
    load_stock,
    sales_records,
    stock_records,
)
from shelfwise.sources.pages import page_gaps, page_records, split_complete
from shelfwise.sources.payloads import SALES_ENVELOPE, stream_payloads
from shelfwise.sources.storage import _files, table_path


def _run(stream: DataFrame, handle: Callable[[DataFrame, str], object], checkpoint: str) -> StreamingQuery:
    """Hand every new file to ``handle`` once per batch, until no file is left.

    A batch repeated after a failure replaces what it has stored and put into quarantine before.
    Its name holds that of the stream, so that two streams may feed one table.
    """
    stream_name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    return (
        stream.writeStream.foreachBatch(lambda batch, number: handle(batch, f"{stream_name}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _with_held(batch: DataFrame, root: str, name: str, page_size: int) -> DataFrame:
    """Pages of whole feeds among the batch and what the batches before held back; the rest is held on.

    What is held after a batch has a folder of the batch's name, formed of the one before, so a
    repeated batch finds what it has found at first.
    """
    spark = batch.sparkSession
    stream, _, number = name.rpartition("-")
    folder = f"{table_path(root, 'held_pages')}/{stream}"
    files, before = _files(spark, f"{folder}/{int(number) - 1}")
    rows = batch
    if files.exists(before):
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(before.toString()))
    with Scratch(spark) as scratch:
        kept = scratch.keep(rows)
        gaps = scratch.keep(page_gaps(page_records(kept, SALES_TAG, SALES_ENVELOPE), page_size))
        whole, waiting = split_complete(kept, gaps)
        waiting.write.mode("overwrite").parquet(f"{folder}/{number}")
        whole.write.mode("overwrite").parquet(f"{folder}/whole-{number}")
    return spark.read.schema(batch.schema).parquet(f"{folder}/whole-{number}")


def ingest_sales(
    spark: SparkSession, landing: str, root: str, checkpoint: str, max_files: int = 1000, page_size: int | None = None
) -> StreamingQuery:
    """With a page size, pages of a feed wait until all of them have come, over any number of batches."""

    def handle(batch: DataFrame, name: str) -> None:
        if page_size:
            batch = _with_held(batch, root, name, page_size)
        keep_bad_payloads(batch, root, "sales", SALES_TAG, name)
        load_sales(batch.sparkSession, root, sales_records(batch), batch=name)
        free_shuffles(batch.sparkSession)

    return _run(stream_payloads(spark, landing, max_files), handle, checkpoint)


def ingest_stock(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    day: dt.date,
    max_files: int = 1000,
) -> StreamingQuery:
    def handle(batch: DataFrame, name: str) -> None:
        keep_bad_payloads(batch, root, "stock", STOCK_TAG, name)
        load_stock(batch.sparkSession, root, stock_records(batch), day, batch=name)
        free_shuffles(batch.sparkSession)

    return _run(stream_payloads(spark, landing, max_files), handle, checkpoint)


def forget_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Take back the commit of a stream's last batch, as if the driver had been lost before it: it is repeated."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().isdigit()]
    if names:
        files.delete(max(names, key=lambda p: int(p.getName())), False)
