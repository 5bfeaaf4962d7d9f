"""Back-load of history in slices that are committed one by one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.sizes import Scratch, free_shuffles
from shelfwise.plans import load
from shelfwise.sources.calendar import slice_start, week_ranges
from shelfwise.sources.storage import read_table, replace_partitions

DONE, FAILED = "done", "failed"
#: partitions that the records of all slices are dealt to, at most
MOST_PARTS = 512


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """start_date, end_date, status, loaded, products, errors and message of the slices so far."""
    return read_table(spark, root, "backload_slices")


def _between(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    return outcomes(spark, root).filter(F.col("start_date").between(F.lit(first), F.lit(last)))


def back_load(spark: SparkSession, root: str, records: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Load the records of a period week by week; the outcome of each slice.

    A slice that is done is not loaded again, unless the period now ends later within it. One that fails is noted with its message, and the
    others go on; the next call does it again. A slice is a batch of its own, so one that
    was cut short half-way stores its rows once. ``loaded`` counts the rows that were stored,
    ``errors`` the records that went to quarantine. Records of the slices that are to be done are
    parsed once and dealt by slice, if there are any; those without a readable date belong to none.
    """
    known = outcomes(spark, root).filter(F.col("status") == DONE)
    done = {(r["start_date"], r["end_date"]) for r in known.collect()}
    slices = [(r["start_date"], r["end_date"]) for r in week_ranges(spark, first, last).orderBy("start_date").collect()]
    to_do = [s for s in slices if s not in done]
    if not to_do:
        return _between(spark, root, first, last)
    day = F.col("FECHA").try_cast("date")
    inside = records.filter(day.between(F.lit(first), F.lit(last))).withColumn("slice", slice_start(day, first))
    inside = inside.filter(F.col("slice").isin([start for start, _ in to_do]))
    with Scratch(spark) as scratch:
        # a folder a slice: the code that reads one is the same for all; a slice has work for all cores
        cores = spark.sparkContext.defaultParallelism
        parts = max(cores, min(len(to_do) * cores, MOST_PARTS))
        dealt = scratch.keep(inside.repartition(parts, "slice", F.pmod(F.xxhash64("seq"), F.lit(cores))), by="slice")
        for start, end in to_do:
            part = dealt.filter(F.col("slice") == F.lit(start)).drop("slice")
            try:
                got = load.load_sales(spark, root, part, start, end, batch=f"slice-{start.isoformat()}", kept=True)
                row = (DONE, got["inserted"], got["products"], got["quarantined"], None)
            except Exception as e:  # noqa: BLE001  whatever it was is noted, and the slice is done again
                row = (FAILED, 0, 0, 0, str(e)[:1000])
            noted = spark.range(1).select(
                F.lit(start).alias("start_date"),
                F.lit(end).alias("end_date"),
                *(
                    F.lit(v).cast(kind).alias(name)
                    for v, (name, kind) in zip(
                        row,
                        [("status", "string"), ("loaded", "long"), ("products", "long"), ("errors", "long"), ("message", "string")],
                        strict=True,
                    )
                ),
            )
            replace_partitions(noted, root, "backload_slices")
            free_shuffles(spark)
    return _between(spark, root, first, last)
