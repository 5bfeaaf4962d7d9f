"""Date ranges of a load."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_DAYS = 7


def week_ranges(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Consecutive 7-day slices from first to last, the last one clipped."""
    weeks = (last - first).days // SLICE_DAYS + 1
    start = F.date_add(F.lit(first), (F.col("id") * SLICE_DAYS).cast("int"))
    end = F.least(F.date_add(start, SLICE_DAYS - 1), F.lit(last))
    return spark.range(max(weeks, 0)).select(start.alias("start_date"), end.alias("end_date"))


def weeks_of(span: DataFrame) -> DataFrame:
    """The same slices of a row with first and last day, which stays in the plan."""
    start = F.explode(F.sequence("first", "last", F.expr(f"INTERVAL {SLICE_DAYS} DAYS")))
    weeks = span.select(start.alias("start_date"), "last")
    return weeks.select("start_date", F.least(F.date_add("start_date", SLICE_DAYS - 1), "last").alias("end_date"))


def slice_start(day: Column, first: dt.date) -> Column:
    """Start of the slice a day falls in: arithmetic, so no range join is needed."""
    number = F.floor(F.datediff(day, F.lit(first)) / SLICE_DAYS)
    return F.date_add(F.lit(first), (number * SLICE_DAYS).cast("int"))


@dataclass(frozen=True)
class Load:
    """What a load takes: sales of a date window, the stock of a day, or both."""

    sales_from: dt.date | None
    sales_to: dt.date | None
    stock_date: dt.date | None


def select_load(
    today: dt.date,
    kind: str = "both",
    sales_from: dt.date | None = None,
    sales_to: dt.date | None = None,
    stock_date: dt.date | None = None,
) -> Load:
    """Defaults: yesterday's sales, today's stock."""
    if kind not in ("sales", "stock", "both"):
        raise ValueError(f"unknown load kind: {kind}")
    yesterday = today - dt.timedelta(days=1)
    sales, stock = kind != "stock", kind != "sales"
    return Load(
        (sales_from or yesterday) if sales else None,
        (sales_to or yesterday) if sales else None,
        (stock_date or today) if stock else None,
    )
