"""Look-back sums that move on by a day: what comes is added, what leaves is taken off."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.filters import sales_points
from shelfwise.operators.metrics import KEY
from shelfwise.params import DEFAULTS, Params
from shelfwise.sources.storage import _clear_day, _files, read_table, replace_partitions, table_path

SUMS = ["q7", "q30", "q90", "sales_rows_30d", "sales_rows_90d"]


def _days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


class RollingSales:
    """Sums of the three look-backs per product and warehouse.

    ``daily_sums`` has the sums of each day, ``rolling_sums`` those of the look-backs at a
    day that is closed, ``lag`` days before the last one. The sums of a later day are
    those, plus the days since, minus the days that have left each look-back: moved on by
    one day, four days' sums are read in place of all sales of three months. Loads mark the
    days that they bring rows for (``mark``); their sums are formed anew, and if one of them
    was closed, the look-backs are formed anew from the daily sums.
    """

    def __init__(self, spark: SparkSession, root: str, lag: int = 2, p: Params = DEFAULTS) -> None:
        self.spark, self.root, self.lag, self.p = spark, root, lag, p
        #: for each sum, its source among the daily ones and the days it looks back
        self.windows = {
            "q7": ("units", p.short_days), "q30": ("units", p.month_days), "q90": ("units", p.long_days),
            "sales_rows_30d": ("sales_rows", p.month_days), "sales_rows_90d": ("sales_rows", p.long_days),
        }

    def _marks(self) -> str:
        return table_path(self.root, "marked_days")

    @staticmethod
    def mark(sales: DataFrame, root: str, batch: str) -> None:
        """Note the days of a batch of sales that was stored; a repeated batch notes them again."""
        days = sales.select("sale_date").distinct().coalesce(1)
        days.write.mode("overwrite").parquet(f"{table_path(root, 'marked_days')}/batch_id={batch}")

    def _marked(self) -> tuple[list, list[dt.date]]:
        """Marks and the days they name; a row a day."""
        files, here = _files(self.spark, self._marks())
        found = [s.getPath() for s in files.listStatus(here) if s.isDirectory()] if files.exists(here) else []
        if not found:
            return [], []
        rows = self.spark.read.schema("sale_date date").parquet(*(p.toString() for p in found))
        return found, sorted(r["sale_date"] for r in rows.distinct().collect())

    def sum_days(self, days: list[dt.date]) -> None:
        """Form the sums of some days anew from their sales, also of days that have none left."""
        sold = read_table(self.spark, self.root, "sales").filter(F.col("sale_date").isin(days))
        sums = sold.groupBy("sale_date", *KEY).agg(
            F.coalesce(F.sum("qty"), F.lit(0)).alias("units"), F.count(F.lit(1)).alias("sales_rows")
        )
        replace_partitions(sums, self.root, "daily_sums", spread=True)
        left = {r["sale_date"] for r in sold.select("sale_date").distinct().collect()}  # a row a day
        for day in set(days) - left:
            _clear_day(self.spark, self.root, "daily_sums", day)

    def _closed(self, by: dt.date) -> dt.date | None:
        """The last closed day that is not after a day; a partition a day."""
        files, here = _files(self.spark, table_path(self.root, "rolling_sums"))
        names = [s.getPath().getName() for s in files.listStatus(here)] if files.exists(here) else []
        days = [dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith("as_of=")]
        return max((d for d in days if d <= by), default=None)

    def _of_days(self, days: dict[str, list[dt.date]], sign: int) -> DataFrame:
        """Daily sums of the days named for each sum, with a sign; only their partitions are read."""
        wanted = sorted(set().union(*days.values()))
        rows = read_table(self.spark, self.root, "daily_sums").filter(F.col("sale_date").isin(wanted))
        return rows.select(
            *KEY,
            *(
                F.when(F.col("sale_date").isin(days[name]), F.lit(sign) * F.col(source)).otherwise(0).alias(name)
                for name, (source, _) in self.windows.items()
            ),
        )

    def _added(self, parts: list[DataFrame]) -> DataFrame:
        both = reduce(DataFrame.unionByName, parts)
        sums = both.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS))
        return sums.filter(F.col("sales_rows_90d") > 0)

    def sums(self, as_of: dt.date) -> DataFrame:
        """The look-backs at a day, from the last closed one before it or, without one, from the daily sums."""
        since = self._closed(as_of)
        if since is None or (as_of - since).days > self.p.short_days:
            every = {n: _days(as_of - dt.timedelta(days=w), as_of) for n, (_, w) in self.windows.items()}
            return self._added([self._of_days(every, 1)])
        stored = read_table(self.spark, self.root, "rolling_sums").filter(F.col("as_of") == F.lit(since))
        parts = [stored.select(*KEY, *SUMS)]
        if since < as_of:
            one = dt.timedelta(days=1)
            come = {n: _days(since + one, as_of) for n in SUMS}
            gone = {
                n: _days(since - dt.timedelta(days=w), as_of - dt.timedelta(days=w + 1)) for n, (_, w) in self.windows.items()
            }
            parts += [self._of_days(come, 1), self._of_days(gone, -1)]
        return self._added(parts)

    def move_to(self, as_of: dt.date) -> None:
        """Take in what loads have brought, and close the day ``lag`` days before.

        Every step leaves tables that hold without the next one, and marks go last, so
        a run that is cut short is done by the next.
        """
        marks, days = self._marked()
        files = _files(self.spark, self._marks())[0]
        closed = self._closed(dt.date.max)
        if closed is not None and days and days[0] <= closed:  # what was closed did not have these rows
            gone = _files(self.spark, table_path(self.root, "rolling_sums"))
            gone[0].delete(gone[1], True)
        if days:
            self.sum_days(days)
        day = as_of - dt.timedelta(days=self.lag)
        if self._closed(day) != day:
            rows = self.sums(day).withColumn("as_of", F.lit(day))
            replace_partitions(rows, self.root, "rolling_sums")
        for mark in marks:
            files.delete(mark, True)

    def lookback(self, as_of: dt.date, warehouses: DataFrame) -> DataFrame:
        """As ``metrics.sales_lookback``, without the sales."""
        here = sales_points(warehouses).select("warehouse_id")
        return self.sums(as_of).join(here, "warehouse_id", "left_semi").select(*KEY, *SUMS[:4])
