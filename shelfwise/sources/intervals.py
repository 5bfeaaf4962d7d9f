"""Daily stock kept as its changes; any day's snapshot is rebuilt from them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.sizes import Scratch, free_shuffles
from shelfwise.operators.merges import STOCK_KEY
from shelfwise.sources.storage import _files, conform, read_table, table_path, write_day

VALUES = ["qty", "unit_cost", "unit_price", "stock_tag"]
#: days after which a whole snapshot is kept as well, so that a day is rebuilt from so many days' changes at most
BASE_DAYS = 30


class SnapshotHistory:
    """Snapshots of stock as rows that changed.

    ``stock_changes`` has, a partition a day, the items that came, changed or went (``gone``)
    since the day that was stored before; ``stock_bases`` whole snapshots of some days. A
    snapshot is the last base before it and the newest change of each item since. To store
    a day again replaces it; days are stored in their order.
    """

    def __init__(self, spark: SparkSession, root: str, base_days: int = BASE_DAYS) -> None:
        self.spark, self.root, self.base_days = spark, root, base_days

    def _stored(self, name: str, by: dt.date) -> list[dt.date]:
        files, here = _files(self.spark, table_path(self.root, name))
        names = [s.getPath().getName() for s in files.listStatus(here)] if files.exists(here) else []
        days = [dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith("snapshot_date=")]
        return sorted(d for d in days if d <= by)

    def _since(self, first: dt.date, last: dt.date) -> DataFrame:
        """The base before the first day and all changes from there to the last one; other days are not read."""
        bases = self._stored("stock_bases", first)
        base = bases[-1] if bases else dt.date(1900, 1, 1)
        day = F.col("snapshot_date")
        whole = read_table(self.spark, self.root, "stock_bases").filter(day == F.lit(base))
        changes = read_table(self.spark, self.root, "stock_changes").filter((day > F.lit(base)) & (day <= F.lit(last)))
        return whole.withColumn("gone", F.lit(False)).unionByName(changes)

    def as_of(self, day: dt.date) -> DataFrame:
        """The snapshot of a day, or of the last one that was stored before it."""
        row = F.struct(*VALUES, "gone")
        newest = self._since(day, day).groupBy(*STOCK_KEY).agg(F.max_by(row, "snapshot_date").alias("r"))
        return newest.filter("NOT r.gone").select(*STOCK_KEY, *(F.col(f"r.{v}").alias(v) for v in VALUES))

    def store(self, day: dt.date, snapshot: DataFrame) -> int:
        """Keep what a day's whole snapshot (one row an item) changes; the number of changes."""
        before = day - dt.timedelta(days=1)
        bases = [d for d in self._stored("stock_bases", day) if d < day]
        due = not bases or (day - bases[-1]).days >= self.base_days
        today = conform(snapshot.select(*STOCK_KEY, *VALUES).withColumns({"snapshot_date": F.lit(day), "gone": F.lit(False)}), "stock_changes")
        with Scratch(self.spark) as scratch:
            now = scratch.keep(today) if due else today  # read twice then
            # one shuffle for what is stored and what is new: each row beside the one before it of its item
            order = Window.partitionBy(*STOCK_KEY).orderBy("snapshot_date")
            last = F.lag(F.struct(*VALUES, "gone")).over(order)
            both = self._since(before, before).unionByName(now).sortWithinPartitions(*STOCK_KEY)  # sorted, they shuffle as fewer bytes
            rows = both.withColumns({"last": last, "next": F.lead("snapshot_date").over(order)})
            new = F.col("snapshot_date") == F.lit(day)
            came = new & ~F.struct(*VALUES, "gone").eqNullSafe(F.col("last"))
            went = ~new & F.col("next").isNull() & ~F.col("gone")
            rows = rows.filter(came | went).select(
                F.lit(day).alias("snapshot_date"),
                *STOCK_KEY,
                *(F.when(new, F.col(v)).alias(v) for v in VALUES),
                (~new).alias("gone"),
            )
            written = write_day(rows, self.root, "stock_changes", day)  # reads earlier days only
            if due:
                write_day(now.drop("gone"), self.root, "stock_bases", day)
        free_shuffles(self.spark)
        return written

    def intervals(self, first: dt.date, last: dt.date) -> DataFrame:
        """Items with their values and the days, from valid_from up to but not on valid_to, that they held within a period."""
        order = Window.partitionBy(*STOCK_KEY).orderBy("snapshot_date")
        rows = self._since(first, last).withColumn("valid_to", F.lead("snapshot_date").over(order))
        rows = rows.filter("NOT gone").withColumnRenamed("snapshot_date", "valid_from")
        return rows.select(*STOCK_KEY, *VALUES, "valid_from", F.coalesce("valid_to", F.lit(last + dt.timedelta(days=1))).alias("valid_to"))

    def days(self, days: list[dt.date]) -> DataFrame:
        """The snapshots of some days as ``stock_daily`` has them; each interval gives the days that lie in it."""
        held = self.intervals(min(days), max(days))
        inside: list[Column] = [
            F.when((F.col("valid_from") <= F.lit(d)) & (F.lit(d) < F.col("valid_to")), F.lit(d)) for d in sorted(days)
        ]
        on = reduce(lambda a, b: F.concat(a, b), [F.array(x) for x in inside])
        rows = held.select(F.explode(F.filter(on, lambda x: x.isNotNull())).alias("snapshot_date"), *STOCK_KEY, *VALUES)
        return rows
