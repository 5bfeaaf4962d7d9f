"""Stock alerts. All rules over metrics are evaluated in one pass."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import days_before, look_back, sales_points
from shelfwise.functions.numeric import fill, rounded, text_of
from shelfwise.params import DEFAULTS, Params

ALERT_COLUMNS = [
    "alert_type", "level", "product_id", "warehouse_id", "stock", "days_of_stock",
    "daily", "category", "abc_class", "message",
]


@dataclass(frozen=True)
class Rule:
    """When a position raises an alert, and what the alert says."""

    applies: Column
    alert_type: Column
    level: Column
    message: Column
    stock: Column
    days: Column
    daily: Column

    def entry(self) -> Column:
        fields = F.struct(
            self.alert_type.alias("alert_type"),
            self.level.alias("level"),
            self.stock.cast("decimal(15,5)").alias("stock"),
            self.days.cast("decimal(18,2)").alias("days_of_stock"),
            self.daily.cast("decimal(15,5)").alias("daily"),
            self.message.alias("message"),
        )
        return F.when(self.applies, fields)


def _on_metrics(applies, alert_type, level, message) -> Rule:
    has_stock = (F.col("stock") > 0) & F.col("in_catalog")
    return Rule(
        has_stock & applies, alert_type, level, message,
        F.col("stock"), F.col("days_of_stock"), F.col("daily"),
    )


def rules(p: Params = DEFAULTS) -> dict[str, Rule]:
    """The alert rules, on columns of ``stock_position`` (or stored metrics with dimensions)."""
    days, daily = F.col("days_of_stock"), F.col("daily")
    q90, q30 = F.col("q90"), F.col("q30")
    cover = F.coalesce(F.col("cover_days"), F.lit(p.default_cover))
    at_sales_point = F.col("wtype") == K.SALES_POINT
    moving = daily > 0
    unsold = q90 == 0

    def band(critical: str, low: str, rest: str) -> Column:
        return (
            F.when(days < p.critical_days, critical)
            .when(days < p.low_days, low)
            .otherwise(rest)
        )

    over_base = F.col("stock_max") if p.over_level_rule == "units" else cover
    value_text = text_of(F.col("stock_value"), 0)
    low = _on_metrics(
        at_sales_point & (days < p.medium_days) & moving,
        band(K.ALERT_CRITICAL, K.ALERT_LOW, K.ALERT_MEDIUM),
        band(K.LEVEL_CRITICAL, K.LEVEL_HIGH, K.LEVEL_MEDIUM),
        fill(K.MSG_LOW, text_of(days, 1), text_of(daily, 2)),
    )
    over = _on_metrics(
        (days.cast("double") > cover * F.lit(p.over_factor)) & moving,
        F.lit(K.ALERT_OVER),
        F.when(days > over_base * 2, K.LEVEL_HIGH).otherwise(K.LEVEL_MEDIUM),
        fill(K.MSG_OVER, text_of(days, 0), cover.cast("string")),
    )
    slow = _on_metrics(
        ((q90 < p.slow_units) | (F.col("turn").cast("double") < p.slow_turn))
        & (F.col("abc_class") != "D"),
        F.lit(K.ALERT_SLOW),
        F.when(unsold, K.LEVEL_HIGH).otherwise(K.LEVEL_MEDIUM),
        F.when(unsold, fill(K.MSG_SLOW_NONE, value_text)).otherwise(
            fill(K.MSG_SLOW_SOME, text_of(q90, 5))
        ),
    )
    no_rotation = _on_metrics(
        at_sales_point & (daily == 0) & (F.col("sales_rows_30d") == 0),
        F.lit(K.ALERT_NO_ROTATION),
        F.when(unsold, K.LEVEL_HIGH).otherwise(K.LEVEL_MEDIUM),
        fill(K.MSG_NO_ROTATION, text_of(F.col("stock"), 0), value_text),
    )
    exact_daily = q30.cast("double") / p.month_days
    stockout = Rule(
        F.col("in_catalog") & at_sales_point & (q30 > 0) & (F.col("stock") == 0),
        F.lit(K.ALERT_STOCKOUT),
        F.when(q30 >= p.stockout_critical_daily * p.month_days, K.LEVEL_CRITICAL)
        .when(q30 >= p.stockout_high_daily * p.month_days, K.LEVEL_HIGH)
        .otherwise(K.LEVEL_MEDIUM),
        fill(K.MSG_STOCKOUT, text_of(exact_daily, 2), text_of(q30, 5)),
        F.lit(0), F.lit(0), rounded(exact_daily, 5),
    )
    return {
        "low": low, "over": over, "slow": slow,
        "no_rotation": no_rotation, "stockout": stockout,
    }


def alerts(position: DataFrame, kinds: list[str] | None = None, p: Params = DEFAULTS) -> DataFrame:
    """Alerts of the chosen kinds (all by default) from one pass over the positions.

    Each position yields zero or more alerts, so the union of all kinds needs
    no second read of the metrics and no further shuffle.
    """
    known = rules(p)
    chosen = [known[k] for k in (kinds or list(known))]
    keep = ["product_id", "warehouse_id", "category", "abc_class"]
    if len(chosen) == 1:
        entries = position.filter(chosen[0].applies).select(*keep, chosen[0].entry().alias("e"))
    else:
        # dropped after they are dealt out: a filter of the array is interpreted, and Spark evaluates it twice
        every = position.select(*keep, F.explode(F.array(*(r.entry() for r in chosen))).alias("e"))
        entries = every.filter(F.col("e").isNotNull())
    return entries.select(
        *[F.col(c) if c in keep else F.col(f"e.{c}").alias(c) for c in ALERT_COLUMNS]
    )


def alert_counts(alert_rows: DataFrame) -> DataFrame:
    """Alerts per kind, with the three low-stock types as one, and the total."""
    t = F.col("alert_type")
    low = t.isin(K.ALERT_CRITICAL, K.ALERT_LOW, K.ALERT_MEDIUM)
    return alert_rows.agg(
        F.count_if(low).alias("low"),
        F.count_if(t == K.ALERT_OVER).alias("over"),
        F.count_if(t == K.ALERT_SLOW).alias("slow"),
        F.count_if(t == K.ALERT_NO_ROTATION).alias("no_rotation"),
        F.count_if(t == K.ALERT_STOCKOUT).alias("stockout"),
        F.count(F.lit(1)).alias("total"),
    )


def unmoved_stock(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """No-rotation alerts straight from stock: one join with the last sale per key."""
    last = (
        look_back(sales, as_of, p.long_days)
        .groupBy("product_id", "warehouse_id")
        .agg(F.max("sale_date").alias("last_sale"))
    )
    here = sales_points(warehouses).select("warehouse_id")
    value = F.col("qty") * F.col("unit_cost")
    never = F.col("last_sale").isNull()
    return (
        stock.filter(F.col("qty") > 0)
        .join(here, "warehouse_id", "left_semi")
        .join(last, ["product_id", "warehouse_id"], "left")
        .filter(never | (F.col("last_sale") < days_before(as_of, p.month_days)))
        .select(
            F.lit(K.ALERT_NO_ROTATION).alias("alert_type"),
            F.when(never, K.LEVEL_HIGH).otherwise(K.LEVEL_MEDIUM).alias("level"),
            "product_id",
            "warehouse_id",
            F.col("qty").alias("stock"),
            F.lit(p.no_sales_days).cast("decimal(18,2)").alias("days_of_stock"),
            F.lit(0).cast("decimal(15,5)").alias("daily"),
            F.lit(None).cast("string").alias("category"),
            F.lit(None).cast("string").alias("abc_class"),
            fill(K.MSG_NO_ROTATION, text_of(F.col("qty"), 0), text_of(value, 0)).alias("message"),
        )
    )


def stamped(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Fresh rows: pending, generated on the run date."""
    return rows.withColumn("state", F.lit(K.PENDING)).withColumn("generated_on", F.lit(as_of))


def is_pending_no_rotation() -> Column:
    hit = (F.col("alert_type") == K.ALERT_NO_ROTATION) & (F.col("state") == K.PENDING)
    return F.coalesce(hit, F.lit(False))


def rebuild_no_rotation(existing: DataFrame, unmoved: DataFrame, as_of: dt.date) -> DataFrame:
    """Replace all pending no-rotation alerts, of any day, by fresh ones."""
    kept = existing.filter(~is_pending_no_rotation())
    return kept.unionByName(stamped(unmoved, as_of), allowMissingColumns=True)


def rebuild_counts(existing: DataFrame, unmoved: DataFrame) -> DataFrame:
    """How many alerts the rebuild deletes and inserts."""
    gone = existing.filter(is_pending_no_rotation()).select(F.lit(1).alias("d"), F.lit(0).alias("i"))
    new = unmoved.select(F.lit(0).alias("d"), F.lit(1).alias("i"))
    both = gone.unionByName(new)
    zero = F.lit(0)
    return both.agg(
        F.coalesce(F.sum("d"), zero).alias("deleted"),
        F.coalesce(F.sum("i"), zero).alias("inserted"),
    )
