"""Tables on disk: Parquet with declared schemas, and the sinks that replace partitions."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.sizes import Scratch
from shelfwise.operators.alerts import is_pending_no_rotation, rebuild_counts
from shelfwise.operators.alerts import rebuild_no_rotation as rebuild_rows
from shelfwise.schemas import HIDDEN, PARTITIONS, STOCK_PARTS, TABLES
from shelfwise.tables import Tables


#: of the tables' files: a third smaller than Spark's default
COMPRESSION = "zstd"


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def stock_part() -> Column:
    """The part of the stock that a warehouse lies in."""
    return F.pmod(F.xxhash64(F.col("warehouse_id").cast("string")), F.lit(STOCK_PARTS)).cast("int")


def read_table(spark: SparkSession, root: str, name: str, hidden: bool = False) -> DataFrame:
    """One table with its declared schema; a table never written reads as empty."""
    schema = TABLES[name]
    finish_replacement(spark, root, name)
    try:
        df = spark.read.schema(schema).parquet(table_path(root, name))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    df = df if hidden else df.drop(*HIDDEN.get(name, []))
    return with_total_cover(df) if name == "brands" else df


def with_total_cover(brands: DataFrame) -> DataFrame:
    """Cover plus lead time; NULL if either is."""
    return brands.withColumn("total_cover", F.col("cover_days") + F.col("dc_lead"))


def open_tables(spark: SparkSession, root: str) -> Tables:
    names = (
        "sales", "stock", "products", "brands", "warehouses", "regions",
        "warehouse_types", "stock_daily",
    )
    return Tables(**{n: read_table(spark, root, n) for n in names}).checked()


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns and types of a table; missing columns become NULL.

    Rows of a state other than pending are ``done`` and have a partition of their own; stock
    lies in parts by warehouse.
    """
    if "done" in HIDDEN.get(name, []):
        df = df.withColumn("done", ~F.coalesce(F.col("state") == K.PENDING, F.lit(False)))
    if name == "stock":
        df = df.withColumn("part", stock_part())
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[name]
        )
    )


def _writer(df: DataFrame, name: str):
    parts = PARTITIONS.get(name, [])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    return writer.partitionBy(*parts) if parts else writer


def replace_partitions(df: DataFrame, root: str, name: str, spread: bool = False) -> int:
    """Overwrite the partitions df has rows for; returns the rows written.

    Files of a partition are staged and moved when the job commits, so df may
    read the table it replaces. ``spread`` rebalances rows by partition value,
    splitting large values and merging small ones, where df holds many values.
    """
    rows = conform(df, name)
    if spread:
        rows = rows.hint("rebalance", *PARTITIONS[name])
        if name == "stock":  # filters by warehouse skip row groups
            rows = rows.sortWithinPartitions("part", "warehouse_id")
    seen = Observation()
    _writer(rows.observe(seen, F.count(F.lit(1)).alias("rows")), name).parquet(table_path(root, name))
    return seen.get["rows"]


def _files(spark: SparkSession, *paths: str):
    """The file system of a path, and the paths for it."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return found[0].getFileSystem(spark._jsc.hadoopConfiguration()), *found


def replace_table(df: DataFrame, root: str, name: str) -> None:
    """Replace an unpartitioned table; df may read the one it replaces.

    The new rows are written beside the table and take its place when they are whole. A
    job that fails leaves the old table; if the exchange itself is cut short, the next
    read or replacement ends it.
    """
    spark, path = df.sparkSession, table_path(root, name)
    conform(df, name).write.mode("overwrite").parquet(f"{path}.next")
    files, old, gone = _files(spark, path, f"{path}.old")
    files.delete(gone, True)
    if files.exists(old):
        files.rename(old, gone)
    finish_replacement(spark, root, name)
    files.delete(gone, True)


def finish_replacement(spark: SparkSession, root: str, name: str) -> None:
    """Put a whole new table in its place where the old one has gone already."""
    path = table_path(root, name)
    files, here, new, whole = _files(spark, path, f"{path}.next", f"{path}.next/_SUCCESS")
    if not files.exists(here) and files.exists(whole):
        files.rename(new, here)


def new_batch() -> str:
    """A name for a load that is not repeated."""
    return f"load-{uuid.uuid4().hex}"


def append_sales(df: DataFrame, root: str, batch: str | None = None) -> int:
    """Store sales by date and batch; files are sorted by product, so product filters skip row groups.

    What the batch has stored before goes first, so a batch that is repeated, also after
    it was cut short, leaves its rows once, those without a whole key too.
    """
    spark, seen = df.sparkSession, Observation()
    if batch:
        files, days = _files(spark, f"{table_path(root, 'sales')}/*/batch_id={batch}")
        for found in files.globStatus(days) or []:
            files.delete(found.getPath(), True)
    rows = conform(df.withColumn("batch_id", F.lit(batch or new_batch())), "sales")
    rows = rows.hint("rebalance", "sale_date").sortWithinPartitions("sale_date", "product_id")
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("append").partitionBy(*PARTITIONS["sales"]).option("compression", COMPRESSION)
    writer.parquet(table_path(root, "sales"))
    return seen.get["rows"]


def _clear_day(spark: SparkSession, root: str, name: str, day: dt.date) -> None:
    """Leave the day's partition without rows, or of a table with handled rows the pending ones' partition."""
    first, *rest = PARTITIONS[name]
    place = f"{first}={day.isoformat()}" + "".join(f"/{column}=false" for column in rest)
    empty = spark.createDataFrame([], TABLES[name]).drop(first, *rest)
    empty.write.mode("overwrite").parquet(f"{table_path(root, name)}/{place}")


def write_day(df: DataFrame, root: str, name: str, day: dt.date) -> int:
    """Replace one day's partition by df, also when df has no rows."""
    rows = replace_partitions(df, root, name)
    if rows == 0:
        _clear_day(df.sparkSession, root, name, day)
    return rows


def write_metrics(metrics: DataFrame, root: str, as_of: dt.date) -> int:
    """The day's metrics replace earlier ones of the same day."""
    return write_day(metrics, root, "metrics", as_of)


def replace_pending(fresh: DataFrame, root: str, name: str, as_of: dt.date) -> dict[str, int]:
    """Replace the day's pending rows by fresh ones; handled rows of the day stay.

    Handled rows lie in a partition that is not written here, so a run that is cut short at
    any point loses none. Returns how many rows were written per value of the type or
    priority, and in all; the counts come from the write itself.
    """
    new = fresh.withColumn("state", F.lit(K.PENDING)).withColumn("generated_on", F.lit(as_of))
    kinds = KINDS[name]
    seen = Observation()
    counted = conform(new, name).observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col(kinds[0]).isin(values)).alias(label) for label, values in kinds[1].items()),
    )
    _writer(counted, name).parquet(table_path(root, name))
    counts = dict(seen.get)
    if counts["total"] == 0:
        _clear_day(fresh.sparkSession, root, name, as_of)
    return counts


def rebuild_no_rotation(unmoved: DataFrame, root: str, as_of: dt.date) -> dict[str, int]:
    """Replace all pending no-rotation alerts, of any day, by fresh ones of a day; how many went and came.

    Only the pending partitions of the days that lose rows, and of the day, are written.
    """
    spark = unmoved.sparkSession
    with Scratch(spark) as scratch:
        stored = scratch.keep(read_table(spark, root, "alerts").filter(F.col("state") == K.PENDING))
        new = scratch.keep(unmoved)
        counts = rebuild_counts(stored, new).first().asDict()
        today = F.lit(as_of).alias("generated_on")
        days = stored.filter(is_pending_no_rotation()).select("generated_on").union(spark.range(1).select(today)).distinct()
        kept = scratch.keep(stored.join(F.broadcast(days), "generated_on", "left_semi"))
        rows = scratch.keep(rebuild_rows(kept, new, as_of))
        replace_partitions(rows, root, "alerts")
        # a day each; what they are left without is cleared
        left = rows.select("generated_on").distinct()
        for row in days.join(left, "generated_on", "left_anti").collect():
            _clear_day(spark, root, "alerts", row["generated_on"])
    return counts


KINDS = {
    "alerts": (
        "alert_type",
        {
            "low": [K.ALERT_CRITICAL, K.ALERT_LOW, K.ALERT_MEDIUM],
            "over": [K.ALERT_OVER],
            "slow": [K.ALERT_SLOW],
            "no_rotation": [K.ALERT_NO_ROTATION],
            "stockout": [K.ALERT_STOCKOUT],
        },
    ),
    "transfers": ("priority", {}),
    "purchases": ("priority", {}),
}


# --- CSV export ---------------------------------------------------------------

#: export kind -> our column and the header it gets (fixed values)
CSV_COLUMNS = {
    "alerts": [
        ("alert_type", "Tipo"), ("level", "Nivel"), ("product_id", "Referencia"),
        ("product_name", "Producto"), ("warehouse_name", "Almacén"), ("region_id", "Regional"),
        ("stock", "Stock"), ("days_of_stock", "Días Inv."), ("daily", "Venta Diaria"),
        ("state", "Estado"), ("generated_on", "Fecha"),
    ],
    "transfers": [
        ("product_id", "Referencia"), ("product_name", "Producto"), ("from_name", "Origen"),
        ("to_name", "Destino"), ("to_region", "Regional"), ("qty", "Cantidad"),
        ("days_from", "Días Origen"), ("days_to", "Días Destino"), ("priority", "Prioridad"),
        ("state", "Estado"),
    ],
    "purchases": [
        ("product_id", "Referencia"), ("product_name", "Producto"), ("brand_name", "Marca"),
        ("stock_network", "Stock Red"), ("qty", "Cant. Sugerida"),
        ("cover_now", "Cobertura Actual"), ("cover_target", "Cobertura Obj."),
        ("purchase_value", "Valor Estimado"), ("priority", "Prioridad"),
    ],
    "warehouses": [
        ("warehouse_id", "Código"), ("name", "Nombre"), ("wtype", "Tipo"),
        ("region_id", "Regional"), ("products", "Productos"), ("units", "Unidades"),
        ("stock_value", "Valor Inventario"), ("mean_days", "Días Inv. Prom."),
    ],
}
CSV_ID = "ID"
CSV_LIMIT = 500


def csv_rows(listing: DataFrame, kind: str) -> DataFrame:
    """The export columns of a list. Lists with records get an id from their key columns."""
    if kind not in CSV_COLUMNS:
        raise ValueError(f"unknown export kind: {kind}")
    columns = [F.col(c).alias(header) for c, header in CSV_COLUMNS[kind]]
    keys = {
        "alerts": ["alert_type", "product_id", "warehouse_id", "generated_on"],
        "transfers": ["product_id", "from_id", "to_id"],
        "purchases": ["product_id"],
    }.get(kind)
    if keys:
        columns.insert(0, F.xxhash64(*keys).alias(CSV_ID))
    return listing.select(*columns)


def export_csv(listing: DataFrame, kind: str, path: str) -> None:
    """Write a list as CSV: a header, every value quoted, quotes doubled, NULL empty."""
    (
        csv_rows(listing, kind)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
