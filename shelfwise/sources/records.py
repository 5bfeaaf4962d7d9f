"""Source records to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- source field names -> our columns (fixed values) ---
SALES_TEXT = {
    "TIPMOV": "doc_type", "PREFIJO": "doc_prefix", "NUMDOC": "doc_no", "HORA": "sale_time",
    "CEDULA": "customer_id", "NOMCED": "customer_name", "CODSEC": "section_id",
    "NOMSEC": "section_name", "BODEGA": "warehouse_id", "REFER": "product_id",
    "VENDED": "seller_id", "NOMVEN": "seller_name",
}
SALES_NUMBERS = {
    "CANTID": ("qty", "decimal(15,5)"),
    "VALUND": ("unit_price", "decimal(15,5)"),
    "VALTOT": ("amount", "decimal(15,5)"),
    "PORDES": ("discount_pct", "decimal(10,5)"),
    "VALDES": ("discount", "decimal(15,5)"),
    "VCOSTO": ("cost", "decimal(15,5)"),
    "VALUTI": ("margin", "decimal(15,5)"),
    "PORUTI": ("margin_pct", "decimal(10,5)"),
    "PORIVA": ("tax_pct", "decimal(5,2)"),
}
STOCK_NUMBERS = {
    "CANTIDAD": ("qty", "decimal(15,5)"),
    "VCOSTO": ("unit_cost", "decimal(15,5)"),
    "VVENTA": ("unit_price", "decimal(15,5)"),
}
PRODUCT_FIELDS = (
    "REFERENCIA", "REFER", "CODIGO", "NOMBRE", "NOMREF", "UNIDADMED", "UNDMED",
    "CLASE", "GRUPO", "LINEA", "MARCA",
)


def _fields(*groups) -> T.StructType:
    names: list[str] = []
    for group in groups:
        names += [n for n in group if n not in names]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SALES_RECORD = _fields(SALES_TEXT, ["FECHA"], SALES_NUMBERS, PRODUCT_FIELDS)
STOCK_RECORD = _fields(["BODEGA", "REFERENCIA", "OBSERV1"], STOCK_NUMBERS, PRODUCT_FIELDS)


def explode_records(lists: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per record, all fields as text, with its place in the feed.

    ``seq`` orders records over all files: page, file, position.
    """
    parsed = F.from_json("records", T.ArrayType(schema))
    # outer: the plain form makes the optimizer parse a second time, in a filter
    rows = lists.select("source", "page", F.posexplode_outer(parsed).alias("pos", "r"))
    return rows.filter(F.col("r").isNotNull()).select(
        F.struct("page", "source", "pos").alias("seq"), "r.*"
    )


def _bad_numbers(numbers: dict) -> Column:
    """True if a present number does not fit its type."""
    bad = F.lit(False)
    for field, (_, dtype) in numbers.items():
        col = F.col(field)
        bad = bad | (col.isNotNull() & col.try_cast(dtype).isNull())
    return bad


def _numbers(numbers: dict) -> list[Column]:
    """Typed numbers; absent, null and unreadable ones are 0."""
    return [
        F.coalesce(F.col(field).try_cast(dtype), F.lit(0).cast(dtype)).alias(name)
        for field, (name, dtype) in numbers.items()
    ]


def bad_sales(records: DataFrame) -> DataFrame:
    """Records for quarantine: unreadable numbers or no sale date."""
    return records.filter(_bad_numbers(SALES_NUMBERS) | F.col("FECHA").try_cast("date").isNull())


def sales_rows(records: DataFrame) -> DataFrame:
    """Typed sales. Records without a date are not rows; see ``bad_sales``."""
    day = F.col("FECHA").try_cast("date")
    return records.filter(day.isNotNull()).select(
        "seq",
        day.alias("sale_date"),
        *(F.col(field).alias(name) for field, name in SALES_TEXT.items()),
        *_numbers(SALES_NUMBERS),
    )


def bad_stock(records: DataFrame) -> DataFrame:
    no_key = F.col("BODEGA").isNull() | F.col("REFERENCIA").isNull()
    return records.filter(_bad_numbers(STOCK_NUMBERS) | no_key)


def stock_rows(records: DataFrame) -> DataFrame:
    """Typed stock rows; a blank remark is no tag. Rows without a key are left out."""
    keyed = records.filter(F.col("BODEGA").isNotNull() & F.col("REFERENCIA").isNotNull())
    return keyed.select(
        "seq",
        F.col("BODEGA").alias("warehouse_id"),
        F.col("REFERENCIA").alias("product_id"),
        *_numbers(STOCK_NUMBERS),
        F.nullif(F.trim("OBSERV1"), F.lit("")).alias("stock_tag"),
    )


def _first_filled(*fields: str) -> Column:
    """The first field, unless it is missing or empty; the last one is taken as it is."""
    tests = [F.nullif(F.col(f), F.lit("")) for f in fields[:-1]]
    return F.coalesce(*tests, F.col(fields[-1]))


def product_rows(records: DataFrame, key_field: str) -> DataFrame:
    """Distinct products of a batch: the last record of each key wins.

    An aggregate, not a window, so a product on very many records is reduced
    on the map side. Records without a key are dropped.
    """
    row = F.struct(
        _first_filled("REFERENCIA", "REFER").alias("product_id"),
        F.col("CODIGO").alias("code"),
        _first_filled("NOMBRE", "NOMREF").alias("name"),
        _first_filled("UNIDADMED", "UNDMED").alias("uom"),
        F.col("CLASE").alias("product_class"),
        F.col("GRUPO").alias("product_group"),
        F.col("LINEA").alias("product_line"),
        F.col("MARCA").alias("source_brand"),
    )
    key = F.col(key_field)
    return (
        records.filter(F.coalesce(key, F.lit("")) != "")
        .groupBy(key.alias("k"))
        .agg(F.max_by(row, "seq").alias("p"))
        .select("p.*")
    )
