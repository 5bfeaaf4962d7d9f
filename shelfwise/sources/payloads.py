"""Landed source payloads: text files to JSON records, with built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.bind import let

#: object keys that may hold the record list, in the order they are tried (fixed values)
SALES_ENVELOPE = ("ventas", "data", "resultado")
STOCK_ENVELOPE = ("inventario", "data", "resultado")

PAGE_SIZE = 1000
MAX_PAGES = 100
#: different characters written by their number that are replaced a pass each
FEW_ENTITIES = 32


def _landed(raw: DataFrame) -> DataFrame:
    """One row per file: its path, the last number in its name as page, its text."""
    source = F.col("_metadata.file_path")
    name = F.element_at(F.split(source, "/"), -1)
    page = F.regexp_extract(name, r"(\d+)(?=\D*$)", 1)
    return raw.select(
        source.alias("source"),
        F.coalesce(page.try_cast("long"), F.lit(0)).alias("page"),
        F.col("value").alias("body"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return _landed(spark.read.text(path, wholetext=True))


def stream_payloads(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same as a stream; a batch takes at most max_files files, the rest wait."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return _landed(reader.text(path, wholetext=True))


def _xml_text(body: Column, tag: str) -> Column:
    """Text of the first element whose name contains tag, entities decoded."""
    element = rf"(?s)<[^<>/!?\s]*{tag}[^<>/\s]*(?:\s[^<>]*)?>\s*(?:<!\[CDATA\[)?([^<]+)"
    text = F.regexp_extract(body, element, 1)
    text = F.regexp_replace(text, r"\]\]>?\s*$", "]")
    text = _numeric_entities(text)
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{entity};"), F.lit(char))
    return let(F.trim(text), lambda t: F.when(t != "", t))


def _numeric_entities(text: Column) -> Column:
    """Characters written by their number, decimal or hexadecimal; others stay as they are.

    Few different ones are replaced throughout the text, each in one pass. What could become part of
    another one (digits, letters, ``&``, ``#`` and ``;``) is replaced one by one in what is left, as
    are all of a text with many different ones.
    """

    def char_of(part: Column) -> Column:
        hexadecimal = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        decimal = F.conv(F.regexp_extract(part, r"^([0-9]{1,7});", 1), 10, 16)
        code = F.lpad(F.when(hexadecimal != "", hexadecimal).otherwise(decimal), 8, "0")
        return F.decode(F.unhex(code), "UTF-32")

    def one(part: Column) -> Column:
        known = part.rlike(r"^([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});")
        return F.when(known, F.concat(char_of(part), F.regexp_replace(part, "(?s)^[^;]*;", ""))).otherwise(
            F.concat(F.lit("&#"), part)
        )

    def decoded(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one)
        return F.concat(F.get(parts, 0), F.array_join(rest, ""))

    def throughout(value: Column, part: Column) -> Column:
        def replaced(char: Column) -> Column:
            return F.when(char.rlike("[0-9A-Za-z&#;]"), value).otherwise(F.replace(value, F.concat(F.lit("&#"), part), char))

        return let(char_of(part), replaced)

    def each(value: Column) -> Column:
        parts = F.regexp_extract_all(value, F.lit(r"&#([xX][0-9a-fA-F]{1,6};|[0-9]{1,7};)"), F.lit(1))
        few = lambda p: F.when(F.size(p) <= FEW_ENTITIES, F.aggregate(p, value, throughout)).otherwise(value)
        return let(F.array_distinct(parts), few)

    def rest(value: Column) -> Column:
        return F.when(F.contains(value, F.lit("&#")), let(F.split(value, "&#"), decoded)).otherwise(value)

    return let(text, lambda t: F.when(F.contains(t, F.lit("&#")), let(let(t, each), rest)).otherwise(t))


def _is_json(text: Column) -> Column:
    """An array or an object, of any size; keys may be repeated. NaN and infinities are no JSON.

    Both functions read on to the end of the text and keep nothing of it.
    """
    return F.json_array_length(text).isNotNull() | F.json_object_keys(text).isNotNull()


def decode(landed: DataFrame, result_tag: str) -> DataFrame:
    """Find the JSON in each payload.

    First choice is the text from the first ``[{`` to the last ``}]``. If that
    is missing or no JSON, the XML element named by result_tag is decoded.
    ``status`` is ok, raw (an element that holds no JSON) or error.
    """
    span = F.nullif(F.regexp_extract("body", r"(?s)(\[\{.*\}\])", 1), F.lit(""))
    element = _xml_text(F.col("body"), result_tag)

    def result(payload: Column, status: str) -> Column:
        return F.struct(payload.cast("string").alias("payload"), F.lit(status).alias("status"))

    def judge(first: Column) -> Column:
        def second(text: Column) -> Column:
            failed = F.when(first.isNotNull() | text.isNotNull(), result(F.lit(None), "raw")).otherwise(
                result(F.lit(None), "error")
            )
            return F.when(_is_json(text), result(text, "ok")).otherwise(failed)

        # the element is looked for only where it is needed
        return F.when(_is_json(first), result(first, "ok")).otherwise(let(element, second))

    return landed.withColumn("found", let(span, judge)).select(
        "source", "page", "body", "found.payload", "found.status"
    )


def record_lists(decoded: DataFrame, envelope: Sequence[str]) -> DataFrame:
    """Add ``records``: the JSON list itself, or the list under the first envelope key present.

    Unknown forms and empty lists give NULL.
    """
    names = F.array(*(F.lit(k) for k in envelope))

    def unwrap(payload: Column) -> Column:
        def under(keys: Column) -> Column:
            present = F.filter(names, lambda k: F.array_contains(keys, k))
            path = F.concat(F.lit("$."), F.get(present, 0))
            return F.call_function("get_json_object", payload, path)

        nested = let(F.json_object_keys(payload), under)
        return F.when(F.ltrim(payload).startswith("["), payload).otherwise(nested)

    return decoded.withColumn("records", let(F.col("payload"), unwrap))


def quarantine(decoded: DataFrame) -> DataFrame:
    """Payloads that could not be decoded, whole, for inspection."""
    return decoded.filter(F.col("status") != "ok").select("source", "page", "status", "body")


def page_report(
    records_per_page: DataFrame, page_size: int = PAGE_SIZE, max_pages: int = MAX_PAGES
) -> DataFrame:
    """Is a paged extraction complete? All pages but the last full, the last one short.

    ``records_per_page`` has page and records, with 0 for empty pages. One row
    comes out: pages, records, complete, and whether the page limit was reached.
    """
    pages = records_per_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("records").alias("records"),
        F.max("page").alias("last_page"),
        F.min("page").alias("first_page"),
        F.count_if(F.col("records") < page_size).alias("short_pages"),
        F.max_by("records", "page").alias("last_records"),
    )
    contiguous = F.col("last_page") - F.col("first_page") + 1 == F.col("pages")
    last_short = F.col("last_records") < page_size
    return pages.select(
        "pages",
        "records",
        (contiguous & last_short & (F.col("short_pages") == 1)).alias("complete"),
        ((F.col("pages") >= max_pages) & ~last_short).alias("hit_page_limit"),
    )
