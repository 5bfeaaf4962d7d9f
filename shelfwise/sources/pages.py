"""Completeness of paged feeds: which pages are missing or short, and feeds that wait for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.sources.payloads import MAX_PAGES, PAGE_SIZE, decode, record_lists


def feed_of(source: Column) -> Column:
    """The file's name without the number of its page."""
    return F.regexp_replace(F.element_at(F.split(source, "/"), -1), r"\d+(?=\D*$)", "")


def page_records(landed: DataFrame, result_tag: str, envelope: tuple[str, ...]) -> DataFrame:
    """feed, page and the number of records of each landed page; a page without a readable list has none."""
    lists = record_lists(decode(landed, result_tag), envelope)
    count = F.coalesce(F.json_array_length("records"), F.lit(0)).cast("long")
    return lists.select(feed_of(F.col("source")).alias("feed"), "page", count.alias("records"))


def page_gaps(pages: DataFrame, page_size: int = PAGE_SIZE, max_pages: int = MAX_PAGES) -> DataFrame:
    """What a feed lacks: feed, kind, first_page, last_page; feeds that lack nothing have no row.

    Kinds: pages that are ``missing`` before another one, counted from 1; pages before the last that
    are ``short``; and ``open``, the page that must follow as the last one is full, unless the
    limit of pages is reached. A page that came twice counts once, with most records. A feed
    of a single file without a number (page 0) lacks nothing.
    """
    once = pages.groupBy("feed", "page").agg(F.max("records").alias("records")).filter("page > 0")
    # a feed has max_pages pages at most
    order = Window.partitionBy("feed").orderBy("page")
    known = once.withColumns(
        {
            "before": F.coalesce(F.lag("page").over(order), F.lit(0)),
            "after": F.lead("page").over(order),
            "number": F.row_number().over(order),
        }
    )
    last, full = F.col("after").isNull(), F.col("records") >= page_size
    gap = F.struct(F.lit("missing").alias("kind"), (F.col("before") + 1).alias("a"), (F.col("page") - 1).alias("b"))
    short = F.struct(F.lit("short").alias("kind"), F.col("page").alias("a"), F.col("page").alias("b"))
    open_ = F.struct(F.lit("open").alias("kind"), (F.col("page") + 1).alias("a"), (F.col("page") + 1).alias("b"))
    found = F.array(
        F.when(F.col("page") > F.col("before") + 1, gap),
        F.when(~last & ~full, short),
        F.when(last & full & (F.col("page") < max_pages), open_),
    )
    rows = known.select("feed", F.explode(F.filter(found, lambda g: g.isNotNull())).alias("g"))
    return rows.select("feed", "g.kind", F.col("g.a").alias("first_page"), F.col("g.b").alias("last_page"))


def split_complete(landed: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed pages of the feeds that lack nothing, and those of the others."""
    named = landed.withColumn("feed", feed_of(F.col("source")))
    waiting = gaps.select("feed").distinct()
    return named.join(waiting, "feed", "left_anti").drop("feed"), named.join(waiting, "feed", "left_semi").drop("feed")
