"""The corpus pipeline: stages that each read what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import linededup, minhash, mixing, packing, quality
from shelfwise.llm.common import Work, fresh, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or are robust outliers of their language and source go.

    Null, empty and short texts fail; rows equal in id and text are judged alike; null
    languages and sources are groups of their own.
    """
    return quality.drop_rejected(docs, Work(spark))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, all but one each; documents of which nothing is left go too.

    A column n_chars is set to the new length of the text. Null and empty texts stay as they
    are; rows equal in id and text are one document and lose the same lines.
    """
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    found = linededup.without_recurring_lines(docs, Work(spark))
    emptied = (F.col(n_dropped) > 0) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) == 0)
    left = found.filter(~F.coalesce(emptied, F.lit(False))).drop(n_lines, n_dropped)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id (null ids last).

    Documents without words all stay; of rows equal in id and text one stays.
    """
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its coin say; some not at all.

    Null texts have no words, a null source is one of its own, the last; rows equal in id and text
    have the same coin.
    """
    return mixing.mix(docs, Work(spark))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and its place there.

    A null or empty text is the end id alone; repeated rows are documents of their own.
    """
    return packing.packed_places(docs, Work(spark))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: robust estimates, signatures and packing are searches, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written before the next reads them."""
    docs, work = table(spark, sf_dir, "documents"), Work(spark)
    for _, stage in STAGES:
        before, docs = docs, work.keep(stage(spark, docs, sf_dir))
        work.drop(before)
    return docs
