"""Inverted index of product texts by three characters: a search reads the postings of its text only."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.reports import product_search
from shelfwise.sources.storage import table_path

GRAM = 3
#: partitions of the postings, by a hash of the characters
BUCKETS = 64
_SCHEMA = "gram string, product string, bucket int"


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _fields() -> list[Column]:
    """What a search looks at, as it does."""
    return [F.lower(F.col(c).cast("string")) for c in ("name", "product_id", "code")]


def postings(products: DataFrame) -> DataFrame:
    """gram, product and bucket: every three neighbouring characters of a product's texts, once."""

    def grams(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
        cut = F.transform(places, lambda i: F.substr(text, i, F.lit(GRAM)))
        return F.when(F.length(text) >= GRAM, cut).otherwise(F.array().cast("array<string>"))

    every = F.array_distinct(F.concat(*(F.coalesce(grams(f), F.array().cast("array<string>")) for f in _fields())))
    rows = products.select(F.col("product_id").cast("string").alias("product"), F.explode(every).alias("gram"))
    return rows.select("gram", "product", _bucket(F.col("gram")).alias("bucket"))


def grams_of(query: str) -> list[str]:
    """Three neighbouring characters that a text must have to match; none between wildcards that are nearer."""
    literal = re.split("[%_]", query.lower())
    return sorted({part[i : i + GRAM] for part in literal for i in range(len(part) - GRAM + 1)})


class NameIndex:
    """Postings of products under root, by hash of the characters; a partition's files are sorted by them.

    Postings are only added. One that no longer holds costs a candidate that the search
    itself turns down, so a product that changes needs no deletion.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, table_path(root, "product_trigrams")

    def _write(self, products: DataFrame, mode: str) -> None:
        rows = postings(products).hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram")
        rows.write.mode(mode).partitionBy("bucket").parquet(self.path)

    def build(self, products: DataFrame) -> None:
        """The index of these products, in place of any other."""
        self._write(products, "overwrite")

    def add(self, products: DataFrame) -> None:
        """New and changed products, if there is an index."""
        if self.exists():
            self._write(products, "append")

    def exists(self) -> bool:
        return self._stored() is not None

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def candidates(self, query: str) -> DataFrame | None:
        """Products that have all characters of the text somewhere; None where the index cannot tell."""
        grams, stored = grams_of(query), self._stored()
        if not grams or stored is None:
            return None
        # a row a gram of the text; the buckets are known while planning, so that others are not read
        here = self.spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("g"))
        buckets = [r["b"] for r in here.select(_bucket(F.col("g")).alias("b")).distinct().collect()]
        met = stored.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
        counts = met.distinct().groupBy("product").agg(F.count(F.lit(1)).alias("n"))
        return counts.filter(F.col("n") == len(grams)).select("product")

    def search(
        self, products: DataFrame, brands: DataFrame, stock: DataFrame, query: str, limit: int = 30
    ) -> DataFrame:
        """As ``reports.product_search``; products without all characters of the text are not looked at."""
        found = self.candidates(query)
        if found is not None:
            products = products.join(found, F.col("product_id").cast("string") == F.col("product"), "left_semi")
        return product_search(products, brands, stock, query, limit)
