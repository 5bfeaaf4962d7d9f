"""Mixing sources to target weights: repetition rates per source, whole copies and a seeded coin for the rest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD_PATTERN, Work, fresh, hint_if_small

#: weights of the sources in order of their names, beginning again after the last
WEIGHTS = (5, 2, 1)
#: tokens to take in all, in percent of those there are
SHARE_PERCENT = 150
#: no source, and so no document, is taken more often
MAX_REPEAT = 2
SEED = 20_011_104


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """source, source_size, target and rate, from source and source_size.

    Sources in order of their names by code point, null last, have the weights in turn and
    share share_percent of all sizes. A target stops at max_repeat times its source's
    size, and what is left is shared again by weight until none is above. That has a closed
    form: in ascending order of size over weight, a source stops if what the ones before it
    leave over would give it more than it may have. All sums are exact.
    One row a source is all that is sorted here.
    """
    if share_percent > 100 * max_repeat:
        raise ValueError("the share is more than all sources may give")
    named = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    at = turn.cast("int") + 1
    scale = math.lcm(*weights)
    df = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at).cast("decimal(9,0)"))
    # size over weight, times a common multiple of the weights
    parts = F.element_at(F.array(*(F.lit(scale // w) for w in weights)), at).cast("decimal(9,0)")
    cap = (F.lit(max_repeat) * F.col("source_size")).cast("decimal(20,0)")
    df = df.withColumn("cap", cap).withColumn("ratio", F.col("cap") * parts)
    everything = W.partitionBy(F.lit(0))
    order = everything.orderBy("ratio", "source")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    # hundredths, so that all is whole numbers
    budget = F.sum(F.col("source_size") * F.lit(share_percent)).over(everything).cast("decimal(22,0)")
    left = budget - 100 * F.coalesce(F.sum("cap").over(before), F.lit(0))
    df = df.withColumn("stops", 100 * F.col("cap") * F.sum("weight").over(rest) <= left * F.col("weight"))
    stopped = F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(everything)
    sharing = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    share = ((budget - 100 * stopped) * F.col("weight")).cast("double") / (100 * sharing).cast("double")
    df = df.withColumn("target", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return df.select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, coin: Column) -> Column:
    """floor(rate), and one more if the coin, uniform on [0, 1), is below the fraction."""
    whole = F.floor(rate)
    return whole + F.when(coin < rate - whole, 1).otherwise(0)


def coin(seed: int = SEED) -> Column:
    """A number on [0, 1) that depends on the seed, the id and the text only."""
    own = F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))
    )
    bits = F.conv(F.substring(F.md5(own), 1, 13), 16, 10).cast("long")
    return bits.cast("double") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, work: Work, **params) -> DataFrame:
    """doc_id, source, size, source_size, target, rate and copies for each row of docs.

    Texts are read once: what is kept of them is a row of numbers each. Sizes are summed
    per source on the map side. A null text has no words; a null source is a source of its
    own; a source without words has a target of 0 and is not taken. Repeated
    rows have one coin and are taken alike.
    """
    seed = params.pop("seed", SEED)
    sized = work.keep(docs.select("doc_id", "source", word_count().alias("size"), coin(seed).alias("coin")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = hint_if_small(targets(sums, **params), work)
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    times = copies(F.col("rate"), F.col("coin")).alias("copies")
    return joined.select("doc_id", "source", "size", "source_size", "target", "rate", times)


def mix(docs: DataFrame, work: Work, **params) -> DataFrame:
    """docs, each row as often as it is taken; all its columns pass through.

    Two passes: sizes per source first, then each row meets its source's rate and is
    repeated where it stands, so no text is shuffled while the sources are few enough to be
    broadcast (counted), and hot sources are split as a skewed join beyond that.
    """
    seed = params.pop("seed", SEED)
    sums = docs.select("source", word_count().alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = hint_if_small(targets(sums, **params).select(F.col("source").alias("mix_source"), "rate"), work)
    rate, at = fresh(docs, "mix_rate"), fresh(docs, "mix_copy")
    plan = plan.withColumnRenamed("rate", rate).withColumnRenamed("mix_source", at)
    joined = docs.join(plan, docs["source"].eqNullSafe(plan[at])).drop(plan[at])
    times = copies(F.col(rate), coin(seed)).cast("int")
    repeated = joined.withColumn(at, F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.drop(rate, at)


def taken(docs: DataFrame, work: Work, **params) -> DataFrame:
    """doc_id, size, source_size, target and taken (words with repeats) of each row of docs."""
    plan = plan_mix(docs, work, **params)
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )
