"""Transfers kept as needs and surpluses: their counts and first rows without the pairs.

Every need of a product meets every surplus of it in another warehouse, so the pairs of
a need are the product's surpluses minus its own and those that were handled. All
orders of the lists are by the need first. So the first rows come from as many needs as
there are rows at most, and only these meet surpluses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.operators.transfers import TRANSFER_COLUMNS, needs, priority, surpluses
from shelfwise.params import DEFAULTS, Params

#: names a pair; ``handled`` has these and its state
PAIR = ["product_id", "from_id", "to_id"]


def open_needs(position: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Needs of more than nothing, with their priority."""
    return needs(position, p).filter(F.col("needed") > 0).withColumn("priority", priority(p))


def open_offers(position: DataFrame) -> DataFrame:
    """Surpluses of more than nothing."""
    return surpluses(position).filter(F.col("available") > 0)


def _still_pairs(handled: DataFrame, need: DataFrame, offer: DataFrame) -> DataFrame:
    """Handled pairs, the last state of each, that today's needs and surpluses still form."""
    pairs = handled.filter(F.col("from_id") != F.col("to_id"))
    return pairs.join(need.select("product_id", "to_id"), ["product_id", "to_id"], "left_semi").join(
        offer.select("product_id", "from_id"), ["product_id", "from_id"], "left_semi"
    )


def counted(need: DataFrame, offer: DataFrame, handled: DataFrame | None = None) -> DataFrame:
    """Needs that have pairs left, with their number: of equi-joins on sums, none of which forms a pair."""
    offers = offer.groupBy("product_id").agg(F.count(F.lit(1)).alias("offers"))
    own = offer.select("product_id", F.col("from_id").alias("to_id"), F.lit(1).alias("own"))
    rows = need.join(offers, "product_id").join(own, ["product_id", "to_id"], "left")
    pairs = F.col("offers") - F.coalesce(F.col("own"), F.lit(0))
    drop = ["offers", "own"]
    if handled is not None:
        done = _still_pairs(handled, need, offer).groupBy("product_id", "to_id").agg(F.count(F.lit(1)).alias("done"))
        rows = rows.join(done, ["product_id", "to_id"], "left")
        pairs, drop = pairs - F.coalesce(F.col("done"), F.lit(0)), [*drop, "done"]
    return rows.withColumn("pairs", pairs).drop(*drop).filter(F.col("pairs") > 0)


def region_counts(need: DataFrame, offer: DataFrame, handled: DataFrame | None = None) -> DataFrame:
    """Pending transfers by destination region; needs have a state."""
    waiting = need.filter(F.col("state") == K.PENDING)
    return counted(waiting, offer, handled).groupBy("to_region").agg(F.sum("pairs").alias("transfers"))


def _formed(need: DataFrame, offer: DataFrame) -> DataFrame:
    pairs = need.join(offer.select("product_id", "from_id", "days_from", "available"), "product_id")
    return (
        pairs.filter(F.col("from_id") != F.col("to_id"))
        .withColumn("qty", F.least("available", "needed").cast("decimal(15,5)"))
        .select(*TRANSFER_COLUMNS, "state")
    )


def first_pairs(
    need: DataFrame,
    offer: DataFrame,
    limit: int,
    by: Sequence[Column | str] = ("days_to",),
    state: str | None = K.PENDING,
    handled: DataFrame | None = None,
) -> DataFrame:
    """The first pairs by the given columns of the need, then product, destination and origin.

    Pairs have the state of their need unless they were handled one by one. At most
    ``limit`` needs are joined with surpluses, by broadcast.
    """
    order = [*by, "product_id", "to_id"]
    open_ = need if state is None else need.filter(F.col("state") == state)
    few = counted(open_, offer, handled).drop("pairs").orderBy(*order).limit(limit)
    pairs = _formed(F.broadcast(few), offer)
    if handled is not None:
        pairs = pairs.join(handled.select(*PAIR), PAIR, "left_anti")
        done = handled.select(*PAIR, "state")
        done = done if state is None else done.filter(F.col("state") == state)
        ends = need.drop("state").join(done, ["product_id", "to_id"])
        ends = ends.join(offer.select("product_id", "from_id", "days_from", "available"), ["product_id", "from_id"])
        ends = ends.filter(F.col("from_id") != F.col("to_id"))
        ends = ends.withColumn("qty", F.least("available", "needed").cast("decimal(15,5)"))
        pairs = pairs.unionByName(ends.select(*TRANSFER_COLUMNS, "state"))
    return pairs.orderBy(*order, "from_id").limit(limit)


def pair_total(position: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """One row: how many transfers a position gives."""
    rows = counted(open_needs(position, p), open_offers(position))
    return rows.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("transfers"))
