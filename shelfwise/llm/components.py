"""Connected components of an edge table, by union-find within partitions and stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Work


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over one partition's edges; returns an edge from each node to its root."""
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch["src"].tolist(), batch["dst"].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if parent[x] != x]
    if nodes:
        yield pd.DataFrame({"src": nodes, "dst": [find(x) for x in nodes]})


def _round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step; edges point from a node to a smaller one.

    Minima are aggregated on the map side and joined back, so a hub is a skewed
    join key, which Spark splits, and never a group in one task.
    """
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("low"))
    least = least.select("src", F.least("src", "low").alias("low"))
    large = (
        both.filter(F.col("dst") > F.col("src"))
        .join(least, "src")
        .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .distinct()
    )
    lowest = large.groupBy("src").agg(F.min("dst").alias("low"))
    small = large.join(lowest, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    small = small.filter(F.col("src") > F.col("dst"))
    return small.unionByName(lowest.select("src", F.col("low").alias("dst"))).distinct()


def components(edges: DataFrame, work: Work, max_rounds: int = 60) -> DataFrame:
    """The smallest node reachable from each node of an edge.

    edges: src and dst of one orderable type; their direction does not matter.
    Edges with a null end and loops are left out, repeated edges count once.
    Returns node and component, a row for each node of an edge that is not a loop; none
    for an empty table. Rounds go on until the edges stay as they are, about
    log(longest chain) times; each is written to the shared folder.
    """
    kind = edges.schema["src"].dataType.simpleString()
    edges = edges.filter(F.col("src") != F.col("dst")).select("src", "dst")
    now = work.keep(edges.mapInPandas(_forest, f"src {kind}, dst {kind}").distinct())
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        following = work.keep(_round(now))
        work.drop(now)
        now, last, mark = following, mark, _mark(following)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal only if the edges are."""
    found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return found[0], found[1]
