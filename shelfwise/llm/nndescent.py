"""Near duplicates of vectors by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Work, by_value, lists
from shelfwise.llm.components import components

THRESHOLD = 0.95
#: neighbours of a vector at first, and of saturated vectors at most
NEIGHBOURS = 10
MOST_NEIGHBOURS = 80
#: random-projection trees made at once; their number follows from MISSED, the probability that
#: a pair at the threshold shares a leaf of none. Vectors aimed at in a leaf and allowed in one
TREES = 10
MISSED = 0.001
LEAF, LEAF_MOST = 64, 256
FINER_BITS = 12
#: rounds end when fewer than this share of neighbours is new
SETTLED = 0.02
MAX_ROUNDS = 6
#: up to AUDITED vectors each is audited, of more a share down to one in AUDITED_PART; the recall
#: below which trees are added, and how often before the search is given up with an error
AUDITED = 20_000
AUDITED_PART = 50
RECALL = 0.95
MORE_TREES = 8
#: vectors with at most this many links are audited apart
FEW_LINKS = 3
#: vectors, and their bytes, that the driver sends to be compared with a whole table in one pass over it
PASS, PASS_BYTES = 8_000, 8 << 20
#: vectors of a block where saturated vectors' links are counted
BLOCK = 2048
#: radians by which bounds on angles are widened for rounding
SLACK = 1e-6
SEED = 7
_LIST = "node long, found array<long>, cosines array<double>"


def _unit(column: pa.ChunkedArray | pa.ListArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    matrix = column.flatten().to_numpy().reshape(rows, -1).astype(np.float64)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)  # neither squares nor their sum overflow
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _codes(first_tree: int, trees: int, bits: int):
    """For each vector and tree, the signs of random projections as a number, most telling bit first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(at))
                unit = _unit(part.column(1), len(at))
                if size not in planes:
                    random = np.random.default_rng([SEED, first_tree, int(size)])
                    planes[size] = random.standard_normal((int(size), trees * bits))
                signs = (unit @ planes[size] >= 0).reshape(len(at), trees, bits)
                codes = signs.astype(np.int64) @ weights
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists(codes.ravel(), np.full(len(at), trees), pa.int64())], names=["node", "codes"]
                )

    return run


def _best(names: np.ndarray, cosines: np.ndarray, least: np.ndarray, wanted: np.ndarray) -> tuple:
    """Of each row of a cosine matrix, the wanted number of best others that are above least."""
    np.fill_diagonal(cosines, -2.0)
    cosines[names[:, None] == names[None, :]] = -2.0
    most = int(min(wanted.max(), len(names) - 1))
    if most < len(names) - 1:
        top = np.argpartition(-cosines, most - 1, axis=1)[:, :most]
    else:
        top = np.broadcast_to(np.arange(len(names)), cosines.shape)
    values = np.take_along_axis(cosines, top, axis=1)
    good = values > least[:, None]
    return names[top[good]], values[good], good.sum(axis=1)


def _within_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's vectors are compared with each other; each row's improvements come out."""
    for table in by_value(batches, "group"):
        if table.num_rows < 2:
            continue
        names = table.column("node").to_numpy()
        unit = _unit(table.column("vector"), len(names))
        found, cosines, counts = _best(names, unit @ unit.T, table.column("least").to_numpy(), table.column("k").to_numpy())
        kept = np.flatnonzero(counts)
        if len(kept):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[kept]),
                    lists(found, counts[kept], pa.int64()),
                    lists(cosines, counts[kept], pa.float64()),
                ],
                names=["node", "found", "cosines"],
            )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lists of a node as one: its k best neighbours, and how many were not in the old list."""
    for batch in _gathered(batches):
        nodes, found, cosines, counts, ks, new = [], [], [], [], [], []
        for node, names, values, k, old in batch:
            names, first = np.unique(names, return_index=True)
            values = values[first]
            order = np.lexsort((names, -values))[:k]
            nodes.append(node)
            found.append(names[order])
            cosines.append(values[order])
            counts.append(len(order))
            ks.append(k)
            new.append(int((~np.isin(names[order], old)).sum()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes, pa.int64()),
                lists(np.concatenate(found), np.array(counts), pa.int64()),
                lists(np.concatenate(cosines), np.array(counts), pa.float64()),
                pa.array(ks, pa.int32()),
                pa.array(new, pa.int32()),
            ],
            names=["node", "found", "cosines", "k", "new"],
        )


def _gathered(batches: Iterator[pa.RecordBatch], most: int = 2000) -> Iterator[list[tuple]]:
    held = []
    for table in by_value(batches, "node"):
        found = table.column("found").combine_chunks()
        old = table.column("old").to_numpy(zero_copy_only=False).astype(bool)
        lengths = found.value_lengths().to_numpy()
        names = found.flatten().to_numpy()
        held.append(
            (
                table.column("node")[0].as_py(),
                names,
                table.column("cosines").combine_chunks().flatten().to_numpy(),
                max(table.column("k").to_pylist()),
                names[np.repeat(old, lengths)],
            )
        )
        if len(held) >= most:
            yield held
            held = []
    if held:
        yield held


class NeighbourGraph:
    """The k nearest other vectors of each vector, as far as the search has found them.

    Equal vectors are one node. The first graph comes from leaves of random-projection
    trees; leaves that are too full are split by further projections, then by chance. In
    each round every node's neighbours, and a bounded choice of the nodes it is a neighbour of,
    are compared with each other, and lists keep their best. A node whose list is full
    of links is saturated: its list is doubled, up to MOST_NEIGHBOURS; what saturated
    nodes may still lack is counted later, among all vectors. Rounds end when little is new.
    A share of the other nodes is then compared with all of them, pair by pair, and where links
    are not found to RECALL, of all nodes or of those with FEW_LINKS at most, trees are added; if
    that does not help, an error tells the figures. The recall is kept in ``recall``.
    """

    def __init__(self, nodes: DataFrame, work: Work, threshold: float) -> None:
        """nodes: node and vector, distinct and finite; stored."""
        self.nodes, self.work, self.threshold = nodes, work, threshold
        self.count = nodes.count()
        self.recall = 1.0
        self.graph: DataFrame | None = None

    def _bits(self) -> int:
        return min(50, max(1, math.ceil(math.log2(max(2, self.count / LEAF)))))

    def trees(self) -> int:
        """Trees that a pair at the threshold misses with probability MISSED, in whole calls of TREES."""
        meet = (1 - math.acos(min(1.0, self.threshold)) / math.pi) ** self._bits()
        wanted = math.log(MISSED) / math.log1p(-meet) if meet < 1 else 1
        return TREES * math.ceil(wanted / TREES)

    def _leaves(self, first_tree: int, trees: int) -> DataFrame:
        """node and group, a row for each tree."""
        bits = self._bits()
        coded = self.nodes.select("node", "vector").mapInArrow(
            _codes(first_tree, trees, bits + FINER_BITS), "node long, codes array<long>"
        )
        rows = coded.select("node", F.posexplode("codes").alias("tree", "code"))
        rows = self.work.keep(rows.withColumn("coarse", F.shiftright("code", FINER_BITS)))
        coarse = rows.groupBy("tree", "coarse").agg(F.count(F.lit(1)).alias("n"))
        full = coarse.filter(F.col("n") > LEAF_MOST).select("tree", "coarse")
        fine = rows.join(full, ["tree", "coarse"], "left_semi").groupBy("tree", "code").agg(F.count(F.lit(1)).alias("m"))
        marked = rows.join(coarse, ["tree", "coarse"]).join(fine, ["tree", "code"], "left")
        own = F.when(F.col("n") <= LEAF_MOST, F.xxhash64("tree", "coarse")).otherwise(
            F.xxhash64(
                "tree", "coarse", "code", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("m") / F.lit(LEAF_MOST)))
            )
        )
        return marked.select("node", own.alias("group"))

    def _compared(self, groups: DataFrame) -> DataFrame:
        """Lists of improvements from comparing the nodes of each group; groups: node, group, k, least."""
        wide = groups.join(self.nodes, "node")
        size = F.size("vector")
        wide = wide.select(F.xxhash64("group", size).alias("group"), "node", "k", "least", "vector")
        wide = wide.repartition("group").sortWithinPartitions("group")
        return wide.mapInArrow(_within_groups, _LIST)

    def _merged(self, lists_: DataFrame) -> DataFrame:
        """lists_: node, found, cosines, k, old."""
        rows = lists_.repartition("node").sortWithinPartitions("node")
        return self.work.keep(rows.mapInArrow(_merge, f"{_LIST}, k int, new int"))

    def _replace(self, merged: DataFrame) -> None:
        self.work.drop(self.graph)
        self.graph = merged

    def add_trees(self, first_tree: int, trees: int) -> None:
        leaves = self._leaves(first_tree, trees).withColumns(
            {"k": F.lit(NEIGHBOURS), "least": F.lit(-1.5)}
        )
        fresh = self._compared(leaves).withColumns({"k": F.lit(NEIGHBOURS), "old": F.lit(False)})
        if self.graph is not None:
            fresh = fresh.unionByName(self.graph.select("node", "found", "cosines", "k", F.lit(True).alias("old")))
        self._replace(self._merged(fresh))

    def _round(self) -> float:
        """One round; the share of neighbours that are new."""
        saturated = (F.size("found") >= F.col("k")) & (F.element_at("cosines", -1) >= self.threshold)
        wider = F.least(F.col("k") * F.when(saturated, 2).otherwise(1), F.lit(MOST_NEIGHBOURS))
        lists_ = self.graph.select("node", "found", "cosines", wider.cast("int").alias("k"), F.lit(True).alias("old"))
        least = F.when(F.size("found") < F.col("k"), F.lit(-1.5)).otherwise(F.element_at("cosines", -1))
        state = lists_.select("node", "k", least.alias("least"))
        near = lists_.select(F.col("node").alias("center"), F.explode("found").alias("node"))
        # whose neighbour a node is: a bounded choice, by chance, of what may be a third of all nodes
        slot = F.pmod(F.xxhash64("center", "node"), F.lit(2 * NEIGHBOURS))
        back = near.select(F.col("node").alias("to"), F.col("center").alias("from"), slot.alias("slot"))
        back = back.groupBy("to", "slot").agg(F.min("from").alias("node")).select(F.col("to").alias("center"), "node")
        both = near.unionByName(back).unionByName(lists_.select(F.col("node").alias("center"), "node")).distinct()
        groups = both.join(state, "node").select(F.col("center").alias("group"), "node", "k", "least")
        better = self._compared(groups).join(state.select("node", "k"), "node").withColumn("old", F.lit(False))
        merged = self._merged(lists_.unionByName(better.select(*lists_.columns)))
        total, new = merged.agg(F.sum(F.size("found")), F.sum("new")).first()
        self._replace(merged)
        return (new or 0) / max(1, total or 0)

    def descend(self) -> None:
        for _ in range(MAX_ROUNDS):
            if self._round() < SETTLED:
                break

    def saturated(self) -> DataFrame:
        full = (F.size("found") >= F.col("k")) & (F.element_at("cosines", -1) >= self.threshold)
        return self.graph.filter(full).select("node")

    def audit(self) -> float:
        """Recall of links of a share of the nodes that are not saturated, compared with all such nodes.

        Links of saturated nodes are counted among all vectors later and need no audit.
        """
        part = min(AUDITED_PART, max(1, self.count // AUDITED))
        open_ = self.nodes.join(self.saturated(), "node", "left_anti")
        chosen = open_.filter(F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(part)) == 0)
        chosen = self.work.keep(chosen.join(self.graph.select("node", "found"), "node", "left"))
        open_ = self.work.keep(open_)
        threshold = self.threshold

        def compare(asked, batches):
            names, unit, known = asked
            for mine, given in batches:
                i, j = np.nonzero(given @ unit.T >= threshold)
                apart = mine[i] != names[j]
                i, j = i[apart], j[apart]
                got = np.zeros(len(j), dtype=np.int64)
                for at in range(0, len(j), 20_000):  # links of dense groups are many
                    some = slice(at, at + 20_000)
                    got[some] = (known[j[some]] == mine[i[some]][:, None]).any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(names[j]), pa.array(got)], names=["node", "got"])

        total = {True: [0, 0], False: [0, 0]}
        for asked in _passes(chosen, extra="found"):
            found = open_.mapInArrow(_against(asked, compare), "node long, got long")
            each = found.groupBy("node").agg(F.count(F.lit(1)).alias("links"), F.sum("got").alias("got"))
            sums = each.groupBy((F.col("links") <= FEW_LINKS).alias("few")).agg(F.sum("got"), F.sum("links"))
            for few, got, links in sums.collect():
                total[few][0] += got
                total[few][1] += links
        self.work.drop(chosen, open_)
        self.audited = total
        self.recall = min(got / links if links else 1.0 for got, links in total.values())
        return self.recall

    def build(self) -> None:
        planned = self.trees()
        for first in range(0, planned, TREES):
            self.add_trees(first, TREES)
        self.descend()
        for more in range(MORE_TREES + 1):
            if self.audit() >= RECALL:
                return
            if more < MORE_TREES:
                self.add_trees(planned + more * TREES, TREES)
                self.descend()
        raise RuntimeError(
            f"recall of links {self.recall:.4f} is below {RECALL} after {planned + MORE_TREES * TREES} trees; "
            f"found and true links of audited vectors with few links {self.audited[True]}, with more {self.audited[False]}"
        )


def _passes(rows: DataFrame, extra: str) -> Iterator[dict[int, tuple]]:
    """rows (node, vector, extra) in parts of about PASS rows or PASS_BYTES: names, unit vectors and extras by length.

    Lists (found) come as the rows of a matrix, filled up with -1, which is no node.
    """
    count, numbers = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    parts = max(1, math.ceil(count / PASS), math.ceil(8 * numbers / PASS_BYTES))
    for part in range(parts):
        at = rows.filter(F.pmod(F.xxhash64(F.lit(SEED + 1), "node"), F.lit(parts)) == part)
        table = at.select("node", "vector", extra).toArrow()
        if not table.num_rows:
            continue
        sizes = np.array([len(v) for v in table.column(1)])
        by_size = {}
        for size in np.unique(sizes):
            some = table.take(pa.array(np.flatnonzero(sizes == size)))
            extras = some.column(2).to_pylist()
            if extra == "found":
                known = [e or () for e in extras]
                extras = np.full((len(known), max([1, *map(len, known)])), -1, dtype=np.int64)
                for i, own in enumerate(known):
                    extras[i, : len(own)] = own
            by_size[int(size)] = (some.column(0).to_numpy(), _unit(some.column(1), some.num_rows), extras)
        yield by_size


def _against(asked: dict[int, tuple], compare):
    """Batches of node and vector, cut to vectors of one length and to some rows, go to compare with the asked ones."""

    def cut(batches, size):
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            part = batch.take(pa.array(np.flatnonzero(sizes == size)))
            for start in range(0, part.num_rows, 512):
                some = part.slice(start, 512)
                yield some.column("node").to_numpy(), _unit(some.column("vector"), some.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, given in asked.items():
                yield from compare(given, cut([batch], size))

    return run


def _usable(col: str):
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(col).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(col, lambda x: x != 0)


def _near(asked: DataFrame, nodes: DataFrame, work: Work, threshold: float) -> DataFrame:
    """component and node: which vectors may be linked to a saturated one of a component.

    asked: node, component, vector. The saturated vectors of a component lie within an angle
    of one of them; a vector linked to one lies within that angle and the threshold's. Others are
    farther, whatever component they are in, so nothing that can be linked is left out.
    """
    centres = asked.groupBy("component").agg(F.min_by("vector", "node").alias("centre"))

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = np.empty(batch.num_rows)
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(at))
                cosines[at] = np.einsum("ij,ij->i", _unit(part.column(1), len(at)), _unit(part.column(2), len(at)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cosines)], names=["component", "cosine"])

    spread = asked.join(centres, "component").select("component", "vector", "centre")
    spread = spread.mapInArrow(widest, "component long, cosine double").groupBy("component").agg(F.min("cosine").alias("low"))
    reach = F.acos(F.least(F.greatest("low", F.lit(-1.0)), F.lit(1.0))) + math.acos(threshold) + 2 * SLACK
    bound = F.when(reach >= math.pi, F.lit(-2.0)).otherwise(F.cos(reach))
    centres = centres.join(spread, "component").select(
        F.col("component").alias("node"), F.col("centre").alias("vector"), bound.alias("bound")
    )
    centres = work.keep(centres)

    def compare(given, batches):
        names, unit, bounds = given
        for mine, vectors in batches:
            i, j = np.nonzero(vectors @ unit.T >= np.array(bounds))
            yield pa.RecordBatch.from_arrays([pa.array(names[j]), pa.array(mine[i])], names=["component", "node"])

    found = None
    for part in _passes(centres, extra="bound"):
        rows = work.keep(nodes.select("node", "vector").mapInArrow(_against(part, compare), "component long, node long"))
        found = rows if found is None else found.unionByName(rows)
    return nodes.select(F.lit(0).cast("long").alias("component"), "node").limit(0) if found is None else found


def _within_cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_value(batches, "cell"):
            asks = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
            gives = np.flatnonzero(table.column("gives").to_numpy(zero_copy_only=False))
            if not len(asks) or not len(gives):
                continue
            names = table.column("node").to_numpy()
            weights = table.column("copies").to_numpy().astype(np.int64)
            full = table.column("full").to_numpy(zero_copy_only=False).astype(bool)
            own = table.column("own").to_numpy()
            unit = _unit(table.column("vector"), len(names))
            linked = unit[asks] @ unit[gives].T >= threshold
            linked &= names[asks][:, None] != names[gives][None, :]
            other = gives[linked.any(axis=0)]
            # what a vector that is not asked for gets from those that are
            back = linked[:, ~full[gives]].T.astype(np.int64) @ weights[asks]
            to = names[gives][~full[gives]]
            nodes = np.concatenate([names[asks], to[back > 0]])
            links = np.concatenate([linked.astype(np.int64) @ weights[gives], back[back > 0]])
            reached = np.unique(own[other])
            reached = reached[reached != own[asks[0]]]
            empty, more = np.zeros(len(nodes), dtype=np.int64), len(reached)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([nodes, np.full(more, own[asks[0]])])),
                    pa.array(np.concatenate([links, np.zeros(more, dtype=np.int64)])),
                    pa.array(np.concatenate([empty, reached]), mask=np.arange(len(nodes) + more) < len(nodes)),
                ],
                names=["node", "links", "reached"],
            )

    return run


def _counted_whole(asked: DataFrame, members: DataFrame, work: Work, threshold: float) -> DataFrame:
    """Links of saturated nodes: each is compared with all that may be linked to its component, in pairs of blocks.

    asked: node, component; members: node, component it may be linked to, own component,
    copies, full (whether it is asked for itself), vector. Counts, not links, come out: node and
    links, a row for a node and block, also of nodes that are not asked for, with their links to those
    that are; and rows with a component as node and another one that is reached from it.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("gives"))
    wants = asked.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("asks"))
    blocks = sizes.join(wants, "component")

    def block(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def upto(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    gives = members.select("node", "component").join(blocks, "component")
    gives = gives.select("node", "component", block("gives").alias("g"), upto("asks").alias("a"), F.lit(True).alias("gives"))
    asks = asked.join(blocks, "component")
    asks = asks.select("node", "component", block("asks").alias("a"), upto("gives").alias("g"), F.lit(True).alias("asks"))
    both = gives.join(asks, ["node", "component", "a", "g"], "full").select(
        "node",
        F.xxhash64("component", "a", "g").alias("cell"),
        F.coalesce("asks", F.lit(False)).alias("asks"),
        F.coalesce("gives", F.lit(False)).alias("gives"),
    )
    wide = both.join(members.select("node", "own", "copies", "full", "vector").dropDuplicates(["node"]), "node")
    wide = wide.withColumn("cell", F.xxhash64("cell", F.size("vector")))
    wide = wide.repartition("cell").sortWithinPartitions("cell")
    return work.keep(wide.mapInArrow(_within_cells(threshold), "node long, links long, reached long"))


def linked_vectors(vectors: DataFrame, work: Work, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding).

    n_links counts the other rows at a cosine of threshold or more that were found, all of them for
    vectors with more than a list holds; equal vectors are linked and are counted without being compared. component_id is the smallest
    id reachable by links, itself included (null ids are not counted; null for a group
    of null ids only), kept whether it is the row's own, nulls being equal.
    Rows without a vector, and vectors that are zero, empty or hold null or non-finite numbers,
    have no links. Vectors of different lengths are not linked. No link is below the
    threshold: every cosine is computed in double precision from the vectors themselves.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    usable = F.coalesce(_usable("vector"), F.lit(False))
    # minus zero is zero
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.withColumn("usable", usable).withColumn("vector", F.when(F.col("usable"), plain))
    # two hashes tell vectors apart; a node's number is its own
    key = ["h1", "h2"]
    rows = rows.withColumns({h: F.when(F.col("usable"), F.xxhash64(F.lit(h), "vector")) for h in key})
    rows = work.keep(rows)
    equal = rows.filter("usable").groupBy(*key).agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low")
    )
    nodes = work.keep(equal.withColumn("node", F.monotonically_increasing_id()))
    search = NeighbourGraph(nodes.select("node", "vector"), work, threshold)
    search.build()
    graph = search.graph
    pairs = graph.select("node", F.explode(F.arrays_zip("found", "cosines")).alias("z"))
    pairs = pairs.filter(F.col("z.cosines") >= threshold).select("node", F.col("z.found").alias("other"))
    edges = work.keep(pairs.select(F.least("node", "other").alias("src"), F.greatest("node", "other").alias("dst")).distinct())
    groups = work.keep(components(edges, work))
    named = nodes.select("node", "copies", "low").join(groups, "node", "left")
    named = work.keep(named.withColumn("component", F.coalesce("component", "node")))
    asked = work.keep(search.saturated().join(named.select("node", "component"), "node"))
    vector_of = nodes.select("node", "vector")
    near = _near(asked.join(vector_of, "node"), vector_of, work, threshold)
    full = asked.select("node", F.lit(True).alias("full"))
    known = named.select("node", "copies", F.col("component").alias("own")).join(full, "node", "left")
    known = work.keep(known.withColumn("full", F.coalesce("full", F.lit(False))).join(vector_of, "node"))
    whole = _counted_whole(asked, near.join(known, "node"), work, threshold)
    counts = whole.filter("reached IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    # components that only links which no list had room for hold together
    bridges = whole.filter("reached IS NOT NULL").select(F.col("node").alias("src"), F.col("reached").alias("dst")).distinct()
    joined = components(bridges, work).select(F.col("node").alias("component"), F.col("component").alias("wider"))
    named = named.join(joined, "component", "left").withColumn("component", F.coalesce("wider", "component")).drop("wider")
    named = work.keep(named)
    # links among the others; those with a saturated node are in counts for both ends
    ends = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    weights = known.filter("NOT full").select(F.col("node").alias("dst"), "copies")
    listed = ends.join(weights, "dst").groupBy("src").agg(F.sum("copies").alias("listed"))
    listed = listed.join(full.select(F.col("node").alias("src")), "src", "left_anti")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    counted = (
        named.join(lowest, "component")
        .join(listed.select(F.col("src").alias("node"), "listed"), "node", "left")
        .join(counts, "node", "left")
    )
    links = F.coalesce("links", F.lit(0)) + F.coalesce("listed", F.lit(0)) + F.col("copies") - 1
    result = counted.select("node", links.alias("n_links"), "component_id").join(nodes.select("node", *key), "node")
    linked = rows.filter("usable").select("vec_id", *key).join(result, key)
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
