"""Prefix trie of conversations: balanced parentheses per shard, shared spines merged.

Conversations are reduced to hashes of their turns, equal sequences to one, and the
sequences are dealt by ranges of their lexicographic order. So a shard holds a piece
of the trie that only its first and its last path (its spines) can share with other
shards. A shard writes its piece as balanced parentheses; everything asked of a
subtree is a difference of cumulative arrays between a node's parentheses. Nodes on
spines are added up over the shards, and what was counted in more than one of them is
taken back on the way to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD_PATTERN, Work, hint_if_small

#: conversations are rebuilt from the head of the first one of so many
FAMILY, HEADS = 20, 4
#: turns that decide in which shard a sequence lies; longer common beginnings share a shard
RANGE_TURNS = 64
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max


# --- balanced parentheses -----------------------------------------------------------


class Parentheses:
    """A tree as balanced parentheses, with the least and largest excess of blocks and of pairs of blocks.

    The excess after a place is the number of open parentheses there. The partner of an
    opening one is the first later place whose excess is below its own.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        steps = np.where(bits, 1, -1).astype(np.int32)
        excess = np.cumsum(steps, dtype=np.int32)
        blocks = -(-len(bits) // BLOCK)
        full = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        full[: len(bits)] = excess
        self.excess = full.reshape(blocks, BLOCK)
        self.largest = np.where(self.excess == np.iinfo(np.int32).max, -1, self.excess).max(axis=1)
        self.least = [self.excess.min(axis=1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int32).max)
            self.least.append(below.reshape(-1, 2).min(axis=1))
        self.opened = np.cumsum(bits, dtype=np.int64)
        pairs = np.append(bits[:-1] & ~bits[1:], False)
        self.pairs = np.cumsum(pairs, dtype=np.int64)

    def _in_block(self, block: np.ndarray, after: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The first place in a block beyond an offset whose excess is below; -1 where there is none."""
        rows = self.excess[block]
        fits = (rows < below[:, None]) & (np.arange(BLOCK) > after[:, None])
        return np.where(fits.any(axis=1), block * BLOCK + fits.argmax(axis=1), -1)

    def _next_block(self, block: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The first block after each whose least excess is below: up the pairs of blocks, and down again."""
        at, level = block + 1, np.full(len(block), -1)

        def hit(up: int, open_: np.ndarray) -> np.ndarray:
            least = self.least[up]
            there = open_ & (at < len(least))
            return there & (least[np.minimum(at, len(least) - 1)] < below)

        for up in range(len(self.least)):
            open_ = level < 0
            if not open_.any():
                break
            level[hit(up, open_)] = up
            open_ = level < 0
            left = open_ & (at % 2 == 0)
            at[open_] += 1
            level[hit(up, left)] = up
            open_ = level < 0
            at[open_ & left] += 1
            at[open_] >>= 1
        for down in range(len(self.least) - 1, 0, -1):
            here = level == down
            at[here] *= 2
            least = self.least[down - 1]
            at[here & (least[np.minimum(at, len(least) - 1)] >= below)] += 1
            level[here] = down - 1
        return at

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        found = np.empty(len(opens), dtype=np.int64)
        for start in range(0, len(opens), 1 << 14):
            some = opens[start : start + (1 << 14)]
            block, offset = some // BLOCK, some % BLOCK
            below = self.excess[block, offset]
            close = self._in_block(block, offset, below)
            far = np.flatnonzero(close < 0)
            if len(far):
                there = self._next_block(block[far], below[far])
                close[far] = self._in_block(there, np.full(len(far), -1), below[far])
            found[start : start + (1 << 14)] = close
        return found

    def leaves(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Pairs "()" between a node's parentheses."""
        return self.pairs[closes] - np.where(opens > 0, self.pairs[opens - 1], 0)


def least_in(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Minima of values over ranges, by ranges of doubled lengths."""
    out = np.empty(len(start), dtype=values.dtype)
    power = np.frexp(size.astype(np.float64))[1] - 1
    doubled = values
    for level in range(int(power.max()) + 1 if len(power) else 0):
        if level:
            half = 1 << (level - 1)
            doubled = np.minimum(doubled[:-half], doubled[half:])
        own = np.flatnonzero(power == level)
        out[own] = np.minimum(doubled[start[own]], doubled[start[own] + size[own] - (1 << level)])
    return out


# --- one shard ----------------------------------------------------------------------


class Shard:
    """Nodes, in preorder, of the trie of sorted, distinct sequences.

    keys: two hashes for each turn; words: of each turn; lengths: turns of each
    sequence; low, count: smallest id and number of the conversations that are it.
    """

    def __init__(self, keys: np.ndarray, words: np.ndarray, lengths: np.ndarray, low: np.ndarray, count: np.ndarray):
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(owner)) - starts[owner]
        before = np.maximum(owner - 1, 0)
        shared = (owner > 0) & (place < lengths[before])
        other = np.minimum(starts[before] + place, max(len(owner) - 1, 0))
        shared &= (keys == keys[other]).all(axis=1) if len(keys) else False
        common = lengths.copy()
        np.minimum.at(common, owner[~shared], place[~shared])
        new = place >= common[owner]
        closed = np.append(lengths[:-1] - common[1:], 0)  # after each sequence, before the next one
        closed[-1] = lengths[-1] + 1
        runs = np.empty(2 * len(lengths), dtype=np.int64)
        runs[0::2], runs[1::2] = lengths - common, closed
        runs[0] = lengths[0] + 1  # with the root
        self.tree = Parentheses(np.repeat(np.arange(2 * len(lengths)) % 2 == 0, runs))
        self.keys, self.lengths, self.starts = keys, lengths, starts
        self.number = np.cumsum(new)  # of the node of each turn that makes one
        self.depth = np.append(0, place[new] + 1)
        self.words = np.append(0, words[new])
        nodes = len(self.depth)
        self.ends = np.where(lengths > 0, self.number[starts + lengths - 1] if len(owner) else 0, 0)
        self.parent = self._parents()
        opens = np.flatnonzero(self.tree.bits)
        closes = self.tree.findclose(opens)
        size = (closes - opens + 1) // 2
        self.preorder = np.arange(nodes)

        def summed(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values))
            return total[self.preorder + size] - total[self.preorder]

        ended = np.zeros(nodes, dtype=np.int64)
        ended[self.ends] = count
        lowest = np.full(nodes, _FAR)
        lowest[self.ends] = low
        self.n_convs = summed(ended)
        self.low = least_in(lowest, self.preorder, size)
        self.n_leaves = self.tree.leaves(opens, closes)
        self.saved = summed((self.n_convs - 1) * self.words)
        self.n_children = np.bincount(self.parent[1:], minlength=nodes)
        self.leaf = size == 1

    def _parents(self) -> np.ndarray:
        """The last node before each that lies one level higher."""
        nodes = len(self.depth)
        codes = np.sort(self.depth * nodes + np.arange(nodes))
        wanted = (self.depth - 1) * nodes + np.arange(nodes)
        parent = codes[np.maximum(np.searchsorted(codes, wanted) - 1, 0)] % nodes
        parent[0] = -1
        return parent

    def path(self, sequence: int) -> tuple[list[int], list[bytes]]:
        """The nodes of a sequence from the root, and the hashes of the turns up to each."""
        at, n = self.starts[sequence], self.lengths[sequence]
        nodes = [int(self.ends[sequence])]
        while nodes[-1] > 0:
            nodes.append(int(self.parent[nodes[-1]]))
        hashes = [b"\0" * 16]
        for turn in self.keys[at : at + n]:
            hashes.append(hashlib.blake2b(hashes[-1] + turn.tobytes(), digest_size=16).digest())
        return nodes[::-1], hashes


_NODE = (
    "path long, key binary, parent_key binary, own boolean, leaf boolean, words long, ends_sha256 string, "
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
)
_NAMES = [part.split()[0] for part in _NODE.split(", ")]


def _piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard. Those on its spines have a path (two numbers for each shard) and a key."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    turns = rows.column("turns").chunk(0)
    flat = turns.flatten()
    keys = np.column_stack([flat.field(k).to_numpy(zero_copy_only=False) for k in ("a", "b")]).astype(np.int64)
    words = flat.field("words").to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    low, count = (rows.column(c).to_numpy().astype(np.int64) for c in ("low", "n"))
    shard = Shard(keys, words, lengths, low, count)
    nodes, number = len(shard.depth), TaskContext.get().partitionId()
    sha = np.full(nodes, -1)
    sha[shard.ends] = np.arange(len(lengths))
    digests = rows.column("ends_sha256").combine_chunks()
    paths = [shard.path(0)] + ([shard.path(len(lengths) - 1)] if len(lengths) > 1 else [])
    keyed = {node: key for found, hashes in paths for node, key in zip(found, hashes, strict=True)}

    def batch(chosen: np.ndarray, path: list, key: list, own: list) -> pa.RecordBatch:
        up = shard.parent[chosen]
        columns = [
            pa.array(path, pa.int64()),
            pa.array(key, pa.binary()),
            pa.array([keyed.get(p) for p in up.tolist()], pa.binary()),
            pa.array(own, pa.bool_()),
            pa.array(shard.leaf[chosen]),
            pa.array(shard.words[chosen]),
            digests.take(pa.array(sha[chosen], mask=sha[chosen] < 0)),
            pa.array(shard.low[chosen]),
            pa.array(shard.depth[chosen]),
            pa.array(shard.low[np.maximum(up, 0)], mask=up < 0),
            *(pa.array(x[chosen]) for x in (shard.n_convs, shard.n_children, shard.n_leaves, shard.saved)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    seen: set[int] = set()
    for i, (found, hashes) in enumerate(paths):
        yield batch(np.array(found), [2 * number + i] * len(found), hashes, [x not in seen for x in found])
        seen.update(found)
    rest = np.setdiff1d(shard.preorder, np.fromiter(keyed, dtype=np.int64))
    for at in range(0, len(rest), 20_000):
        some = rest[at : at + 20_000]
        yield batch(some, [None] * len(some), [None] * len(some), [True] * len(some))


# --- over all shards ----------------------------------------------------------------


def rebuilt(table: DataFrame) -> DataFrame:
    """id and turns (a, b: hashes of role and text, words) of each conversation with its family's head.

    Turns are ordered by their number, null first; of equal numbers by the hashes. Rows
    without an id belong to no conversation.
    """
    text = F.coalesce("text", F.lit(""))
    told = [F.coalesce("role", F.lit("")), text]
    turn = F.struct(
        F.col("turn"),
        F.xxhash64(F.lit(1), *told).alias("a"),
        F.xxhash64(F.lit(2), *told).alias("b"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).alias("words"),
    )
    rows = table.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("id"), turn.alias("t"))
    listed = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["a"], t["b"], t["words"]))
    own = rows.groupBy("id").agg(listed.alias("own"))
    heads = own.filter(F.col("id") % FAMILY == 0)
    heads = heads.select(F.col("id").alias("first"), F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.join(heads, F.col("id") - F.col("id") % FAMILY == F.col("first"), "left")
    head = F.when(F.col("head").isNull(), F.array()).otherwise(F.slice("head", F.lit(1), h))
    left = F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))
    return joined.select("id", F.concat(head, left).alias("turns"))


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of each key, of rows sorted by key and id: smallest, number and digest of the list.

    Ids run through the digest as they come, so a key of any number of them takes no memory.
    """
    key, low, count, digest = None, 0, 0, hashlib.sha256()
    done: list[tuple[int, int, str]] = []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["low", "n", "ends_sha256"])

    for batch in batches:
        a, b, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "id"))
        cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(ids)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if key != (a[start], b[start]):
                if key is not None:
                    done.append((low, count, digest.hexdigest()))
                key, low, count, digest = (a[start], b[start]), int(ids[start]), 0, hashlib.sha256()
            text = ",".join(map(str, ids[start:end].tolist()))
            digest.update(("," + text if count else text).encode())
            count += end - start
        if len(done) >= 10_000:
            yield flushed()
            done.clear()
    if key is not None:
        done.append((low, count, digest.hexdigest()))
    yield flushed()


def sequences(table: DataFrame, work: Work) -> DataFrame:
    """Distinct sequences of turns with the smallest id, the number and the digest of their conversations."""
    whole = work.keep(
        rebuilt(table).select(
            "id", "turns", F.xxhash64(F.lit(1), "turns").alias("a"), F.xxhash64(F.lit(2), "turns").alias("b")
        )
    )
    keys = whole.select("a", "b", "id").repartition("a", "b").sortWithinPartitions("a", "b", "id")
    ends = keys.mapInArrow(_endings, "low long, n long, ends_sha256 string")
    return work.keep(whole.select("id", "turns").join(ends, F.col("id") == F.col("low")).drop("id"))


def trie_nodes(table: DataFrame, work: Work) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations, the empty one included.

    table: conv_id, turn, role, text; other columns are not read. Null roles and texts
    are empty ones, rows with a null conv_id are left out, rows of equal turn numbers
    (repeated rows too) are turns like others, in the order of their hashes. An empty
    table has no nodes. Turns are equal if two 64-bit hashes of role and text are.
    The turns of one conversation (24 bytes each) and a shard of distinct sequences lie
    in a task's memory; the ids of equal conversations do not.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    distinct = sequences(table, work)
    dealt = distinct.repartitionByRange(F.slice("turns", 1, RANGE_TURNS)).sortWithinPartitions("turns")
    nodes = work.keep(dealt.mapInArrow(_piece, _NODE))
    spine, inner = nodes.filter("key is not null"), nodes.filter("key is null")

    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    merged = (
        spine.filter("own")
        .groupBy("key")
        .agg(
            *(F.sum(c).alias(c) for c in sums),
            *(F.min(c).alias(c) for c in ("conv_id", "depth", "words", "parent_key", "path")),
            F.max("ends_sha256").alias("ends_sha256"),
            F.count(F.lit(1)).alias("shards"),
            F.sum(F.col("leaf").cast("int")).alias("leaf_shards"),
        )
    )
    merged = work.keep(merged)
    # what was counted in more than one shard: children, leaves that go on elsewhere, and one text too few
    twice = merged.filter("shards > 1").select(
        "key",
        "path",
        "parent_key",
        (F.col("shards") - 1).alias("more"),
        ((F.col("shards") - 1) * F.col("words")).alias("more_saved"),
        (-F.col("leaf_shards")).alias("more_leaves"),
    )
    # a shared node is counted on one of its paths, from where every node above it sees it once
    to_root = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    above = spine.select("key", "path", "depth").join(twice.drop("parent_key", "more"), ["key", "path"], "left")
    above = above.select("key", *(F.sum(c).over(to_root).alias(c) for c in ("more_saved", "more_leaves")))
    above = above.groupBy("key").agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))
    fewer = twice.groupBy(F.col("parent_key").alias("key")).agg(F.sum("more").alias("fewer"))
    settled = merged.join(above, "key", "left").join(fewer, "key", "left")

    def plus(name: str, more: str, sign: int = 1):
        return (F.col(name) + sign * F.coalesce(F.col(more), F.lit(0))).alias(name)

    settled = settled.select(
        "key",
        "parent_key",
        "ends_sha256",
        "conv_id",
        "depth",
        "n_convs",
        plus("n_children", "fewer", -1),
        plus("n_leaves", "more_leaves"),
        plus("saved_tokens", "more_saved"),
    )
    known = hint_if_small(merged.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id")), work)
    out = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]

    def below_spine(rows: DataFrame) -> DataFrame:
        return rows.join(known, F.col("parent_key") == F.col("up"), "left").select(*out)

    return (
        inner.filter("parent_key is null")
        .select(*out)
        .unionByName(below_spine(inner.filter("parent_key is not null").drop("parent_conv_id")))
        .unionByName(below_spine(settled))
    )
