"""Near duplicates by SuperMinHash signatures, banding, verification and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import WORD, Memo, Work, binaries, by_value, chunks, fresh, lists, mix64, text_key
from shelfwise.llm.components import components

BANDS = 30
ROWS = 5
SLOTS = BANDS * ROWS
#: a pair whose signatures agree in a smaller share is no candidate: for a pair at a
#: similarity of 0.8 that is 6.1 standard deviations below the mean, a probability of 1e-8
MARGIN = 0.2
#: a bucket with more classes beside its largest component is divided by rare n-grams first
GROUP = 20_000
#: n-grams of the sets that are compared with each other in one task
CELL_GRAMS = 2_000_000
_TEXT_CHARS = 3_000_000


def superminhash(values: np.ndarray, lengths: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures of sets of 64-bit hashes; a row of ``slots`` for each set.

    Each element has a random permutation of the slots and a random fraction for each rank
    in it; slot k holds the least rank + fraction of the elements. Ranks are taken one
    after the other for all sets at once, and a set ends as soon as all its slots are
    below the next rank: higher ranks cannot improve it. Ranks are in the upper and
    fractions in the lower 32 bits. Empty sets have the largest value in all slots.
    """
    sets = len(lengths)
    low = np.full(sets * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(sets, dtype=np.int64), lengths)
    seeds, swaps = values, []
    for rank in range(slots):
        if not len(seeds):
            break
        bits = mix64(seeds + np.uint64((rank + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        # Fisher-Yates: this rank's swap, followed back through the earlier ones
        swap = (np.uint64(rank) + (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(slots - rank)) >> np.uint64(32))).astype(
            np.int16
        )
        slot = swap.copy()
        for earlier in range(rank - 1, -1, -1):
            other = swaps[earlier]
            slot = np.where(slot == earlier, other, np.where(slot == other, np.int16(earlier), slot))
        np.minimum.at(low, owner * slots + slot, (np.uint64(rank) << np.uint64(32)) | (bits >> np.uint64(32)))
        swaps.append(swap)
        open_sets = low.reshape(sets, slots).max(axis=1) >= (np.uint64(rank + 1) << np.uint64(32))
        left = open_sets[owner]
        if not left.all():
            owner, seeds, swaps = owner[left], seeds[left], [s[left] for s in swaps]
    return low.reshape(sets, slots)


def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass").lower())  # bytes lower A-Z only


def shingle_set(text: str | None, size: int, memo: Memo) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams of a whole text."""
    words = WORD.findall(text) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(hashed))
    n = len(hashed) - size + 1
    grams = np.full(n, np.uint64(size))
    for k in range(size):
        grams = mix64(grams ^ hashed[k : k + n])
    return np.unique(grams)


def _class_of(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128 bits that are equal for equal sets, as 16 bytes a set."""
    full = lengths > 0
    starts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]]).astype(np.int64) if full.any() else []
    out = np.zeros((len(lengths), 2), dtype=">u8")
    for half, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        if full.any():
            sums = np.add.reduceat(mix64(values ^ np.uint64(salt)), starts)
            out[full, half] = mix64(sums + lengths[full].astype(np.uint64))
    return out.view(np.uint8).reshape(len(lengths), 16)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_word_hash)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, stop in chunks(texts, _TEXT_CHARS):
                sets = [shingle_set(t, size, memo) for t in texts[start:stop]]
                lengths = np.array([len(s) for s in sets], dtype=np.int64)
                values = np.concatenate(sets)
                low = superminhash(values, lengths)
                keys = np.zeros((len(sets), BANDS), dtype=np.uint64)
                keys += np.arange(BANDS, dtype=np.uint64)
                for row in range(ROWS):
                    keys = mix64(keys ^ low[:, row::ROWS])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        batch.column(1).slice(start, stop - start),
                        pa.array(lengths),
                        binaries(_class_of(values, lengths)),
                        lists(keys.view(np.int64).ravel(), np.full(len(sets), BANDS), pa.int64()),
                        binaries((mix64(low) >> np.uint64(56)).astype(np.uint8)),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "class", "bands", "sketch"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_word_hash)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in chunks(texts, _TEXT_CHARS):
                sets = [shingle_set(t, size, memo) for t in texts[start:stop]]
                lengths = np.array([len(s) for s in sets], dtype=np.int64)
                values = np.concatenate(sets)
                yield pa.RecordBatch.from_arrays(
                    [binaries(_class_of(values, lengths)), lists(values.view(np.int64), lengths, pa.int64())],
                    names=["class", "grams"],
                )

    return run


@F.pandas_udf(T.FloatType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of slots in which two sketches agree."""
    if not len(a):
        return pd.Series([], dtype="float32")
    x = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(len(b), -1)
    return pd.Series((x == y).mean(axis=1).astype(np.float32))


class NearDuplicates:
    """Groups documents whose sets of word n-grams have a Jaccard similarity of ``percent``/100 or more.

    Documents with equal sets are one class; only classes are compared. Classes that agree in
    a band of their signatures meet in a bucket. A bucket's smallest class is compared with
    all the others first (a star), which joins groups of copies without forming their
    pairs; where a bucket still holds several components, its classes of different
    components are compared with each other. Buckets with more than ``GROUP`` classes
    beside their largest component are divided first, by the rarest n-grams of each set,
    of which any two linked sets share one. Links are
    confirmed on the full sets. With 30 bands of 5 slots a
    pair at 0.8 meets in no band, or is no candidate there, with a probability of 7e-6 in
    all, and one at 0.85 with 6e-8; no pair that meets is lost for the size of its bucket.

    Without words or text a document's set is empty and it is linked with nothing. Rows
    equal in id and text are one document; rows with a null id take part like all others.
    """

    def __init__(self, docs: DataFrame, size: int = 5, percent: int = 80) -> None:
        self.size, self.percent = size, percent
        self.docs = docs
        self.work = Work(docs.sparkSession)
        self._edges: list[DataFrame] = []
        self._found: tuple[int, DataFrame] | None = None

    def _signed(self) -> DataFrame:
        fields = "text_key long, n_shingles long, class binary, bands array<long>, sketch binary"
        given = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
        return self.work.keep(given.mapInArrow(_sign(self.size), f"doc_id long, {fields}"))

    def _members(self) -> DataFrame:
        """bucket and class, for buckets of two classes or more."""
        rows = self.classes.select(F.explode("bands").alias("bucket"), "class")
        return self._in_company(rows)

    def _in_company(self, rows: DataFrame) -> DataFrame:
        """Rows of buckets with several classes, with the bucket's smallest class as its leader.

        Counts and leaders are written first, so that both sides of the join are shuffled
        for it alone and Spark can split a hot bucket.
        """
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("leader"))
        return rows.join(self.work.keep(sizes.filter("n > 1")), "bucket").select("bucket", "class", "n", "leader")

    def _grams(self, wanted: DataFrame) -> DataFrame:
        """The full sets of some classes, from the text of one document of each."""
        keys = self.classes.join(wanted, "class", "left_semi").select("rep.doc_id", "rep.text_key")
        texts = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
        match = texts["doc_id"].eqNullSafe(keys["doc_id"]) & (texts["text_key"] == keys["text_key"])
        held = texts.join(keys, match, "left_semi").select("text")
        sets = held.mapInArrow(_sets(self.size), "class binary, grams array<long>")
        return self.work.keep(sets.dropDuplicates(["class"]))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (src, dst) of classes that are linked, checked on their full sets."""
        a = self.classes.select(F.col("class").alias("src"), F.col("sketch").alias("sketch_a"), F.col("size").alias("a"))
        b = self.classes.select(F.col("class").alias("dst"), F.col("sketch").alias("sketch_b"), F.col("size").alias("b"))
        near = pairs.distinct().join(a, "src").join(b, "dst")
        near = near.filter(100 * F.least("a", "b") >= self.percent * F.greatest("a", "b"))
        floor = self.percent / 100 - MARGIN
        near = self.work.keep(near.filter(_agreement("sketch_a", "sketch_b") >= floor).select("src", "dst"))
        grams = self._grams(near.select(F.col("src").alias("class")).union(near.select("dst")).distinct())
        left = grams.select(F.col("class").alias("src"), F.col("grams").alias("grams_a"))
        right = grams.select(F.col("class").alias("dst"), F.col("grams").alias("grams_b"))
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        checked = near.join(left, "src").join(right, "dst").select(
            "src", "dst", shared.alias("shared"), (F.size("grams_a") + F.size("grams_b")).alias("total")
        )
        linked = self.work.keep(
            checked.filter(F.lit(100) * F.col("shared") >= F.lit(self.percent) * (F.col("total") - F.col("shared")))
        )
        self.work.drop(near, grams)
        return linked.select("src", "dst")

    def _components(self) -> DataFrame:
        """Components of the links so far; kept until there are more links."""
        if self._found and self._found[0] == len(self._edges):
            return self._found[1]
        edges = self._edges[0]
        for more in self._edges[1:]:
            edges = edges.unionByName(more)
        self._found = len(self._edges), self.work.keep(components(edges, self.work))
        return self._found[1]

    def _spanning(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """Members of buckets that hold several components beside the leader, whose pairs are done.

        home is the bucket's largest component, others the number of rows of the rest.
        """
        known = found.select(F.col("node").alias("class"), "component")
        named = members.join(known, "class", "left").withColumn("component", F.coalesce("component", "class"))
        rest = named.filter(F.col("class") != F.col("leader"))
        parts = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = F.max(F.struct("n", "component")).alias("largest")
        homes = parts.groupBy("bucket").agg(largest, F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
        homes = homes.filter("parts > 1").select(
            "bucket", F.col("largest.component").alias("home"), (F.col("n") - F.col("largest.n")).alias("others")
        )
        return rest.select("bucket", "class", "component").join(homes, "bucket")

    def _within(self, members: DataFrame) -> DataFrame:
        """Links between different components of the same buckets, found on the full sets.

        Buckets with one home are compared together, so that each class's set is read once for all
        of them. Classes of the home are dealt into blocks, the others into blocks of their
        own, by the size of their sets; each pair of such blocks, and each pair of blocks
        of others, is a cell, which one task compares. With few others a set is
        in one or two cells.
        """
        rows = members.select("home", "class", "component").distinct()
        rows = rows.join(self.classes.select("class", "size"), "class")
        own = F.col("component") == F.col("home")
        rows = self.work.keep(rows.withColumn("own", own))

        def blocks(condition) -> Column:
            total = F.coalesce(F.sum(F.when(condition, F.col("size"))), F.lit(0))
            return F.greatest(F.ceil(total / F.lit(CELL_GRAMS)), F.lit(1)).cast("int")

        counts = rows.groupBy("home").agg(blocks(F.col("own")).alias("owns"), blocks(~F.col("own")).alias("others"))
        dealt = rows.join(counts, "home").withColumn(
            "block", F.pmod(F.xxhash64("class"), F.when(F.col("own"), F.col("owns")).otherwise(F.col("others")))
        )

        def cell(kind: str, first, second) -> Column:
            return F.xxhash64("home", F.lit(kind), first, second)

        def upto(n: str) -> Column:
            return F.sequence(F.lit(0), F.col(n) - 1)

        across = F.when(
            F.col("own"), F.transform(upto("others"), lambda x: cell("home", F.col("block"), x.cast("long")))
        ).otherwise(F.transform(upto("owns"), lambda x: cell("home", x.cast("long"), F.col("block"))))
        among = F.when(
            ~F.col("own"),
            F.transform(
                upto("others"),
                lambda x: cell("rest", F.least(F.col("block"), x.cast("long")), F.greatest(F.col("block"), x.cast("long"))),
            ),
        ).otherwise(F.array().cast("array<long>"))
        cells = dealt.select("class", "component", "own", F.explode(F.concat(across, among)).alias("cell"))
        grams = self._grams(rows.select("class").distinct())
        wide = cells.join(grams, "class").repartition("cell").sortWithinPartitions("cell")
        percent = self.percent

        def links(names: list, part: np.ndarray, own: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> list:
            ids = np.unique(flat, return_inverse=True)[1]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            mark = np.zeros(int(ids.max()) + 1, dtype=np.int64)
            found = []
            for i in np.flatnonzero(~own):
                mine = ids[starts[i] : ends[i]]
                mark[mine] = 1
                shared = np.add.reduceat(mark[ids], starts)
                mark[mine] = 0
                alike = 100 * shared >= percent * (sizes + sizes[i] - shared)
                linked = np.flatnonzero(alike & (part != part[i]))
                # one link to each other component will do
                for j in linked[np.unique(part[linked], return_index=True)[1]]:
                    found.append((max(names[i], names[j]), min(names[i], names[j])))
            return found

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in by_value(batches, "cell"):
                grams = table.column("grams").combine_chunks()
                pairs = links(
                    table.column("class").to_pylist(),
                    table.column("component").combine_chunks().dictionary_encode().indices.to_numpy(),
                    table.column("own").to_numpy(),
                    grams.flatten().to_numpy(),
                    grams.value_lengths().to_numpy().astype(np.int64),
                )
                if pairs:
                    src, dst = zip(*pairs, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(src, pa.binary()), pa.array(dst, pa.binary())], names=["src", "dst"]
                    )

        return self.work.keep(wide.mapInArrow(run, "src binary, dst binary").distinct())

    def _split(self, members: DataFrame) -> DataFrame:
        """Large buckets divided by prefixes: two sets that are linked share one of their rarest n-grams.

        In any order of n-grams that all sets of a bucket follow, here from the rarest in the
        bucket, the first n - ceil(percent/100 n) + 1 of a set of n hold one that a
        linked set has among its own first ones, as it shares all but n - ceil(percent/100 n) at most.
        """
        rows = members.select("bucket", "class").distinct()
        grams = self._grams(rows.select("class").distinct())
        every = rows.join(grams, "class").select(
            "bucket", "class", F.size("grams").alias("size"), F.explode("grams").alias("gram")
        )
        held = every.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("held"))
        own = Window.partitionBy("bucket", "class").orderBy("held", "gram")
        ranked = every.join(held, ["bucket", "gram"]).withColumn("rank", F.row_number().over(own))
        needed = F.col("size") - F.floor((F.lit(self.percent) * F.col("size") + 99) / 100) + 1
        first = ranked.filter(F.col("rank") <= needed)
        return self._in_company(first.select(F.xxhash64("bucket", "gram").alias("bucket"), "class"))

    def grouped(self) -> DataFrame:
        """doc_id, text_key, n_shingles, component (a class) and component_id of each row of documents.

        component_id is the smallest id reachable by links, itself included; null ids are not
        counted, and a group of null ids only has a null component_id.
        """
        signed = self._signed()
        rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("rep")
        self.classes = self.work.keep(
            signed.filter("n_shingles > 0")
            .groupBy("class")
            .agg(rep, F.min("doc_id").alias("low_id"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        )
        members, depth = self.work.keep(self._members()), 0
        while True:
            star = members.filter(F.col("class") != F.col("leader"))
            self._edges.append(self._confirmed(star.select(F.col("class").alias("src"), F.col("leader").alias("dst"))))
            rest = self.work.keep(self._spanning(members, self._components()))
            if not rest.head(1):
                break
            # what is large even then is compared in cells like all others
            now = rest if depth else rest.filter(F.col("others") <= GROUP)
            self._edges.append(self._within(now))
            large = rest.filter(F.col("others") > GROUP)
            if depth or not large.head(1):
                break
            members, depth = self.work.keep(self._split(large)), depth + 1
        found = self._components()
        low = self.classes.select("class", "low_id").join(
            found.select(F.col("node").alias("class"), "component"), "class", "left"
        )
        low = low.select("class", "low_id", F.coalesce("component", "class").alias("component"))
        best = low.groupBy("component").agg(F.min("low_id").alias("component_id"))
        ids = low.join(best, "component").select("class", "component", "component_id")
        rows = signed.select("doc_id", "text_key", "n_shingles", "class")
        linked = rows.filter("n_shingles > 0").join(ids, "class")
        alone = rows.filter("n_shingles = 0").withColumns(
            {"component": F.lit(None).cast("binary"), "component_id": F.col("doc_id")}
        )
        names = ["doc_id", "text_key", "n_shingles", "component", "component_id"]
        return linked.select(*names).unionByName(alone.select(*names))


def near_duplicate_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs; see NearDuplicates.

    kept is true for the row whose id is the component's; ids are compared null-safe.
    """
    grouped = NearDuplicates(docs, size, percent).grouped()
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return grouped.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group: that of the smallest id, then the smallest text hash.

    Rows equal in id and text are one document and leave one row, that with the smallest hash of
    all its columns; documents without words all stay. Columns beside doc_id and text pass through.
    """
    work = NearDuplicates(docs, size, percent)
    grouped = work.grouped()
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    with_words = grouped.filter("n_shingles > 0").groupBy("component").agg(F.min(order).alias("best"))
    without = grouped.filter("n_shingles = 0").select(order.alias("best"))
    best = with_words.select("best").unionByName(without)
    best = work.work.keep(best.select("best.doc_id", "best.text_key").distinct())
    key, mark = fresh(docs, "text_key"), fresh(docs, "row_hash")
    rest = [F.col(c).cast("string") if "map" in kind else F.col(c) for c, kind in docs.dtypes if c != "text"]
    keyed = docs.withColumns({key: text_key(), mark: F.xxhash64(*rest)})
    chosen = keyed.groupBy("doc_id", key).agg(F.min(mark).alias("row"))
    met = chosen["doc_id"].eqNullSafe(best["doc_id"]) & (chosen[key] == best["text_key"])
    keys = work.work.keep(chosen.join(best, met, "left_semi").select("doc_id", F.col(key).alias("text_key"), "row"))
    same = keyed["doc_id"].eqNullSafe(keys["doc_id"]) & (keyed[key] == keys["text_key"]) & (keyed[mark] == keys["row"])
    # rows equal in all columns are left
    return keyed.join(keys, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key, mark)
