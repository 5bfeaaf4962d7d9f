"""Exact repeats of long byte strings by a run-length index.

The corpus is far larger than an index in one task may be, so strings are first dealt
out. Of every WIDTH bytes the smallest hash of their GRAM-byte strings is taken (the
leftmost of equal ones): equal strings choose the same place. Neighbouring strings that
choose one place are a stretch; only stretches that share their chosen string with
another one can repeat. Of equal stretches the first in document order stands for
all; different stretches with the same chosen string meet in a run-length index, which
tells which of their strings began earlier.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Work, lists, mix64, remove, ship

WIDTH = 100
GRAM = 32
#: bytes hashed at a time, samples sent at a time, bytes of one index (unless one chosen string has more)
HASHED, SENT, INDEXED = 1 << 19, 400_000, 1_200_000
#: texts with a hash divisible by this are looked at for chosen strings to be divided; results do not depend on it
LOOKED_AT = 32
#: chosen strings with more than this share of a partition's stretches are divided
CROWDED = 0.1
#: texts that this share of all documents are copies of; there are at most 1 / COPIED of them
COPIED = 0.001
END = 0xFF  # no byte of UTF-8
_NEVER = np.iinfo(np.int64).max
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_BYTE = mix64(np.arange(256, dtype=np.uint64))


# --- stretches ----------------------------------------------------------------------


class Stretches(NamedTuple):
    """Runs of neighbouring strings that choose the same place.

    doc: its number in the batch; start: of the first string in the document; count: of
    strings; key: hash of what they share; whole: hash of all their bytes.
    """

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    whole: np.ndarray

    def take(self, chosen: np.ndarray) -> Stretches:
        return Stretches(*(x[chosen] for x in self))

    @staticmethod
    def joined(parts: list[Stretches]) -> Stretches:
        return Stretches(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place, by doubling."""
    hashed, size = _BYTE[data], 1
    while size < GRAM:
        odd = _ODD[size.bit_length() % 4]
        hashed = hashed[:-size] * odd + hashed[size:]
        hashed ^= hashed >> np.uint64(29)
        size *= 2
    return hashed


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of width neighbouring values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def _span_hash(grams: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of length bytes (64 to 192) from each start: of grams that cover them."""
    out = mix64(length.astype(np.uint64))
    middle = start + length // 2
    places = [start, start + GRAM, middle - GRAM, middle, start + length - 2 * GRAM, start + length - GRAM]
    for i, at in enumerate(places):
        out = (out ^ mix64(grams[at] + _ODD[i % 4])) * _ODD[(i + 1) % 4]
        out ^= out >> np.uint64(31)
    return mix64(out)


def _divided(grams: np.ndarray, anchor: np.ndarray, found: Stretches, at: np.ndarray, hot: np.ndarray):
    """Stretches with a crowded key become two, whose strings share a longer part around what was chosen.

    Half of the bytes that a string has beside the shared part lie on its left or on its
    right; the part grows to that side. Repeated until no key is crowded: at last the part is the string.
    """
    size = np.full(len(anchor), GRAM)
    while len(hot):
        crowded = np.isin(found.key, hot) & (size < WIDTH)
        if not crowded.any():
            break
        rest, (a, c, s) = ~crowded, (at[crowded], anchor[crowded], size[crowded])
        count, grow = found.count[crowded], (WIDTH - s + 1) // 2
        left = np.clip(c - grow - a + 1, 0, count)  # strings that begin early enough to hold the longer part
        parts = []
        for keep, move, begin, number in ((left > 0, grow, a, left), (left < count, 0 * grow, a + left, count - left)):
            doc, start = found.doc[crowded][keep], (found.start[crowded] + begin - a)[keep]
            begin, number, longer, place = begin[keep], number[keep], (s + grow)[keep], (c - move)[keep]
            key = _span_hash(grams, place, longer)
            whole = _span_hash(grams, begin, number + WIDTH - 1)
            parts.append((Stretches(doc, start, number, key, whole), begin, place, longer))
        found = Stretches.joined([found.take(rest), *(p[0] for p in parts)])
        at, anchor, size = (
            np.concatenate([old[rest], *(p[i] for p in parts)]) for i, old in ((1, at), (2, anchor), (3, size))
        )
    return found


def stretches(texts: list[bytes], hot: np.ndarray) -> Iterator[Stretches]:
    """The stretches of some texts; hot are the keys to be divided, sorted."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(bytearray().join(texts), dtype=np.uint8)
    ends = np.cumsum(lengths)
    places = np.uint64((1 << 20) - 1)
    for low in range(0, max(len(data) - WIDTH + 1, 0), HASHED):
        grams = _grams(data[low : low + HASHED + WIDTH - 1])
        ranked = (mix64(grams) & ~places) | np.arange(len(grams), dtype=np.uint64)
        chosen = (_least(ranked, WIDTH - GRAM + 1) & places).astype(np.int64)
        begins = np.arange(low, low + len(chosen))
        doc = np.searchsorted(ends, begins, side="right")
        inside = begins + WIDTH <= ends[np.minimum(doc, len(ends) - 1)]
        first = inside.copy()
        first[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        counted = np.append(0, np.cumsum(inside))
        count = counted[np.append(at[1:], len(chosen))] - counted[at]
        anchor = chosen[at]
        owner = doc[at]
        start = at + low - (ends[owner] - lengths[owner])
        found = Stretches(
            owner, start, count, mix64(grams[anchor] ^ _ODD[3]), _span_hash(grams, at, count + WIDTH - 1)
        )
        yield _divided(grams, anchor, found, at, hot)


# --- the run-length index -----------------------------------------------------------


class RunIndex:
    """The run-compressed Burrows-Wheeler transform of some strings, with samples at its run ends.

    The strings are joined, each with an end mark of its own that is smaller than any
    byte and than the marks after it. Where two neighbouring suffixes are preceded by the
    same byte, the suffixes one byte longer are neighbours too; so for each place of the
    text its neighbour and the length of what both share follow from the last place
    before it that begins a run. Only those are kept.
    """

    def __init__(self, strings: list[bytes]) -> None:
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        text = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8)
        starts = np.cumsum(lengths + 1) - lengths - 1
        self.size, self.starts, self.lengths = len(text), starts, lengths
        left = np.repeat(starts + lengths, lengths + 1) - np.arange(len(text))  # bytes to the end mark
        order = self._suffixes(text, left)
        before = text[order - 1]
        head = np.append(True, before[1:] != before[:-1]) | (before == END)
        self.run_bytes, self.run_lengths = before[head], np.diff(np.append(np.flatnonzero(head), len(text)))
        heads = np.flatnonzero(head)
        place, other = order[heads], order[np.maximum(heads - 1, 0)]
        shared = self._common(text, left, place, other)
        shared[heads == 0] = 0
        by_place = np.argsort(place)
        self.sampled, self.other, self.shared = place[by_place], other[by_place], shared[by_place]

    @staticmethod
    def _suffixes(text: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Places in the order of their suffixes; equal rests of strings in text order."""
        n, size = len(text), 1
        rank = np.where(left > 0, text.astype(np.int64) + 1, 0)
        bits = max(int(n).bit_length(), 9)
        places = np.arange(n)
        longest = int(left.max(initial=0)) + 1
        while True:
            after = np.zeros(n, dtype=np.int64)
            inside = np.flatnonzero(left > size)
            after[inside] = rank[inside + size] + 1
            after[(left == size)] = 1  # the end mark comes next
            if 3 * bits + 1 <= 64:
                packed = (rank.view(np.uint64) << np.uint64(2 * bits + 1)) | ((after << bits) | places).view(np.uint64)
                order = (np.sort(packed) & np.uint64((1 << bits) - 1)).view(np.int64)
            else:
                order = np.lexsort((after, rank))
            r, a = rank[order], after[order]
            new = np.append(0, np.cumsum((r[1:] != r[:-1]) | (a[1:] != a[:-1])))
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            size *= 2
            if size >= longest or new[-1] == n - 1:
                return order

    @staticmethod
    def _common(text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the strings have in common from places a and b, within both strings."""
        most = np.minimum(left[a], left[b])
        padded = np.append(text, np.zeros(8, dtype=np.uint8))
        words = np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded.tobytes(), strides=(1,))
        same = np.zeros(len(a), dtype=np.int64)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            differ = words[a[open_] + same[open_]] ^ words[b[open_] + same[open_]]
            low = differ & (~differ + np.uint64(1))
            step = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) // 8)
            same[open_] += step
            open_ = open_[(differ == 0) & (same[open_] < most[open_])]
        return np.minimum(same, most)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Streamed in text order: the place before each in the order of suffixes, and what both share."""
        gaps = np.diff(np.append(self.sampled, self.size))
        beyond = np.arange(self.size) - np.repeat(self.sampled, gaps)
        return np.repeat(self.other, gaps) + beyond, np.repeat(self.shared, gaps) - beyond

    def earlier(self, width: int) -> np.ndarray:
        """For each place, whether a string of width bytes from it also starts at an earlier place."""
        other, shared = self.statistics()
        place = np.arange(self.size)
        root = np.where(shared >= width, other, place)
        while True:  # the chain of neighbours that share enough ends at the first of them
            further = root[root]
            if (further == root).all():
                break
            root = further
        first = np.empty(self.size, dtype=np.int64)
        first[root[::-1]] = place[::-1]
        return first[root] < place


# --- over the corpus ----------------------------------------------------------------

_TEXT_KEY = "t1 long, t2 long, id long"


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, text (null: empty), its SHA-256 and 120 bits of it as two numbers."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), body.alias("text"))
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))

    def number(start: int) -> Column:
        return F.conv(F.substr("sha", F.lit(start), F.lit(15)), 16, 10).cast("long")

    return rows.withColumns({"t1": number(1), "t2": number(16)})


def _packed(rows: pa.RecordBatch, found: Stretches, repeated: Stretches, parts: int) -> Iterator[pa.RecordBatch]:
    """A row for each part with lists of its stretches; those known to be repeats go to any part, without a key."""
    known = Stretches.joined([found, repeated._replace(key=mix64(repeated.doc.astype(np.uint64)))])
    plain = np.append(np.zeros(len(found.doc), bool), np.ones(len(repeated.doc), bool))
    part = ((known.key >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((known.doc, part))
    part, known, plain = part[order], known.take(order), plain[order]
    cuts = np.append(0, np.flatnonzero(part[1:] != part[:-1]) + 1)
    sizes = np.diff(np.append(cuts, len(part)))
    new = np.append(True, (known.doc[1:] != known.doc[:-1]) | (part[1:] != part[:-1]))
    docs = np.add.reduceat(new.astype(np.int64), cuts)
    local = np.cumsum(new) - 1 - np.repeat(np.cumsum(docs) - docs, sizes)
    taken = rows.take(pa.array(known.doc[new]))
    offsets = pa.array(np.append(0, np.cumsum(docs)).astype(np.int32))

    def of_docs(name: str) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, taken.column(name))

    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part[cuts].astype(np.int32)),
            *(of_docs(c) for c in ("t1", "t2", "id")),
            lists(local.astype(np.int32), sizes, pa.int32()),
            lists(known.start.astype(np.int32), sizes, pa.int32()),
            lists(np.where(plain, -known.count, known.count).astype(np.int8), sizes, pa.int8()),
            lists(known.key.view(np.int64), sizes, pa.int64()),
            lists(known.whole.view(np.int64), sizes, pa.int64()),
        ],
        names=["part", "t1", "t2", "id", "doc", "start", "count", "key", "whole"],
    )


_SENT = (
    "part int, t1 array<long>, t2 array<long>, id array<long>, "
    "doc array<int>, start array<int>, count array<byte>, key array<long>, whole array<long>"
)


def _ordered(ids: pa.Array, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """The rank of each document: by id, null ids last, then by text key."""
    null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
    order = np.lexsort((t2, t1, ids.fill_null(0).to_numpy(zero_copy_only=False), null))
    new = np.append(0, np.cumsum((t1[order][1:] != t1[order][:-1]) | (t2[order][1:] != t2[order][:-1])))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = new
    return rank


def _firsts(found: Stretches, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches sorted by key, bytes and document order; which are the first of equal ones; which begin a key."""
    order = np.lexsort(((rank[found.doc] << 32) | found.start, found.whole, found.key))
    key, whole = found.key[order], found.whole[order]
    new_key = np.append(True, key[1:] != key[:-1])
    return order, new_key | np.append(True, whole[1:] != whole[:-1]), new_key


def _bodies(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _sample(parts: int, hot: np.ndarray):
    """Stretches of a stream of texts, dealt to parts by their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        found: list[Stretches] = []
        rows = size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            docs = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            t1, t2 = (docs.column(c).to_numpy() for c in ("t1", "t2"))
            some = Stretches.joined(found)
            order, first, _ = _firsts(some, _ordered(docs.column("id"), t1, t2))
            yield from _packed(docs, some.take(order[first]), some.take(order[~first]), parts)

        for batch in batches:
            texts, at = _bodies(batch), 0
            while at < len(texts):
                end, total = at, 0
                while end < len(texts) and total < HASHED:
                    total += len(texts[end])
                    end += 1
                held.append(batch.slice(at, end - at).select(["t1", "t2", "id"]))
                for part in stretches(texts[at:end], hot):
                    found.append(part._replace(doc=part.doc + rows))
                    size += len(part.doc)
                rows += end - at
                at = end
                if size >= SENT:
                    yield from sent()
                    held, found, rows, size = [], [], 0, 0
        if size:
            yield from sent()

    return run


_FOUND = f"{_TEXT_KEY}, start array<int>, count array<byte>, key array<long>"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All stretches of some keys: repeats of a whole stretch have a negative count, those to be compared a key."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    column = {c: rows.column(c).chunk(0) for c in rows.schema.names if c != "part"}
    docs = column["t1"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    each = column["doc"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = {c: x.flatten() for c, x in column.items()}
    t1, t2 = (flat[c].to_numpy(zero_copy_only=False) for c in ("t1", "t2"))
    rank = _ordered(flat["id"], t1, t2)
    doc = flat["doc"].to_numpy(zero_copy_only=False) + np.repeat(np.cumsum(docs) - docs, each)
    start, count, key, whole = (
        flat[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "count", "key", "whole")
    )
    every = Stretches(doc, start, count, key, whole)
    plain = every.take(count < 0)
    found = every.take(count > 0)
    out = [(plain.doc, plain.start, plain.count, 0 * plain.key)]
    if len(found.doc):
        order, first, new_key = _firsts(found, rank)
        found = found.take(order)
        group = np.cumsum(new_key) - 1
        kinds = np.bincount(group, weights=first)
        again = ~first
        out.append((found.doc[again], found.start[again], -found.count[again], 0 * found.key[again]))
        compare = first & (kinds[group] > 1)
        out.append((found.doc[compare], found.start[compare], found.count[compare], found.key[compare]))
    doc, start, count, key = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((start, rank[doc]))
    doc, start, count, key = (x[order] for x in (doc, start, count, key))
    if not len(doc):
        return
    cuts = np.append(0, np.flatnonzero(rank[doc][1:] != rank[doc][:-1]) + 1)
    sizes = np.diff(np.append(cuts, len(doc)))
    of = pa.array(doc[cuts])
    yield pa.RecordBatch.from_arrays(
        [
            *(flat[c].take(of) for c in ("t1", "t2", "id")),
            lists(start.astype(np.int32), sizes, pa.int32()),
            lists(count.astype(np.int8), sizes, pa.int8()),
            lists(key, sizes, pa.int64()),
        ],
        names=["t1", "t2", "id", "start", "count", "key"],
    )


_SLICE = f"key long, {_TEXT_KEY}, start int, bytes binary"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches to be compared."""
    for batch in batches:
        for i, text in enumerate(_bodies(batch)):
            own = [
                (key, start, count)
                for piece in batch.column("pieces")[i].as_py()
                for key, start, count in zip(piece["key"], piece["start"], piece["count"], strict=True)
                if count > 0
            ]
            if not own:
                continue
            n = len(own)
            refs = (pa.array([batch.column(c)[i].as_py()] * n, pa.int64()) for c in ("t1", "t2", "id"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in own], pa.int64()),
                    *refs,
                    pa.array([s for _, s, _ in own], pa.int32()),
                    pa.array([text[s : s + c + WIDTH - 1] for _, s, c in own], pa.binary()),
                ],
                names=["key", "t1", "t2", "id", "start", "bytes"],
            )


_SPAN = "t1 long, t2 long, start array<int>, stop array<int>"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes covered by strings that began earlier, of a stream of stretches sorted by key.

    An index has whole keys and about INDEXED bytes.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def spans() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        t1, t2, start = (rows.column(c).to_numpy().astype(np.int64) for c in ("t1", "t2", "start"))
        order = np.lexsort((start, _ordered(rows.column("id"), t1, t2)))
        index = RunIndex(rows.column("bytes").take(pa.array(order)).to_pylist())
        again = np.flatnonzero(index.earlier(WIDTH))
        owner = np.searchsorted(index.starts, again, side="right") - 1
        if not len(again):
            return
        first = np.append(True, (np.diff(again) != 1) | (np.diff(owner) != 0))
        last = np.append(first[1:], True)
        row = order[owner[first]]
        begin = start[row] + again[first] - index.starts[owner[first]]
        end = start[row] + again[last] - index.starts[owner[last]] + WIDTH
        ones = np.ones(len(row), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(t1[row]),
                pa.array(t2[row]),
                lists(begin.astype(np.int32), ones, pa.int32()),
                lists(end.astype(np.int32), ones, pa.int32()),
            ],
            names=["t1", "t2", "start", "stop"],
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            rows = batch.slice(at, 1000)
            if size >= INDEXED:
                keys = rows.column("key").to_numpy()
                cut = int(np.searchsorted(keys, held[-1].column("key")[-1].as_py(), side="right"))
                if cut:
                    held.append(rows.slice(0, cut))
                if cut == len(keys):
                    continue
                yield from spans()
                held, size, rows = [], 0, rows.slice(cut)
            held.append(rows)
            size += rows.column("bytes").nbytes
    if held:
        yield from spans()


_CUT = "t1 long, t2 long, first long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in batches:
        out = []
        for i, text in enumerate(_bodies(batch)):
            starts, stops = [], []
            for piece in batch.column("pieces")[i].as_py() or []:
                starts += piece["start"]
                stops += piece["stop"]
            spans: list[list[int]] = []
            for start, stop in sorted(zip(starts, stops, strict=True)):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([start, stop])
            digest, at = hashlib.sha256(), 0
            for start, stop in spans:
                digest.update(text[at:start])
                at = stop
            digest.update(text[at:])
            removed = sum(stop - start for start, stop in spans)
            out.append((removed, len(spans), digest.hexdigest(), [{"start": a, "stop": b} for a, b in spans]))
        removed, number, digests, spans = zip(*out, strict=True) if out else ((), (), (), ())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("t1", "t2", "id")),
                pa.array(removed, pa.int64()),
                pa.array(number, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(spans, kind),
            ],
            names=["t1", "t2", "first", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


class Repeats:
    """The steps over one corpus; its distinct texts lie in a table bucketed by their key."""

    def __init__(self, docs: DataFrame, work: Work, key: str, text: str) -> None:
        self.spark, self.work = docs.sparkSession, work
        ship(self.spark)
        self.docs = keyed(docs, key, text)
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.path = f"texts_{uuid.uuid4().hex}", f"{work.folder}/texts-{uuid.uuid4().hex[:8]}"

    def _texts(self) -> DataFrame:
        """Each distinct text once, with its smallest id; all later steps find it in its bucket."""
        texts = self.docs.groupBy("t1", "t2").agg(F.min("id").alias("id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
        writer = texts.write.bucketBy(self.parts, "t1", "t2").format("parquet").option("compression", "zstd")
        writer.option("path", self.path).saveAsTable(self.name)
        return self.spark.table(self.name)

    def _crowded(self, texts: DataFrame) -> np.ndarray:
        """Keys that many different stretches share, counted on some of the texts, with what they are divided into.

        They only decide how the work is dealt out; there are at most parts / CROWDED for each length.
        """
        looked = texts.filter(F.col("t1") % LOOKED_AT == 0)
        hot = np.zeros(0, dtype=np.uint64)
        for _ in range(8):
            known = hot

            def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for some in stretches(_bodies(batch), known) if batch.num_rows else ():
                        yield pa.RecordBatch.from_pydict({"key": some.key.view(np.int64), "whole": some.whole.view(np.int64)})

            kinds = looked.mapInArrow(run, "key long, whole long").distinct().groupBy("key").count()
            kinds = self.work.keep(kinds.filter("count > 1"))
            total = kinds.agg(F.sum("count")).first()[0] or 0
            least = max(16, CROWDED * total / self.parts)
            more = [r["key"] for r in kinds.filter(F.col("count") > least).select("key").collect()]
            self.work.drop(kinds)
            new = np.setdiff1d(np.array(more, dtype=np.int64).view(np.uint64), hot)
            if not len(new):
                break
            hot = np.union1d(hot, new)
        return hot

    def _pieces(self, rows: DataFrame, names: list[str]) -> DataFrame:
        return rows.groupBy("t1", "t2").agg(F.collect_list(F.struct(*names)).alias("pieces"))

    def cut(self) -> DataFrame:
        """For each distinct text that loses bytes: its first id, spans, counts and the digest of what is left."""
        texts = self._texts()
        hot = self._crowded(texts)
        sent = texts.mapInArrow(_sample(self.parts, hot), _SENT)
        found = self.work.keep(sent.repartition("part").mapInArrow(_meet, _FOUND))
        open_ = found.filter(F.exists("key", lambda k: k != 0))
        slices = texts.join(self._pieces(open_, ["key", "start", "count"]), ["t1", "t2"]).mapInArrow(_slices, _SLICE)
        judged = slices.repartition("key").sortWithinPartitions("key").mapInArrow(_indexed, _SPAN)
        again = F.filter(F.arrays_zip("start", "count"), lambda s: s["count"] < 0)
        whole = found.select("t1", "t2", again.alias("a")).filter(F.size("a") > 0)
        whole = whole.select(
            "t1",
            "t2",
            F.transform("a", lambda s: s["start"]).alias("start"),
            F.transform("a", lambda s: s["start"] - s["count"].cast("int") + F.lit(WIDTH - 1)).alias("stop"),
        )
        spans = self.work.keep(judged.unionByName(whole))
        cut = texts.join(self._pieces(spans, ["start", "stop"]), ["t1", "t2"]).mapInArrow(_cut, _CUT)
        cut = self.work.keep(cut)
        self.work.drop(found, spans)
        return cut

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)


def without_repeats(docs: DataFrame, work: Work, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document what is left without the bytes of strings of WIDTH bytes that also begin earlier.

    Earlier is in a document with a smaller id, or in the same one before. Null ids come
    after all others; documents of one id and different texts follow in the order
    of their SHA-256; rows equal in id and text are one document and get the same result.
    Null texts are empty ones; texts under WIDTH bytes lose nothing. Other columns are
    not read. Equality of strings is that of two 64-bit hashes where whole stretches are
    equal, and of the bytes elsewhere.

    Returns the key, n_bytes, n_removed, n_spans, kept_sha256 and spans (places of the
    removed bytes, from start up to stop).
    """
    repeats = Repeats(docs, work, key, text)
    cut = repeats.cut()
    firsts = repeats.spark.table(repeats.name).select("t1", "t2", F.col("id").alias("first"), "n")
    known = work.keep(firsts.join(cut.drop("first"), ["t1", "t2"], "left"))
    repeats.close()
    size = F.octet_length("text").cast("long")
    rows = work.keep(repeats.docs.select("id", "t1", "t2", "sha", size.alias("n_bytes")))
    copied = F.col("n") >= COPIED * rows.count()
    met = [rows.join(k, ["t1", "t2"]) for k in (F.broadcast(known.filter(copied)), known.filter(~copied))]
    rows = met[0].unionByName(met[1])
    copy = ~F.col("id").eqNullSafe(F.col("first")) & (F.col("n_bytes") >= WIDTH)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))

    def choose(of_copy: Column, of_first: Column) -> Column:
        return F.when(copy, of_copy).otherwise(of_first)

    return rows.select(
        F.col("id").alias(key),
        "n_bytes",
        choose(F.col("n_bytes"), F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        choose(F.lit(1), F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        choose(F.sha2(F.lit(b""), 256), F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        choose(everything, F.coalesce("spans", none)).alias("spans"),
    )
