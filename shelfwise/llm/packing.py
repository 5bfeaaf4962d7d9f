"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search."""

from __future__ import annotations

import base64
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm.common import Memo, Work, chunks

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: pieces packed together in one task; a task's last sequence may stay underfull
CELL_PIECES = 40_000
_TEXT_CHARS = 2_000_000
_CUT = len(np.zeros(1, "<u4").tobytes())
#: a blank and what some engine may take for more white space: where words may not be cut apart
_BLANK_RUN = re.compile(
    r" (?=[\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]|$)"
)


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers, equal to those of the tokenizer library.

    A blank before any other character than white space always begins a new piece of the
    tokenizer's pattern, so texts are cut there and the ids of a word are
    remembered; unknown words are merged by the same ranks in ``tiktoken``. Texts with
    runs of blanks or with a special token's string go through the tokenizer as a whole.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        added = json.loads(self.tokenizer.to_str())["added_tokens"]
        self.special = [token["content"] for token in added]
        self.memo = Memo(self._word, 400_000)

    def _word(self, word: str) -> bytes:
        return np.asarray(self.fast.encode_ordinary(word), dtype="<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _BLANK_RUN.search(text) or any(s in text for s in self.special):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        head, *rest = text.split(" ")
        found = self.memo.__getitem__
        return b"".join([found(head), *map(found, [" " + word for word in rest])])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, ranks: str) -> Encoder:
    """One encoder a process, as its memory of words serves all its tasks."""
    key = (vocabulary, ranks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, ranks)
    return _ENCODERS[key]


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first of several may be shorter than the capacity."""
    first = (tokens - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, tokens, capacity))]


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end: int = END,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32 bit) of whole texts.

    A null or empty text is the end id alone. A text of any length is read whole; memory is
    that of one text and its ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks).ids
        last = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, stop in chunks(texts, _TEXT_CHARS):
                rows, numbers, starts, lengths, data = [], [], [], [], []
                for row in range(start, stop):
                    tokens = encode(texts[row]) + last
                    for number, (at, length) in enumerate(cut(len(tokens) // _CUT, capacity)):
                        rows.append(row)
                        numbers.append(number)
                        starts.append(at)
                        lengths.append(length)
                        data.append(tokens[at * _CUT : (at + length) * _CUT])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows, pa.int64())),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return given.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: the longest item first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit f: there is a bin with f free
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[item]
        fits = mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            target = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            free, target = capacity, len(bins)
            bins.append([])
        bins[target].append(item)
        by_free[free - length].append(target)
        mask |= 1 << (free - length)
    return bins


class LocalSearch:
    """Moves and exchanges between underfull bins, each of which raises the sum of squared fills.

    With d tokens going from bin b to bin a, the sum rises if fill(b) < fill(a) + d. A bin
    takes an item that fits whole (a move), a longer item for one of its own (one for
    one), or two items of another bin for one (two for one); the largest gain that fits is
    taken. Emptied bins go. A pass asks every underfull bin, the fullest first, and passes are
    made until none changes anything: at first a bin that has taken all it can gives no more
    in its pass, at last all give. The sum is a whole number with an upper bound, so
    this ends, and it ends where no single change is left.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int) -> None:
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = [sum(lengths[i] for i in items) for items in bins]

    def _open(self) -> None:
        """Offer the items of all underfull bins, and the totals of two items of one bin."""
        self.open = {b for b, items in enumerate(self.bins) if items and self.fill[b] < self.capacity}
        self.items: list[dict[int, None]] = [{} for _ in range(self.capacity + 1)]
        self.totals: list[dict[int, None]] = [{} for _ in range(2 * self.capacity + 1)]
        self.single = self.double = 0
        self.place = {}
        for b in self.open:
            for i in self.bins[b]:
                self._offer(i, b)
            kinds = self._kinds(b)
            for k, x in enumerate(kinds):
                for y in kinds[: k + 1]:
                    self._offer_total(x + y, b)

    def _kinds(self, b: int) -> list[int]:
        return sorted({self.lengths[i] for i in self.bins[b]})

    def _offer(self, item: int, b: int) -> None:
        length = self.lengths[item]
        self.place[item] = b
        self.items[length][item] = None
        self.single |= 1 << length

    def _offer_total(self, total: int, b: int) -> None:
        if total <= 2 * self.capacity:
            self.totals[total][b] = None
            self.double |= 1 << total

    def _withdraw(self, b: int) -> None:
        self.open.discard(b)
        for item in self.bins[b]:
            own = self.items[self.lengths[item]]
            own.pop(item, None)
            if not own:
                self.single &= ~(1 << self.lengths[item])

    def _longest(self, low: int, high: int, taker: int, base: int) -> int | None:
        """An offered item of low < length <= high, from a bin that gains by giving it for base tokens."""
        open_ = self.single & ((1 << (high + 1)) - 1)
        while (length := open_.bit_length() - 1) > low:
            limit = self.fill[taker] + length - base
            for item in self.items[length]:
                giver = self.place[item]
                if giver != taker and self.fill[giver] < limit:
                    return item
            open_ ^= 1 << length
        return None

    def _two(self, b: int, total: int) -> tuple[int, int] | None:
        """Two items of a bin with a total; bins are small."""
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            if (other := seen.get(total - self.lengths[i])) is not None:
                return other, i
            seen[self.lengths[i]] = i
        return None

    def _pair(self, low: int, high: int, taker: int, base: int) -> tuple[int, int] | None:
        """Two offered items of one bin with low < total <= high; totals that a bin no longer has are forgotten."""
        open_ = self.double & ((1 << (high + 1)) - 1)
        while (total := open_.bit_length() - 1) > low:
            gone, found = [], None
            limit = self.fill[taker] + total - base
            for giver in self.totals[total]:
                if giver == taker or self.fill[giver] >= limit and giver in self.open:
                    continue
                found = self._two(giver, total) if giver in self.open else None
                if found:
                    break
                gone.append(giver)
            for giver in gone:
                del self.totals[total][giver]
            if not self.totals[total]:
                self.double &= ~(1 << total)
            if found:
                return found
            open_ ^= 1 << total
        return None

    def _send(self, item: int, to: int) -> None:
        source, length = self.place[item], self.lengths[item]
        self.bins[source].remove(item)
        for x in self._kinds(to):
            self._offer_total(x + length, to)
        self.bins[to].append(item)
        self.fill[source] -= length
        self.fill[to] += length
        self.place[item] = to

    def _improve(self, taker: int) -> bool:
        """One change, if there is one."""
        free = self.capacity - self.fill[taker]
        item = self._longest(0, free, taker, 0)
        if item is not None:
            self._send(item, taker)
            return True
        own = {self.lengths[i]: i for i in self.bins[taker]}
        gain, best = 0, None
        for length, mine in own.items():
            item = self._longest(length + gain, min(length + free, self.capacity), taker, length)
            if item is not None:
                gain, best = self.lengths[item] - length, (mine, (item,))
        for length, mine in own.items():
            pair = self._pair(length + gain, length + free, taker, length)
            if pair is not None:
                gain, best = sum(self.lengths[i] for i in pair) - length, (mine, pair)
        if best is None:
            return False
        mine, theirs = best
        giver = self.place[theirs[0]]
        for item in theirs:
            self._send(item, taker)
        self._send(mine, giver)
        return True

    def _pass(self, all_give: bool) -> bool:
        self._open()
        changed = False
        for taker in sorted(self.open, key=lambda b: (-self.fill[b], b)):
            while self.bins[taker] and self.fill[taker] < self.capacity and self._improve(taker):
                changed = True
            if not all_give or self.fill[taker] == self.capacity:
                self._withdraw(taker)
        return changed

    def run(self) -> list[list[int]]:
        while self._pass(False) or self._pass(True):
            pass
        return [items for items in self.bins if items]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers, no fuller than the capacity; no single change would raise the sum of squared fills."""
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def assign(kept: DataFrame, capacity: int = CAPACITY, cell_pieces: int = CELL_PIECES) -> DataFrame:
    """The rows of kept with sequence_id and offset; needs a column length, all others pass through.

    Rows are dealt out evenly, whatever their ids, to as many tasks as hold cell_pieces rows
    each; a task packs its rows. kept should be a stored table, so that its rows deal the
    same way when a lost task is repeated; a task sorts them first, so that it packs them the same
    way in whatever order they come. Pieces as long as the capacity are sequences of
    their own. Pieces of equal length are taken in the order of a hash of their row; repeated
    rows are pieces of their own.
    """
    cells = max(1, math.ceil(kept.count() / cell_pieces))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if not rows:
            return
        rows = pd.concat(rows, ignore_index=True)
        order = np.lexsort((pd.util.hash_pandas_object(rows, index=False).to_numpy(), -rows["length"].to_numpy()))
        rows = rows.iloc[order].reset_index(drop=True)
        lengths = rows["length"].astype("int64").tolist()
        sequence, offset = np.empty(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        full = [i for i, n in enumerate(lengths) if n == capacity]
        rest = [i for i, n in enumerate(lengths) if n < capacity]
        bins = [[rest[i] for i in items] for items in pack_lengths([lengths[i] for i in rest], capacity)]
        first = TaskContext.get().partitionId() << 33
        for number, items in enumerate(bins + [[i] for i in full]):
            at = 0
            for i in items:
                sequence[i], offset[i] = first + number, at
                at += lengths[i]
        yield rows.assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{n}` {t}" for n, t in [*kept.dtypes, ("sequence_id", "long"), ("offset", "long")])
    return kept.repartition(cells).mapInPandas(run, schema)


def pack(docs: DataFrame, work: Work, capacity: int = CAPACITY, end: int = END, **files) -> DataFrame:
    """Every piece with its ids and its place: doc_id, piece, start, length, ids, sequence_id, offset."""
    return assign(work.keep(pieces(docs, capacity, end, **files)), capacity)


def packed_places(docs: DataFrame, work: Work, capacity: int = CAPACITY, end: int = END, **files) -> DataFrame:
    """As ``pack``, with a checksum (ids_crc32) in place of the ids, which are not stored."""
    cut_up = pieces(docs, capacity, end, **files)
    return assign(work.keep(cut_up.withColumn("ids_crc32", F.crc32("ids")).drop("ids")), capacity)
