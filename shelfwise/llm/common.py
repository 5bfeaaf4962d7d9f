"""What the operators share: words, row keys, tables kept in the shared folder, checked broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.sizes import shared_folder

#: a word: anything between the six ASCII white-space characters
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
#: sides of a join with at most this many rows and bytes may be broadcast
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 8 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on a uint64 array."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """Remembers a pure function of a string, up to a number of entries."""

    def __init__(self, fn: Callable, limit: int = 500_000) -> None:
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    The archive lies on the driver, from where Spark itself hands it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(package):  # imported from such an archive
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "shelfwise.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)


class Work:
    """Tables of one job, kept as Parquet in the folder that all executors share.

    They cut lineage and outlive lost executors. Those that the result does not
    read are dropped with ``drop``; the rest stay until the folder is cleaned.
    """

    def __init__(self, spark: SparkSession) -> None:
        ship(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self._paths)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = path
        kept._kept_path = path
        return kept

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            if df is not None and hasattr(df, "_kept_path"):
                remove(self.spark, df._kept_path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the queries begin with it, so the workers have the package by then."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(text: str = "text") -> Column:
    """With the id, tells rows apart: rows equal in both are one document."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _bytes(name: str, kind: str) -> Column:
    """About the bytes of a value; nested ones by their JSON form, which is no shorter."""
    if kind in ("string", "binary"):
        size = F.octet_length(name)
    elif kind.startswith(("array", "struct", "map")):
        size = F.octet_length(F.to_json(F.struct(F.col(name))))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0))


def hint_if_small(df: DataFrame, work: Work) -> DataFrame:
    """Keep df and hint its broadcast if its counted rows and bytes are within the bounds.

    Beyond them the join is left to Spark, which shuffles and splits skewed keys.
    """
    kept = work.keep(df)
    width = reduce(lambda a, b: a + b, [_bytes(c, kind) for c, kind in kept.dtypes])
    rows, width = kept.agg(F.count(F.lit(1)), F.sum(width)).first()
    small = rows <= BROADCAST_ROWS and (width or 0) <= BROADCAST_BYTES
    return F.broadcast(kept) if small else kept


def same(left: Iterable[str], right: Iterable[str], a: DataFrame, b: DataFrame) -> Column:
    """Equality of columns that takes nulls as equal."""
    pairs = [a[x].eqNullSafe(b[y]) for x, y in zip(left, right, strict=True)]
    return reduce(lambda p, q: p & q, pairs)


def chunks(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about limit characters together, one row at least."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def binaries(matrix: np.ndarray) -> pa.Array:
    """A uint8 matrix as one binary value per row."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    data = np.ascontiguousarray(matrix)
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets.buffers()[1], pa.py_buffer(data)])


def by_value(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Groups of rows of a stream that is sorted by a column without nulls."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy(zero_copy_only=False)
        if not len(values):
            continue
        ends = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        if held and held[0].column(column)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for end in ends:
            if start and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield pa.Table.from_batches(held)
