"""Quality rules: base rules on each text, and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, Work, fresh, hint_if_small, text_key

#: fixed values of the base rules
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: groups with fewer rows are estimated together with others of their language, or of all languages
MIN_GROUP = 200
#: share of a group's rows whose covariance determinant is made as small as possible
CORE_SHARE = 0.75
#: rows are rejected beyond the distance that this share of normal rows keeps
QUANTILE = 0.999
MAX_STEPS = 60
#: least standard deviation of each statistic, so that constant ones leave the covariance regular
FLOORS = (0.06, 0.05, 0.06, 0.12)
_WIDTH = len(FLOORS)
#: histogram of squared distances: bins per doubling, and the number of doublings each way
_PER_DOUBLING, _DOUBLINGS = 16, 40
#: the pool of all rows
ALL = "[]"
_BLANK = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def chi_square(x: float, degrees: int) -> float:
    """The share of squared distances below x, for an even number of degrees."""
    term, total = 1.0, 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(share: float, degrees: int = _WIDTH) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
    )


def _repeated(words: list[str], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words that is found twice or more."""
    windows = list(zip(*(words[k:] for k in range(size)), strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    inside = np.zeros(len(words), dtype=bool)
    starts = np.fromiter((seen[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for k in range(size):
        inside[k : k + len(windows)] |= starts
    return int(inside.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([text_counts(t.as_py()) for t in batch.column(batch.num_columns - 1)], dtype=np.int64)
        found = found.reshape(-1, len(COUNTS))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            kept + [pa.array(found[:, i]) for i in range(len(COUNTS))],
            names=batch.schema.names[:-1] + list(COUNTS),
        )


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, lang, source and the counts of each row's text."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    )
    names = ", ".join(f"{c} long" for c in COUNTS)
    return given.mapInArrow(_count, f"doc_id long, text_key long, lang string, source string, {names}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def transformed() -> list[Column]:
    """The statistics as numbers whose spread does not depend on their size: logs and root shares."""
    n = F.col("n_words").cast("double")
    share = [F.col(c) / n for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    return [
        F.log(F.col("word_chars") / n),
        F.sqrt(share[0]),
        F.sqrt(share[1]),
        F.sqrt(share[2]),
    ]


def _distance(params: str = "params") -> Column:
    """Squared Mahalanobis distance: squared length of whitener * (x - center)."""
    x = [F.col(f"x{i}") - F.col(params)[i] for i in range(_WIDTH)]
    total = None
    at = _WIDTH
    for row in range(_WIDTH):
        part = None
        for col in range(row + 1):
            term = F.col(params)[at] * x[col]
            part = term if part is None else part + term
            at += 1
        total = part * part if total is None else total + part * part
    return total


def _packed(center: np.ndarray, cov: np.ndarray) -> list[float]:
    """Center, then the lower triangle of the inverse of the covariance's Cholesky factor, then its log determinant."""
    factor = np.linalg.cholesky(cov)
    inverse = np.linalg.inv(factor)
    low = inverse[np.tril_indices(_WIDTH)]
    return [*center.tolist(), *low.tolist(), float(2 * np.log(np.diag(factor)).sum())]


def _floor(cov: np.ndarray) -> np.ndarray:
    """The covariance with each variance raised to its floor, where it is below."""
    low = np.maximum(np.diag(cov), np.square(FLOORS))
    return cov + np.diag(low - np.diag(cov))


def _spread(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean and covariance of all rows of the bins in frame."""
    n = frame["n"].sum()
    center = np.array([frame[f"s{i}"].sum() for i in range(_WIDTH)]) / n
    cov = np.empty((_WIDTH, _WIDTH))
    for i in range(_WIDTH):
        for j in range(i + 1):
            cov[i, j] = cov[j, i] = frame[f"s{i}_{j}"].sum() / n - center[i] * center[j]
    return center, cov, n


def consistency(share: float = CORE_SHARE) -> float:
    """By how much the covariance of the nearest share of normal rows is too small."""
    return share / chi_square(chi_square_quantile(share), _WIDTH + 2)


def _concentrate(frame: pd.DataFrame) -> pd.DataFrame:
    """The next estimate of a pool and start from its histogram of distances: the nearest rows' own."""
    frame = frame.sort_values("bin")
    before = frame["n"].cumsum() - frame["n"]
    core = frame[before < CORE_SHARE * frame["n"].sum()]
    center, cov, _ = _spread(core)
    return pd.DataFrame(
        {
            "pool": frame["pool"].iloc[:1].to_numpy(),
            "start": frame["start"].iloc[:1].to_numpy(),
            "params": [_packed(center, _floor(cov * consistency()))],
        }
    )


def _moments() -> list[Column]:
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(_WIDTH)]
    return [
        F.count(F.lit(1)).alias("n"),
        *sums,
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i in range(_WIDTH) for j in range(i + 1)),
    ]


class RobustOutliers:
    """Minimum-covariance-determinant estimates per pool of rows, by concentration steps over all of them.

    A pool is a language and source, or what is left of a language where those have fewer than
    MIN_GROUP rows; languages of which less is left are compared with all rows. Each step measures the distance of every row from its
    pool's estimate, sums moments per pool and bin of distance (on the map side, so that
    a pool with a third of all rows is no larger than another after it), and takes the
    moments of the nearest CORE_SHARE of the rows as the next estimate; the determinant falls
    until the estimate stands still. Two starts, one from medians and one from means of
    bounded transforms, are followed at once and the lower determinant wins. Only
    estimates, never rows, are grouped.
    """

    def __init__(self, rows: DataFrame, work: Work) -> None:
        """rows: pool and x0.. of the rows that take part; stored."""
        self.rows, self.work = rows, work

    def _starts(self) -> DataFrame:
        middle = [F.percentile_approx(f"x{i}", F.lit(0.5), F.lit(1000)).alias(f"m{i}") for i in range(_WIDTH)]
        quart = [
            F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.75)), F.lit(1000)).alias(f"q{i}")
            for i in range(_WIDTH)
        ]
        robust = hint_if_small(self.rows.groupBy("pool").agg(*middle, *quart).withColumnRenamed("pool", "of"), self.work)
        joined = self.rows.join(robust, F.col("pool") == F.col("of"))
        scale = [
            F.greatest((F.col(f"q{i}")[1] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])) for i in range(_WIDTH)
        ]
        bounded = joined.select(
            "pool", *[(F.tanh((F.col(f"x{i}") - F.col(f"m{i}")) / scale[i])).alias(f"x{i}") for i in range(_WIDTH)]
        )
        sums = bounded.groupBy("pool").agg(*_moments())
        given = sums.join(robust, F.col("pool") == F.col("of")).drop("of")

        def start(frame: pd.DataFrame) -> pd.DataFrame:
            row = frame.iloc[0]
            center = np.array([row[f"m{i}"] for i in range(_WIDTH)])
            width = np.array([max((row[f"q{i}"][1] - row[f"q{i}"][0]) / 1.349, FLOORS[i]) for i in range(_WIDTH)])
            _, cov, _ = _spread(frame)
            deviation = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            correlation = cov / np.outer(deviation, deviation)
            plain, bound = np.diag(width**2), correlation * np.outer(width, width)
            return pd.DataFrame(
                {
                    "pool": [row["pool"]] * 2,
                    "start": [0, 1],
                    "params": [_packed(center, _floor(plain)), _packed(center, _floor(bound))],
                }
            )

        return given.groupBy("pool").applyInPandas(start, "pool string, start int, params array<double>")

    def _step(self, params: DataFrame) -> DataFrame:
        near = self.rows.join(params.withColumnRenamed("pool", "of"), F.col("pool") == F.col("of"))
        doubling = F.log2(F.greatest(_distance(), F.lit(2.0**-_DOUBLINGS)))
        bin_ = F.least(F.floor((doubling + _DOUBLINGS) * _PER_DOUBLING), F.lit(2 * _DOUBLINGS * _PER_DOUBLING))
        binned = near.select("pool", "start", bin_.cast("int").alias("bin"), *(f"x{i}" for i in range(_WIDTH)))
        sums = binned.groupBy("pool", "start", "bin").agg(*_moments())
        return sums.groupBy("pool", "start").applyInPandas(_concentrate, "pool string, start int, params array<double>")

    def estimates(self) -> DataFrame:
        """pool and params, a row a pool."""
        now, last = hint_if_small(self._starts(), self.work), None
        for _ in range(MAX_STEPS):
            now = hint_if_small(self._step(now), self.work)
            # a number a pool and start, added up
            total = now.agg(F.sum(F.element_at("params", -1))).first()[0]
            if total is None or (last is not None and abs(total - last) < 1e-3):
                break
            last = total
        else:
            warnings.warn(f"estimates still moved after {MAX_STEPS} steps", stacklevel=2)
        best = F.min_by("params", F.struct(F.element_at("params", -1), "start")).alias("params")
        return hint_if_small(now.groupBy("pool").agg(best), self.work)


def judged(
    docs: DataFrame, work: Work, quantile: float = QUANTILE, min_group: int = MIN_GROUP
) -> DataFrame:
    """doc_id, text_key, lang, source, the counts, base_failed, distance and kept of each row of docs.

    Rows that fail a base rule (few words, or many repeated ones; also null and empty texts)
    are rejected and take no part in the estimates. Of the others, those are rejected whose
    squared Mahalanobis distance from their pool's estimate is above the chi-square quantile, times
    how much the pool's median distance is above that of normal rows, if it is. Null languages
    and sources are groups of their own; every row that passes the base rules is judged.
    """
    rows = work.keep(counted(docs).withColumn("base_failed", base_failed()))
    part = rows.filter(~F.col("base_failed"))
    by_source = part.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    big = F.col("n") >= min_group
    small = by_source.filter(~big).groupBy("lang").agg(F.sum("n").alias("lang_n"))
    pools = by_source.join(small.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left")
    name = (
        F.when(big, F.to_json(F.array("lang", "source")))
        .when(F.col("lang_n") >= min_group, F.to_json(F.array("lang")))
        .otherwise(F.lit(ALL))
    )
    pools = pools.select(F.col("lang").alias("l"), F.col("source").alias("s"), name.alias("pool"))
    pools = hint_if_small(pools, work)
    joined = part.join(pools, part["lang"].eqNullSafe(pools["l"]) & part["source"].eqNullSafe(pools["s"]))
    values = [x.alias(f"x{i}") for i, x in enumerate(transformed())]
    points = work.keep(joined.drop("l", "s").select("*", *values))
    given = points.select("pool", *(f"x{i}" for i in range(_WIDTH)))
    if points.filter(F.col("pool") == ALL).limit(1).count():
        given = given.filter(F.col("pool") != ALL).unionByName(given.withColumn("pool", F.lit(ALL)))
    params = RobustOutliers(given, work).estimates().withColumnRenamed("pool", "of")
    middle = given.join(params, F.col("pool") == F.col("of")).select("pool", _distance().alias("distance"))
    middle = middle.groupBy("pool").agg(F.percentile_approx("distance", F.lit(0.5), F.lit(1000)).alias("middle"))
    wider = F.greatest(F.col("middle") / chi_square_quantile(0.5), F.lit(1.0))
    limits = middle.select(F.col("pool").alias("limited"), (wider * chi_square_quantile(quantile)).alias("cutoff"))
    limits = hint_if_small(limits, work)
    measured = points.join(params, F.col("pool") == F.col("of")).join(limits, F.col("pool") == F.col("limited"))
    names = ["doc_id", "text_key", "lang", "source", *COUNTS, "base_failed"]
    passed = measured.select(*names, _distance().alias("distance"), "cutoff")
    passed = passed.withColumn("kept", F.col("distance") <= F.col("cutoff")).drop("cutoff")
    failed = rows.filter("base_failed").select(*names).withColumns(
        {"distance": F.lit(None).cast("double"), "kept": F.lit(False)}
    )
    return passed.unionByName(failed)


def drop_rejected(docs: DataFrame, work: Work, **params) -> DataFrame:
    """The rows of docs that are kept; all columns pass through.

    The rejected rows' keys may be a share of all rows, so the join is left to Spark, which
    shuffles both sides. Rows equal in id and text are judged alike.
    """
    gone = work.keep(judged(docs, work, **params).filter("NOT kept").select("doc_id", "text_key").distinct())
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, text_key())
    match = keyed["doc_id"].eqNullSafe(gone["doc_id"]) & (keyed[key] == gone["text_key"])
    return keyed.join(gone, match, "left_anti").drop(key)
