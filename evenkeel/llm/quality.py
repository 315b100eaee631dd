"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a few transformed statistics. Per class, mean and covariance come
from sums over all labelled rows; the covariance is shrunk towards the pooled one
and that towards its diagonal. A score is the difference of the two Mahalanobis log
densities, with Cholesky factors computed once, mapped to a probability by a
logistic curve that is fitted on the labelled rows' differences.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.calibration import logistic
from evenkeel.llm.scratch import save
from evenkeel.llm.text import batched, rows

STATISTICS = (
    "log_bytes",
    "word_bytes",
    "word_spread",
    "upper_share",
    "symbol_share",
    "digit_share",
    "distinct_share",
    "repeat_share",
    "top_share",
    "line_repeat_share",
    "odd_word_share",
    "shout_share",
    "short_lines",
    "inflation",
)
_ODD = re.compile(rb"[^A-Za-z\x80-\xff'.,;:!?-]|[!?.,;:]{2}")
_LONGEST_UNIT = 1 << 20


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a text; those of an empty one are all finite."""
    text = text or b""
    words = text.split()
    size, count = len(text), len(words)
    if not count:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=count)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digit = counts[65:91].sum(), counts[48:58].sum()
    lower = counts[97:123].sum() + counts[128:].sum()
    letters = upper + lower
    blank = counts[32] + counts[9:14].sum()
    symbol = size - letters - digit - blank
    seen = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    packed = zlib.compressobj(1)
    inflated = sum(
        len(packed.compress(text[i : i + _LONGEST_UNIT])) for i in range(0, size, _LONGEST_UNIT)
    ) + len(packed.flush())

    def share(part: float, of: float) -> float:
        # Spreads out what lies near none and all.
        p = (part + 0.5) / (of + 1.0)
        return math.log(p / (1.0 - p + 1e-9))

    return [
        math.log1p(size),
        math.log(lengths.mean()),
        math.log1p(lengths.std()),
        share(upper, letters),
        share(symbol, size),
        share(digit, size),
        math.log(len(seen)) / math.log(count + 1) if count > 1 else 1.0,
        share(sum(map(bytes.__eq__, words, words[1:])), count),
        share(seen.most_common(1)[0][1], count),
        share(len(lines) - len(set(lines)), len(lines)),
        share(sum(1 for w in words if _ODD.search(w)), count),
        share(sum(map(bytes.isupper, words)), count),
        math.log1p(count / len(lines)),
        math.log((inflated + 20.0) / (size + 20.0)),
    ]


@dataclass(frozen=True)
class Discriminant:
    """What a fit leaves: per class a mean, an inverse Cholesky factor and a constant."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    constants: tuple[float, float]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0, a value per row."""
        if self.means is None:
            return np.zeros(len(x))
        found = [
            c - 0.5 * np.square((x - m) @ f.T).sum(axis=1)
            for m, f, c in zip(self.means, self.factors, self.constants)
        ]
        return found[1] - found[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * self.difference(x) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


@dataclass(frozen=True)
class Shrinkage:
    """``pooled``: share of the pooled covariance in a class's; ``diagonal``: share of
    its diagonal in the pooled one; ``floor``: least variance, as a share of the pooled."""

    pooled: float = 0.2
    diagonal: float = 0.1
    floor: float = 1e-3


def fitted(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: Shrinkage) -> Discriminant:
    """The discriminant from counts, sums and sums of products per class, not yet calibrated."""
    if any(k not in moments or moments[k][0] < 2 for k in (0, 1)):
        n = [moments[k][0] if k in moments else 0.0 for k in (0, 1)]
        return Discriminant(None, None, (0.0, 0.0), 1.0, math.log((n[1] + 1.0) / (n[0] + 1.0)))
    means, scatters = [], []
    for k in (0, 1):
        n, total, products = moments[k]
        mean = total / n
        means.append(mean)
        scatters.append(products - n * np.outer(mean, mean))
    n = [moments[k][0] for k in (0, 1)]
    pooled = (scatters[0] + scatters[1]) / (n[0] + n[1])
    spread = np.diag(np.maximum(np.diag(pooled), 1e-9))
    pooled = (1 - shrinkage.diagonal) * pooled + shrinkage.diagonal * spread
    factors, constants = [], []
    for k in (0, 1):
        own = (1 - shrinkage.pooled) * scatters[k] / n[k] + shrinkage.pooled * pooled
        lower = np.linalg.cholesky(own + shrinkage.floor * spread)
        factors.append(np.linalg.inv(lower))
        constants.append(-float(np.log(np.diag(lower)).sum()) + math.log(n[k]))
    return Discriminant(tuple(means), tuple(factors), tuple(constants), 1.0, 0.0)


def calibrated(model: Discriminant, bins: list[tuple[float, int, float]]) -> Discriminant:
    """The model with the logistic curve of ``(difference, label, weight)``."""
    if model.means is None or not bins:
        return model
    slope, offset = logistic(bins)
    return Discriminant(model.means, model.factors, model.constants, slope, offset)


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


_ROW = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return batched(((doc_id, statistics(text)) for doc_id, text in rows(batches)), _ROW)


def _scored(model: Discriminant, method: str) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                values = getattr(model, method)(x.reshape(batch.num_rows, -1))
                columns = [*(batch.column(i) for i in range(1, batch.num_columns)), pa.array(values)]
                names = [*batch.schema.names[1:], "value"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return found


def fit(measured: DataFrame, labels: DataFrame, shrinkage: Shrinkage = Shrinkage()) -> Discriminant:
    """Learn from all rows of ``labels(doc_id, quality)`` that are not held out.

    Only sums of a fixed size come to the driver. A label other than 0 and 1 is
    ignored; repeated labels count each time.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .join(measured, "doc_id")
        .select("x", "quality")
    )
    known = save(known, "known")
    size = len(STATISTICS)
    at = [F.col("x")[i] for i in range(size)]
    sums = [F.sum(v) for v in at]
    products = [F.sum(at[i] * at[j]) for i in range(size) for j in range(i, size)]
    moments = {}
    for label, n, *values in known.groupBy("quality").agg(F.count(F.lit(1)), *sums, *products).collect():
        square = np.zeros((size, size))
        square[np.triu_indices(size)] = values[size:]
        square = square + np.triu(square, 1).T
        moments[label] = (float(n), np.array(values[:size]), square)
    model = fitted(moments, shrinkage)
    bins = (
        known.mapInArrow(_scored(model, "difference"), "quality int, value double")
        .groupBy(F.round(F.least(F.greatest("value", F.lit(-60.0)), F.lit(60.0)) * 4).alias("bin"), "quality")
        .count()
        .collect()
    )
    return calibrated(model, [(b / 4, label, n) for b, label, n in bins])


def quality_scores(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, a row for each row of ``docs``.

    ``score`` is the probability of label 1, ``predicted`` 1 from ``least`` on. A
    null or blank text has statistics of its own and is scored like others.
    Without labels of both classes the score is their share, 0.5 without any.
    docs: ``doc_id, text``; labels: ``doc_id, quality``; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    measured = save(texts.mapInArrow(_measured, "doc_id long, x array<double>"), "measured")
    model = fit(measured, labels)
    return (
        measured.select("x", "doc_id")
        .mapInArrow(_scored(model, "score"), "doc_id long, value double")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            F.col("value").alias("score"),
            (F.col("value") >= least).cast("int").alias("predicted"),
        )
    )
