"""A fitted model as a table: scored by one projection, checked by one aggregation.

A scorecard has a row per feature with its mean, scale and weight, and one for the
intercept. It is stored next to other versions, read without the library that fitted
it, and written out as a native expression, so scoring stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel import schemas
from evenkeel.config import LABEL, LOGISTIC_C, PREDICTION, FeatureLookup
from evenkeel.operators.features import look_up
from evenkeel.operators.model import feature_names, regularization
from evenkeel.sources import tables

INTERCEPT = "(intercept)"
# A scorecard becomes one expression; a longer one is not a table of features.
MAX_FEATURES = 5000


@dataclass(frozen=True)
class Entry:
    """A feature's place in the linear predictor; a scale of 0 leaves the feature out."""

    feature: str
    mean: float
    scale: float
    weight: float


@dataclass(frozen=True)
class Scorecard:
    intercept: float
    entries: tuple[Entry, ...]

    @property
    def features(self) -> list[str]:
        return [e.feature for e in self.entries]


def from_pipeline(fitted: PipelineModel) -> Scorecard:
    """The scorecard of a pipeline that ``model.train`` fitted."""
    scaler, regression = fitted.stages[1], fitted.stages[2]
    columns = zip(
        feature_names(fitted), scaler.mean.toArray(), scaler.std.toArray(), regression.coefficients.toArray()
    )
    return Scorecard(
        float(regression.intercept), tuple(Entry(f, float(m), float(s), float(w)) for f, m, s, w in columns)
    )


def _number(feature: str) -> Column:
    """Missing values count as 0, in training and in scoring."""
    return F.coalesce(F.col(f"`{feature}`").cast("double"), F.lit(0.0))


def declared(df: DataFrame, weights: Mapping[str, float], intercept: float) -> Scorecard:
    """A scorecard of given weights over columns scaled by their mean and deviation in ``df``."""
    row = df.agg(
        *[f(_number(c)).alias(f"{name}_{i}") for i, c in enumerate(weights) for name, f in
          (("mean", F.avg), ("scale", F.stddev_samp))]
    ).first()
    entries = [
        Entry(c, row[f"mean_{i}"] or 0.0, row[f"scale_{i}"] or 0.0, float(w))
        for i, (c, w) in enumerate(weights.items())
    ]
    return Scorecard(intercept, tuple(entries))


def as_table(spark: SparkSession, card: Scorecard, model_name: str, version: int) -> DataFrame:
    """One row per feature and one for the intercept, at position 0."""
    rows = [(model_name, version, 0, INTERCEPT, None, None, card.intercept)]
    rows += [(model_name, version, i, e.feature, e.mean, e.scale, e.weight) for i, e in enumerate(card.entries, 1)]
    return spark.createDataFrame(rows, schemas.SCORECARD)


def save(spark: SparkSession, card: Scorecard, path: str, model_name: str, version: int) -> None:
    """Store a version next to the others; storing it again replaces it."""
    tables.replace_partitions(as_table(spark, card, model_name, version), path, ["model_name", "version"])


def from_rows(table: DataFrame) -> Scorecard:
    """The scorecard in a table of one model version; as many rows as features reach the driver."""
    rows = table.orderBy("position").limit(MAX_FEATURES + 2).collect()
    if len(rows) > MAX_FEATURES + 1:
        raise ValueError(f"a scorecard has at most {MAX_FEATURES} features")
    if not rows or [r.position for r in rows] != list(range(len(rows))) or rows[0].feature != INTERCEPT:
        raise ValueError("this is not one whole scorecard")
    return Scorecard(rows[0].weight, tuple(Entry(r.feature, r.mean, r.scale, r.weight) for r in rows[1:]))


def load(spark: SparkSession, path: str, model_name: str, version: int) -> Scorecard:
    stored = tables.read(spark, path)
    return from_rows(stored.where((F.col("model_name") == model_name) & (F.col("version") == version)))


def _standardized(entry: Entry) -> Column:
    return (_number(entry.feature) - F.lit(entry.mean)) * F.lit(1.0 / entry.scale if entry.scale else 0.0)


def margin(card: Scorecard) -> Column:
    """The linear predictor: positive for class 1."""
    total = F.lit(card.intercept)
    for entry in card.entries:
        if entry.scale and entry.weight:
            total = total + F.lit(entry.weight) * _standardized(entry)
    return total


def _chance(at: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-at))


def score(df: DataFrame, card: Scorecard) -> DataFrame:
    """Adds ``prediction``, ``probability`` of class 1 and ``confidence``.

    A projection without joins or models to ship; all other columns pass through.
    """
    scored = df.withColumn("probability", _chance(margin(card)))
    likely = F.when(F.col("probability") > 0.5, 1).otherwise(0)
    sure = F.greatest(F.col("probability"), 1.0 - F.col("probability"))
    return scored.withColumns({PREDICTION: likely, "confidence": sure})


def certificate(df: DataFrame, card: Scorecard, label: str = LABEL, c: float = LOGISTIC_C) -> DataFrame:
    """``(feature, position, n_rows, mean, scale, weight, gradient, start_gradient, objective)``.

    The gradient of the penalized mean loss at the scorecard's weights, in one
    aggregation over the rows it was fitted on; ``start_gradient`` is the gradient with
    all weights 0 and the intercept at the base rate. The problem is strictly convex:
    weights are the optimum just where the gradient vanishes. Rows without label weigh
    nothing, as in the fit.
    """
    y = F.col(f"`{label}`").cast("double")
    rows = df.where(y.isNotNull()).select(
        y.alias("_y"), margin(card).alias("_margin"), *[_standardized(e).alias(f"_z{i}") for i, e in enumerate(card.entries)]
    )
    error = _chance(F.col("_margin")) - F.col("_y")
    at = F.col("_margin")
    loss = F.greatest(at, F.lit(0.0)) + F.log1p(F.exp(-F.abs(at))) - F.col("_y") * at
    count = len(card.entries)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_y").alias("base"),
        F.avg(loss).alias("loss"),
        F.avg(error).alias("g"),
        *[F.avg(error * F.col(f"_z{i}")).alias(f"g{i}") for i in range(count)],
        *[F.avg(F.col("_y") * F.col(f"_z{i}")).alias(f"s{i}") for i in range(count)],
        *[F.avg(f"_z{i}").alias(f"m{i}") for i in range(count)],
    )
    found = sums.first()
    if not found.n:
        raise ValueError("no labelled rows to check a fit on")
    strength = regularization(found.n, c)
    objective = found.loss + strength / 2 * sum(e.weight**2 for e in card.entries)
    lines = [(INTERCEPT, 0, found.n, None, None, card.intercept, found.g, 0.0, objective)]
    for i, e in enumerate(card.entries):
        gradient = found[f"g{i}"] + strength * e.weight
        start = found.base * found[f"m{i}"] - found[f"s{i}"]
        lines.append((e.feature, i + 1, found.n, e.mean, e.scale, e.weight, gradient, start, objective))
    return df.sparkSession.createDataFrame(lines, schemas.CERTIFICATE)


def is_optimal(checked: DataFrame, share: float = 1e-3) -> Column:
    """Whether a row's gradient is below ``share`` of the largest one at the start."""
    start = checked.agg(F.max(F.abs("start_gradient"))).first()[0]
    return F.abs("gradient") <= share * start


def looked_up(df: DataFrame, card: Scorecard, lookups: Sequence[FeatureLookup]) -> DataFrame:
    """``df`` with the scorecard's features that it lacks, from feature tables."""
    wanted = [x for x in lookups if not set(x.feature_names) <= set(df.columns)]
    joined = look_up(df, wanted)
    if lacking := [f for f in card.features if f not in joined.columns]:
        raise ValueError(f"features neither in the rows nor in the lookups: {lacking}")
    return joined
