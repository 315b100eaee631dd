"""Performance of a classifier and bootstrap intervals for all measures."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import FAIRNESS_METRICS, PROTECTED, Protected
from evenkeel.operators import fairness as fair

PERFORMANCE_METRICS = (
    "accuracy", "balanced_accuracy", "precision", "recall", "f1", "selection_rate",
)
REPLICATES = 200
_ATTEMPTS = 300
_HALF_LOG_TWO_PI = math.log(2 * math.pi) / 2
# What Stirling's formula for log k! lacks, for k from 1; from 16 on a short series gives it.
_STIRLING = [
    math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - _HALF_LOG_TWO_PI for k in range(1, 16)
]


def balanced_accuracy() -> Column:
    return (fair.true_positive_rate() + fair.true_negative_rate()) / 2


def performance_columns() -> list[Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return [
        F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        balanced_accuracy().alias("balanced_accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        fair.selection_rate().alias("selection_rate"),
    ]


def performance(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group and metric, from confusion cells."""
    wide = fair.overall(counted, by).select(*by, *performance_columns())
    return wide.unpivot(list(by), list(PERFORMANCE_METRICS), "metric", "value")


def mean_accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    same = (F.col(f"`{label}`") == F.col(f"`{prediction}`")).cast("double")
    return df.agg(F.avg(same).alias("accuracy"))


def _uniform(digits: Column, first: int, length: int) -> Column:
    """A number in (0, 1) from ``length`` hexadecimal digits."""
    number = F.conv(F.substring(digits, first, length), 16, 10).cast("double")
    return (number + 0.5) / float(16**length)


def _log_mass(k: Column, rate: Column) -> Column:
    """Logarithm of the Poisson probability of ``k``, in terms that do not cancel."""
    x = (k - rate) / rate
    deviance = rate * ((1 + x) * F.log1p(x) - x)
    square = 1 / (k * k)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - square / 1680) * square) * square) / k
    table = F.array(*[F.lit(v) for v in _STIRLING])
    lacking = F.when(k <= len(_STIRLING), F.get(table, k.cast("int") - 1)).otherwise(series)
    return F.when(k == 0, -rate).otherwise(-lacking - deviance - _HALF_LOG_TWO_PI - F.ln(k) / 2)


def poisson_draw(mean: Column, *parts: Column) -> Column:
    """A Poisson variate with the given mean, a function of ``parts``.

    Rejection from a flat top with exponential tails, which covers every discrete
    log-concave distribution (Devroye 1987). It is exact at every mean, and an
    attempt succeeds with a chance of 1/5 or more whatever the mean. Attempts are
    a stream of hashes; one that were to end unused, which has a chance below
    1e-28, is an error rather than a wrong number.
    """
    rate = mean.cast("double")
    mode = F.floor(rate).cast("double")
    start = F.struct(
        rate.alias("rate"),
        mode.alias("mode"),
        _log_mass(mode, rate).alias("top"),
        F.lit(None).cast("double").alias("drawn"),
    )

    def attempt(state: Column, k: Column) -> Column:
        peak = F.exp(state["top"])
        width = 1 + peak / 2
        digits = F.md5(F.concat_ws("|", *parts, k.cast("string")))
        inside, along = _uniform(digits, 1, 8), _uniform(digits, 9, 12)
        far = F.when(inside <= width / (1 + width), along * width).otherwise(width - F.ln(along)) / peak
        side = F.when(F.substring(digits, 32, 1) < "8", 1).otherwise(-1)
        offer = F.struct(
            (state["mode"] + side * F.floor(far + 0.5)).alias("value"),
            (_uniform(digits, 21, 11) * F.least(F.lit(1.0), F.exp(width - peak * far))).alias("level"),
        )

        def judged(offer: Column) -> Column:
            share = F.exp(_log_mass(offer["value"], state["rate"]) - state["top"])
            # The first test guards the second: no mass below zero.
            return F.when(offer["value"] >= 0, F.when(offer["level"] <= share, offer["value"]))

        drawn = F.get(F.transform(F.array(offer), judged), F.lit(0))
        tried = F.struct(*[state[c].alias(c) for c in ("rate", "mode", "top")], drawn.alias("drawn"))
        return F.when(state["drawn"].isNotNull(), state).otherwise(tried)

    drawn = F.aggregate(
        F.sequence(F.lit(1), F.lit(_ATTEMPTS)), start, attempt, lambda s: s["drawn"].cast("long")
    )
    unused = F.raise_error(F.lit("a Poisson draw found no value")).cast("long")
    return F.when(rate == 0, F.lit(0).cast("long")).when(rate > 0, F.coalesce(drawn, unused))


def resample(
    counted: DataFrame,
    protected: Protected = PROTECTED,
    replicates: int = REPLICATES,
    seed: int = 0,
) -> DataFrame:
    """Bootstrap replicates of confusion cells.

    Giving each row a Poisson(1) weight and summing the weights of a cell is the
    same as drawing Poisson(n) once for a cell of n rows. So the replicates are
    drawn per cell: the work grows with cells times replicates, not with rows.
    """
    keys = [*protected, "actual", "predicted"]
    # A null flag (missing protected value) is spelled out, so that it cannot
    # share the draw of another cell.
    named = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys]
    replicate = F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")
    drawn = counted.select(replicate, *keys, "n")
    draw = poisson_draw(
        F.col("n"), F.lit(str(seed)), F.col("replicate").cast("string"), *named
    )
    return drawn.withColumn("n", draw)


def _interval(df: DataFrame, by: Sequence[str], level: float) -> DataFrame:
    tail = (1 - level) / 2
    # One value per replicate and group: the exact percentile is bounded.
    return df.groupBy(*by).agg(
        F.percentile("value", F.lit(tail)).alias("ci_low"),
        F.percentile("value", F.lit(1 - tail)).alias("ci_high"),
    )


def performance_intervals(
    counted: DataFrame,
    protected: Protected = PROTECTED,
    replicates: int = REPLICATES,
    level: float = 0.95,
    seed: int = 0,
) -> DataFrame:
    """Performance metrics with bootstrap intervals."""
    drawn = performance(resample(counted, protected, replicates, seed), ["replicate"])
    return performance(counted).join(_interval(drawn, ["metric"], level), "metric", "left")


def fairness_intervals(
    counted: DataFrame,
    protected: Protected = PROTECTED,
    replicates: int = REPLICATES,
    level: float = 0.95,
    seed: int = 0,
) -> DataFrame:
    """Fairness gaps with bootstrap intervals."""
    names = list(FAIRNESS_METRICS)
    point = fair.fairness_metrics(fair.by_group(counted, protected)).unpivot(
        ["protected_var"], names, "metric", "value"
    )
    draws = fair.by_group(
        resample(counted, protected, replicates, seed), protected, ["replicate"]
    )
    drawn = fair.fairness_metrics(draws, ["replicate"]).unpivot(
        ["replicate", "protected_var"], names, "metric", "value"
    )
    keys = ["protected_var", "metric"]
    return point.join(_interval(drawn, keys, level), keys, "left")


def performance_table(intervals: DataFrame, run_id: str) -> DataFrame:
    """The metric table of a run: a 'value' and an 'interval' row per metric."""
    rows = F.inline(
        F.array(
            F.struct(
                F.lit("value").alias("kind"),
                F.col("value"),
                F.lit(None).cast("double").alias("ci_low"),
                F.lit(None).cast("double").alias("ci_high"),
            ),
            F.struct(
                F.lit("interval").alias("kind"),
                F.lit(None).cast("double").alias("value"),
                F.col("ci_low"),
                F.col("ci_high"),
            ),
        )
    )
    return intervals.select(F.lit(run_id).alias("run_id"), "metric", rows)


def values_only(table: DataFrame) -> DataFrame:
    """Drop the interval rows of a metric table."""
    return table.where(F.col("kind") == "value").select("run_id", "metric", "value")
