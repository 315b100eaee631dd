"""Confusion counts by protected group and the fairness measures built on them.

A gap is always privileged minus unprivileged. A rate whose group has no case
to divide by is null, and so is every gap that needs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import (
    FAIR_THRESHOLD,
    FAIRNESS_METRICS,
    LABEL,
    PARITY_GATE,
    PREDICTION,
    PRIMARY_FAIRNESS_METRIC,
    PROTECTED,
    Protected,
)


def privilege_flags(protected: Protected) -> list[Column]:
    return [F.col(f"`{var}`").isin(*values).alias(var) for var, values in protected.items()]


def cells(
    df: DataFrame,
    protected: Protected = PROTECTED,
    label: str = LABEL,
    prediction: str = PREDICTION,
    favorable: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """Row counts per combination of privilege flags, actual and predicted class.

    This is the only step that touches the rows. With p protected variables it
    leaves at most 4 * 3^p rows per ``by`` group after the map-side half of the
    aggregation; everything else works on those.
    """
    actual = (F.col(f"`{label}`") == favorable).alias("actual")
    predicted = (F.col(f"`{prediction}`") == favorable).alias("predicted")
    return (
        df.select(*by, *privilege_flags(protected), actual, predicted)
        .where(F.col("actual").isNotNull() & F.col("predicted").isNotNull())
        .groupBy(*by, *protected, "actual", "predicted")
        .agg(F.count("*").alias("n"))
    )


def _confusion() -> list[Column]:
    actual, predicted, n = F.col("actual"), F.col("predicted"), F.col("n")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).alias(name)

    return [
        total(actual & predicted, "tp"),
        total(~actual & predicted, "fp"),
        total(~actual & ~predicted, "tn"),
        total(actual & ~predicted, "fn"),
    ]


def by_group(
    counted: DataFrame, protected: Protected = PROTECTED, by: Sequence[str] = ()
) -> DataFrame:
    """Cells regrouped to one row per protected variable and privilege flag."""
    long = counted.unpivot(
        [*by, "actual", "predicted", "n"], list(protected), "protected_var", "is_privileged"
    ).where(F.col("is_privileged").isNotNull())
    return long.groupBy(*by, "protected_var", "is_privileged").agg(*_confusion())


def confusion_by_group(
    df: DataFrame,
    protected: Protected = PROTECTED,
    label: str = LABEL,
    prediction: str = PREDICTION,
    favorable: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    return by_group(cells(df, protected, label, prediction, favorable, by), protected, by)


def overall(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counted.groupBy(*by).agg(*_confusion())


def true_positive_rate() -> Column:
    return F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))


def false_positive_rate() -> Column:
    return F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))


def true_negative_rate() -> Column:
    return F.try_divide(F.col("tn"), F.col("fp") + F.col("tn"))


def selection_rate() -> Column:
    return F.try_divide(
        F.col("tp") + F.col("fp"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    )


def fairness_metrics(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per protected variable with its three gaps."""
    rates = groups.select(
        *by,
        "protected_var",
        "is_privileged",
        selection_rate().alias("selection"),
        true_positive_rate().alias("tpr"),
        false_positive_rate().alias("fpr"),
    )
    favored = F.col("is_privileged")

    def side(rate: str, flag: Column, name: str) -> Column:
        return F.max(F.when(flag, F.col(rate))).alias(name)

    wide = rates.groupBy(*by, "protected_var").agg(
        *[side(r, favored, f"{r}_p") for r in ("selection", "tpr", "fpr")],
        *[side(r, ~favored, f"{r}_u") for r in ("selection", "tpr", "fpr")],
    )
    tpr_gap = F.col("tpr_p") - F.col("tpr_u")
    fpr_gap = F.col("fpr_p") - F.col("fpr_u")
    return wide.select(
        *by,
        "protected_var",
        (F.col("selection_p") - F.col("selection_u")).alias("demographic_parity"),
        tpr_gap.alias("equal_opportunity"),
        ((tpr_gap + fpr_gap) / 2).alias("equal_odds"),
    )


def fairness_long(
    metrics: DataFrame, names: Sequence[str] = FAIRNESS_METRICS, run: str = "model_run_id"
) -> DataFrame:
    """Long form, one row per run, protected variable and metric."""
    return metrics.unpivot([run, "protected_var"], list(names), "metric", "parity").select(
        run, "protected_var", "metric", "parity"
    )


def pair_metrics(df: DataFrame, names: str, values: str, keep: Sequence[str] = ()) -> DataFrame:
    """Two parallel arrays as (metric, parity) rows, paired by position."""
    zipped = F.arrays_zip(F.col(names).alias("metric"), F.col(values).alias("parity"))
    return df.select(*keep, F.inline(zipped).alias("metric", "parity"))


def parity_gate(
    fairness: DataFrame,
    mode: str = "any_signed",
    limit: float = PARITY_GATE,
    run: str = "model_run_id",
) -> DataFrame:
    """1 where a run passes for a protected variable, else 0.

    ``any_signed`` passes if any signed gap is at most ``limit``; ``all_abs``
    passes only if every absolute gap is. An undefined gap never helps to pass,
    and ``n_undefined`` shows it.
    """
    parity = F.col("parity")
    if mode == "any_signed":
        passed = F.coalesce(F.bool_or(parity <= limit), F.lit(False))
    elif mode == "all_abs":
        passed = F.bool_and(F.coalesce(F.abs(parity) <= limit, F.lit(False)))
    else:
        raise ValueError("mode must be 'any_signed' or 'all_abs'")
    return fairness.groupBy(run, "protected_var").agg(
        F.when(passed, 1).otherwise(0).alias("parity_check"),
        F.count("*").alias("n_metrics"),
        F.count_if(parity.isNull()).alias("n_undefined"),
    )


def fair_conclusion(
    fairness: DataFrame,
    metric: str = PRIMARY_FAIRNESS_METRIC,
    threshold: float = FAIR_THRESHOLD,
    run: str = "model_run_id",
) -> DataFrame:
    """'fair' where the primary gap is within the threshold, 'undefined' without one, else 'unfair'."""
    value = F.col("parity")
    return fairness.where(F.col("metric") == metric).select(
        run,
        "protected_var",
        "metric",
        value.alias("value"),
        F.lit(threshold).alias("threshold"),
        F.when(value.isNull(), "undefined")
        .when(F.abs(value) <= threshold, "fair")
        .otherwise("unfair")
        .alias("conclusion"),
    )


def of_run(df: DataFrame, run_id: str, run: str = "model_run_id") -> DataFrame:
    return df.where(F.col(run) == run_id)
