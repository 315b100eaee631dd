"""Search over two decision thresholds, one per side of a protected variable.

The overall balanced accuracy at thresholds (a, b) is a sum of a term that
depends on a only and a term that depends on b only, so the best pair is the
best a with the best b, and the most neutral pair is found by walking the two
sorted lists of group rates side by side. No pair of thresholds is enumerated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.config import (
    LABEL,
    PRIMARY_FAIRNESS_METRIC,
    PROTECTED,
    THRESHOLD_BINS,
    Protected,
)
from evenkeel.operators.fairness import privilege_flags

_EXACT = "decimal(19,0)"
_LEVEL_STEPS = 1e12


def probability_bins(probability: Column, bins: int = THRESHOLD_BINS) -> Column:
    return F.floor(probability * bins).cast("int")


def threshold_curves(
    df: DataFrame,
    protected: Protected = PROTECTED,
    label: str = LABEL,
    score: str = "score",
    bins: int = THRESHOLD_BINS,
) -> DataFrame:
    """True and false positives of each side at every threshold 0..bins.

    Rows are counted once per (flags, score, class). The curves are dense: a
    threshold nobody scored is there as well. A score below 0 or above ``bins``
    is an error; rows without score or label are not counted.
    """
    given = F.col(f"`{score}`")
    beyond = F.concat(F.lit(f"score outside 0..{bins}: "), given.cast("string"))
    bounded = (
        F.when(given.isNull(), F.lit(None).cast("int"))
        .when((given >= 0) & (given <= bins), given.cast("int"))
        .otherwise(F.raise_error(beyond).cast("int"))
    )
    counted = (
        df.select(*privilege_flags(protected), bounded.alias("th"), F.col(f"`{label}`").alias("y"))
        .where(F.col("th").isNotNull() & F.col("y").isNotNull())
        .groupBy(*protected, "th")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    )
    observed = counted.unpivot(
        ["th", "pos", "neg"], list(protected), "protected_var", "is_privileged"
    ).where(F.col("is_privileged").isNotNull())
    spark = df.sparkSession
    grid = (
        spark.range(bins + 1)
        .select(
            F.col("id").cast("int").alias("th"),
            F.lit(0).cast("long").alias("pos"),
            F.lit(0).cast("long").alias("neg"),
            F.explode(F.array(*[F.lit(v) for v in protected])).alias("protected_var"),
        )
        .withColumn("is_privileged", F.explode(F.array(F.lit(True), F.lit(False))))
    )
    side = ["protected_var", "is_privileged"]
    # At most 2 * (bins + 1) rows per protected variable from here on. One shuffle
    # by variable serves every later grouping and window.
    dense = (
        observed.unionByName(grid)
        .groupBy(*side, "th")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .repartition("protected_var")
    )
    at_or_above = W.partitionBy(*side).orderBy(F.desc("th"))
    whole = W.partitionBy(*side)
    return dense.select(
        *side,
        "th",
        F.sum("pos").over(at_or_above).alias("tp"),
        F.sum("neg").over(at_or_above).alias("fp"),
        F.sum("pos").over(whole).alias("p"),
        F.sum("neg").over(whole).alias("n"),
    )


def _level(metric: str) -> Column:
    """The group rate a fairness metric compares, in steps of 1e-12."""
    tpr = F.try_divide(F.col("tp"), F.col("p"))
    fpr = F.try_divide(F.col("fp"), F.col("n"))
    rate = {
        "equal_opportunity": tpr,
        "demographic_parity": F.try_divide(F.col("tp") + F.col("fp"), F.col("p") + F.col("n")),
        "equal_odds": (tpr + fpr) / 2,
    }[metric]
    return F.floor(rate * _LEVEL_STEPS + 0.5).cast("long")


def _scored(curves: DataFrame, metric: str) -> DataFrame:
    """Each side's share of the balanced accuracy, as an exact whole number.

    2 * P * N * balanced accuracy = (TP_a + TP_b) * N + (TN_a + TN_b) * P with P
    and N the positives and negatives of both sides together.
    """
    both = W.partitionBy("protected_var", "th")
    exact = curves.select(
        "*",
        (F.col("n") - F.col("fp")).alias("tn"),
        F.sum("p").over(both).alias("all_p"),
        F.sum("n").over(both).alias("all_n"),
        _level(metric).alias("level"),
    )
    gain = F.col("tp").cast(_EXACT) * F.col("all_n").cast(_EXACT) + F.col("tn").cast(
        _EXACT
    ) * F.col("all_p").cast(_EXACT)
    return exact.withColumn("gain", gain)


def _with_neighbors(scored: DataFrame) -> DataFrame:
    """For every rate of the privileged side the nearest rates of the other side.

    Among thresholds of one side with the same rate only the one with the
    highest gain, then the lowest threshold, can be in the answer. Walking all
    rates in order, the last one of the other side seen before and the first one
    seen after a rate are its nearest.
    """
    same_rate = W.partitionBy("protected_var", "is_privileged", "level").orderBy(
        F.desc("gain"), F.asc("th")
    )
    ranked = scored.withColumn(
        "in_play", F.col("level").isNotNull() & (F.row_number().over(same_rate) == 1)
    )
    walk = W.partitionBy("protected_var").orderBy("level", "is_privileged", "th")
    other = F.when(
        ~F.col("is_privileged") & F.col("in_play"), F.struct("level", "gain", "th", "tp", "tn")
    )
    return ranked.select(
        "*",
        F.last(other, ignorenulls=True)
        .over(walk.rowsBetween(W.unboundedPreceding, W.currentRow))
        .alias("before"),
        F.first(other, ignorenulls=True)
        .over(walk.rowsBetween(W.currentRow, W.unboundedFollowing))
        .alias("after"),
    )


def _pair(neighbor: str) -> Column:
    """A privileged row with one neighbor, ordered by how good the pair is."""
    b = F.col(neighbor)
    usable = F.col("is_privileged") & F.col("in_play") & b.isNotNull()
    return F.when(
        usable,
        F.struct(
            F.abs(F.col("level") - b["level"]).alias("gap"),
            (-(F.col("gain") + b["gain"])).alias("rank"),
            F.col("th").alias("th_1"),
            b["th"].alias("th_2"),
            (F.col("tp") + b["tp"]).alias("tp"),
            (F.col("tn") + b["tn"]).alias("tn"),
        ),
    )


def tradeoff(
    df: DataFrame,
    protected: Protected = PROTECTED,
    label: str = LABEL,
    score: str = "score",
    metric: str = PRIMARY_FAIRNESS_METRIC,
    bins: int = THRESHOLD_BINS,
) -> DataFrame:
    """Three threshold pairs per protected variable.

    * ``max_perf_point``: highest balanced accuracy,
    * ``max_perf_single_th``: the same with one threshold for both sides,
    * ``max_perf_neutral_fair``: smallest fairness gap, then highest accuracy;
      without thresholds where the gap is undefined.

    Ties go to the lowest first, then second threshold. ``thresh_1`` is the
    privileged side's.
    """
    near = _with_neighbors(_scored(threshold_curves(df, protected, label, score, bins), metric))
    at_th = W.partitionBy("protected_var", "th")
    points = near.withColumns({f"{c}_at": F.sum(c).over(at_th) for c in ("gain", "tp", "tn")})

    def best(flag: Column) -> Column:
        rank = (-F.col("gain")).alias("rank")
        return F.min(F.when(flag, F.struct(rank, "th", "tp", "tn")))

    favored = F.col("is_privileged")
    found = points.groupBy("protected_var").agg(
        best(favored).alias("a"),
        best(~favored).alias("b"),
        F.min(
            F.struct((-F.col("gain_at")).alias("rank"), "th", "tp_at", "tn_at")
        ).alias("single"),
        F.min(F.least(_pair("before"), _pair("after"))).alias("neutral"),
        F.max("all_p").alias("all_p"),
        F.max("all_n").alias("all_n"),
    )

    def row(name: str, th_1: Column, th_2: Column, tp: Column, tn: Column) -> Column:
        accuracy = (F.try_divide(tp, F.col("all_p")) + F.try_divide(tn, F.col("all_n"))) / 2
        return F.struct(
            F.lit(name).alias("metrics"),
            th_1.alias("thresh_1"),
            th_2.alias("thresh_2"),
            accuracy.alias("balanced_accuracy"),
        )

    a, b, single, neutral = (F.col(c) for c in ("a", "b", "single", "neutral"))
    rows = F.array(
        row("max_perf_point", a["th"], b["th"], a["tp"] + b["tp"], a["tn"] + b["tn"]),
        row("max_perf_single_th", single["th"], single["th"], single["tp_at"], single["tn_at"]),
        row("max_perf_neutral_fair", neutral["th_1"], neutral["th_2"], neutral["tp"], neutral["tn"]),
    )
    return found.select("protected_var", F.inline(rows))
