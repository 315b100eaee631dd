import itertools
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel.operators import fairness as fair
from evenkeel.operators import performance as perf
from evenkeel.operators import tradeoff as trade

SCHEMA = "SEX int, MARRIAGE int, default int, prediction int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def gaps(df, protected=None, **kw):
    protected = protected or {"SEX": (1,)}
    groups = fair.confusion_by_group(df, protected, **kw)
    return {r["protected_var"]: r for r in fair.fairness_metrics(groups).collect()}


def test_gaps_by_hand(spark):
    # men: tp 2 fn 2 fp 1 tn 3; women: tp 3 fn 1 fp 2 tn 2
    men = [(1, 1, 1, 1)] * 2 + [(1, 1, 1, 0)] * 2 + [(1, 1, 0, 1)] + [(1, 1, 0, 0)] * 3
    women = [(2, 1, 1, 1)] * 3 + [(2, 1, 1, 0)] + [(2, 1, 0, 1)] * 2 + [(2, 1, 0, 0)] * 2
    got = gaps(frame(spark, men + women))["SEX"]
    assert got["demographic_parity"] == pytest.approx(3 / 8 - 5 / 8)
    assert got["equal_opportunity"] == pytest.approx(0.5 - 0.75)
    assert got["equal_odds"] == pytest.approx(((0.5 - 0.75) + (0.25 - 0.5)) / 2)
    swapped = gaps(frame(spark, men + women), {"SEX": (2,)})["SEX"]
    for metric in ("demographic_parity", "equal_opportunity", "equal_odds"):
        assert swapped[metric] == pytest.approx(-got[metric])


def test_undefined_rates_do_not_pass(spark):
    """Women without positives: no rate, no gap, no pass by absence."""
    df = frame(spark, [(1, 1, 1, 1), (1, 1, 0, 0), (2, 1, 0, 1), (2, 1, 0, 0)])
    got = gaps(df)["SEX"]
    assert got["equal_opportunity"] is None and got["equal_odds"] is None
    long = spark.createDataFrame(
        [("r", "SEX", "demographic_parity", 0.5), ("r", "SEX", "equal_opportunity", None)],
        "model_run_id string, protected_var string, metric string, parity double",
    )
    for mode in ("any_signed", "all_abs"):
        assert rows(fair.parity_gate(long, mode)) == [("r", "SEX", 0, 2, 1)]
    assert fair.fair_conclusion(long).first()["conclusion"] == "undefined"


def test_missing_values_belong_to_no_group(spark):
    df = frame(spark, [(None, 1, 1, 1), (1, 1, 1, 1), (1, 1, None, 1), (2, 1, 1, None)])
    got = rows(fair.confusion_by_group(df, {"SEX": (1,)}))
    assert got == [("SEX", True, 1, 0, 0, 0)]


def test_gate_modes(spark):
    def gate(mode, *parities):
        data = [("r", "SEX", str(i), p) for i, p in enumerate(parities)]
        long = spark.createDataFrame(data, "model_run_id string, protected_var string, metric string, parity double")
        return fair.parity_gate(long, mode).first()["parity_check"]

    assert gate("any_signed", 0.2, 0.05, 0.3) == 1
    assert gate("any_signed", 0.2, 0.11, 0.3) == 0
    assert gate("any_signed", -0.9, 0.5, 0.5) == 1
    assert gate("all_abs", -0.9, 0.05, 0.05) == 0
    assert gate("all_abs", -0.1, 0.1, 0.0) == 1
    with pytest.raises(ValueError):
        gate("none", 0.1)


def test_pairing_by_position(spark):
    df = spark.createDataFrame([("p", ["a", "b"], [1.0, None])], "k string, n array<string>, v array<double>")
    assert rows(fair.pair_metrics(df, "n", "v", ["k"])) == [("p", "a", 1.0), ("p", "b", None)]


def test_performance_against_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(5)
    df = frame(spark, [(1, 1, rng.randint(0, 1), rng.randint(0, 1)) for _ in range(300)])
    got = {r["metric"]: r["value"] for r in perf.performance(fair.cells(df)).collect()}
    as_double = df.select(F.col("default").cast("double").alias("label"), F.col("prediction").cast("double"))

    def ml(metric, **kw):
        return MulticlassClassificationEvaluator(metricName=metric, **kw).evaluate(as_double)

    assert got["accuracy"] == pytest.approx(ml("accuracy"))
    assert got["precision"] == pytest.approx(ml("precisionByLabel", metricLabel=1.0))
    assert got["recall"] == pytest.approx(ml("recallByLabel", metricLabel=1.0))
    assert got["f1"] == pytest.approx(ml("fMeasureByLabel", metricLabel=1.0))
    balanced = (ml("recallByLabel", metricLabel=1.0) + ml("recallByLabel", metricLabel=0.0)) / 2
    assert got["balanced_accuracy"] == pytest.approx(balanced)


def draws(spark, mean, n):
    return spark.range(n, numPartitions=4).select(
        perf.poisson_draw(F.lit(mean), F.lit("s"), F.col("id").cast("string")).alias("d")
    )


@pytest.mark.parametrize("mean", [0.7, 5.0, 12.0, 29.0, 31.0, 1000.0, 1e9])
def test_poisson_draws(spark, mean):
    """Mean, variance and shape: the largest gap between the distribution functions."""
    n = 4000
    got = [r["d"] for r in draws(spark, mean, n).collect()]
    average = sum(got) / n
    assert abs(average - mean) < 5 * (mean / n) ** 0.5
    assert 0.85 * mean < sum((d - average) ** 2 for d in got) / n < 1.15 * mean
    assert min(got) >= 0

    def below_or_at(k):
        if mean > 1e6:
            return 0.5 * math.erfc((mean - k - 0.5) / math.sqrt(2 * mean))
        return math.fsum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(k + 1))

    got.sort()
    last = {k: at + 1 for at, k in enumerate(got)}
    assert max(abs(at / n - below_or_at(k)) for k, at in last.items()) < 1.95 / n**0.5


def test_poisson_draw_of_nothing(spark):
    drawn = spark.range(1).select(
        perf.poisson_draw(F.lit(0), F.lit("s")).alias("zero"),
        perf.poisson_draw(F.lit(None), F.lit("s")).alias("none"),
    ).first()
    assert tuple(drawn) == (0, None)


def test_intervals_cover_the_true_value(spark):
    """Of 200 samples, about 95 in 100 have an interval around the true share."""
    rng, true, size = random.Random(11), 0.3, 300
    hits = [sum(rng.random() < true for _ in range(size)) for _ in range(200)]
    cells = spark.createDataFrame([(i, y, h if y else size - h) for i, h in enumerate(hits) for y in (0, 1)], "i int, y int, n int")
    drawn = cells.select("i", "y", "n", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("replicate")).select(
        "i", "replicate", "y", perf.poisson_draw(F.col("n"), *[F.col(c).cast("string") for c in ("i", "y", "replicate")]).alias("n")
    )
    share = drawn.groupBy("i", "replicate").agg((F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("value"))
    inside = perf._interval(share, ["i"], 0.95).where((F.col("ci_low") <= true) & (F.col("ci_high") >= true)).count()
    assert 178 <= inside <= 199


def test_scores_outside_the_range_are_an_error(spark):
    for bad in (-1, 101):
        df = spark.createDataFrame([(1, 1, 0, 50), (2, 2, 1, bad)], "SEX int, MARRIAGE int, default int, score int")
        with pytest.raises(Exception, match="score outside"):
            trade.threshold_curves(df, {"SEX": (1,)}).collect()


def test_intervals_hold_the_value_and_repeat(spark):
    rng = random.Random(2)
    df = frame(spark, [(rng.randint(1, 2), 1, rng.randint(0, 1), rng.randint(0, 1)) for _ in range(400)])
    counted = fair.cells(df, {"SEX": (1,)})
    first = perf.performance_intervals(counted, {"SEX": (1,)}, replicates=100)
    for r in first.collect():
        assert r["ci_low"] < r["value"] < r["ci_high"]
        assert r["ci_high"] - r["ci_low"] < 0.25
    again = perf.performance_intervals(fair.cells(df.repartition(7), {"SEX": (1,)}), {"SEX": (1,)}, replicates=100)
    assert rows(first) == rows(again)
    table = perf.performance_table(first, "r")
    assert table.count() == 12
    assert perf.values_only(table).count() == 6


def brute_force(data, metric, bins):
    """All pairs of thresholds, in exact fractions."""
    from fractions import Fraction

    sides = {True: [d for d in data if d[0] == 1], False: [d for d in data if d[0] != 1]}
    p = sum(y for _, _, y in data)
    n = len(data) - p

    def at(side, th):
        rows_ = sides[side]
        tp = sum(1 for _, s, y in rows_ if s >= th and y)
        fp = sum(1 for _, s, y in rows_ if s >= th and not y)
        pos = sum(y for _, _, y in rows_)
        neg = len(rows_) - pos
        if metric == "equal_opportunity":
            rate = Fraction(tp, pos) if pos else None
        elif metric == "demographic_parity":
            rate = Fraction(tp + fp, len(rows_)) if rows_ else None
        else:
            rate = (Fraction(tp, pos) + Fraction(fp, neg)) / 2 if pos and neg else None
        return tp, neg - fp, rate

    points = []
    curve = {side: [at(side, th) for th in range(bins + 1)] for side in sides}
    for a, b in itertools.product(range(bins + 1), repeat=2):
        (tp1, tn1, r1), (tp2, tn2, r2) = curve[True][a], curve[False][b]
        accuracy = (Fraction(tp1 + tp2, p) + Fraction(tn1 + tn2, n)) / 2
        gap = abs(r1 - r2) if r1 is not None and r2 is not None else None
        points.append((a, b, accuracy, gap))
    best = {
        "max_perf_point": min(points, key=lambda t: (-t[2], t[0], t[1])),
        "max_perf_single_th": min((t for t in points if t[0] == t[1]), key=lambda t: (-t[2], t[0])),
    }
    defined = [t for t in points if t[3] is not None]
    if defined:
        best["max_perf_neutral_fair"] = min(defined, key=lambda t: (t[3], -t[2], t[0], t[1]))
    return {k: (v[0], v[1], float(v[2])) for k, v in best.items()}


@pytest.mark.parametrize("seed,metric", [(1, "equal_opportunity"), (2, "demographic_parity"), (3, "equal_odds")])
def test_tradeoff_against_all_pairs(spark, seed, metric):
    rng = random.Random(seed)
    data = []
    for _ in range(60):
        y = rng.randint(0, 1)
        data.append((rng.randint(1, 2), min(12, max(0, int(rng.gauss(5 + 3 * y, 3)))), y))
    df = spark.createDataFrame(data, "SEX int, score int, default int")
    found = trade.tradeoff(df, {"SEX": (1,)}, metric=metric, bins=12)
    got = {r["metrics"]: (r["thresh_1"], r["thresh_2"], pytest.approx(r["balanced_accuracy"])) for r in found.collect()}
    assert brute_force(data, metric, 12) == got


def test_tradeoff_without_positives_on_one_side(spark):
    data = [(1, 3, 1), (1, 1, 0), (2, 2, 0), (2, 3, 0)]
    df = spark.createDataFrame(data, "SEX int, score int, default int")
    got = {r["metrics"]: r for r in trade.tradeoff(df, {"SEX": (1,)}, bins=4).collect()}
    assert got["max_perf_neutral_fair"]["thresh_1"] is None
    assert (got["max_perf_point"]["thresh_1"], got["max_perf_point"]["thresh_2"]) == (2, 4)


def test_probability_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.399,), (0.4,), (1.0,)], "p double")
    assert [r[0] for r in df.select(trade.probability_bins(F.col("p"))).collect()] == [0, 39, 40, 100]
