import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel.config import ColumnRoles
from evenkeel.operators import distribution as dist
from evenkeel.operators import drift, quality
from evenkeel.plans import catalog


def tagged(spark, ref, prod, kind="double", name="x"):
    data = [(v, True, False) for v in ref] + [(v, False, True) for v in prod]
    return spark.createDataFrame(data, f"{name} {kind}, in_ref boolean, in_prod boolean")


def brute(ref, prod):
    """KS and normalized Wasserstein by direct evaluation."""
    a = np.sort([v for v in ref if v is not None and not math.isnan(v)])
    b = np.sort([v for v in prod if v is not None and not math.isnan(v)])
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(a, grid, side="right") / len(a)
    fb = np.searchsorted(b, grid, side="right") / len(b)
    area = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid))
    return np.max(np.abs(fa - fb)), area / max(np.std(a), 0.001)


@pytest.mark.parametrize("buckets", [2, 4, 64])
def test_numeric_statistics_against_brute_force(spark, buckets):
    """Ties, missing values, NaN and a dominating value, at any bucket count."""
    rng = random.Random(buckets)
    ref = [round(rng.gauss(0, 2), 1) for _ in range(400)] + [0.0] * 300 + [None, float("nan")]
    prod = [round(rng.gauss(0.4, 3), 1) for _ in range(350)] + [0.0] * 100 + [None]
    df = tagged(spark, ref, prod).repartition(5)
    got = drift.numeric_statistics(df, ["x"], buckets).first()
    ks, area = brute(ref, prod)
    assert (got["n_ref"], got["n_prod"]) == (700, 450)
    assert got["ks_statistic"] == pytest.approx(ks, abs=1e-12)
    assert got["wasserstein_norm"] == pytest.approx(area, rel=1e-9)


def test_cumulative_counts_are_exact(spark):
    rng = random.Random(3)
    ref = [float(rng.randint(0, 200)) for _ in range(500)]
    prod = [float(rng.randint(50, 250)) for _ in range(500)]
    out = dist.cumulative(tagged(spark, ref, prod), ["x"], 8).where("value IS NOT NULL").orderBy("value").collect()
    values = [r["value"] for r in out]
    assert values == sorted(set(ref) | set(prod))
    assert [r["cum_ref"] for r in out] == [sum(v <= x for v in ref) for x in values]
    assert [r["cum_prod"] for r in out] == [sum(v <= x for v in prod) for x in values]
    assert [r["next_value"] for r in out] == values[1:] + [None]
    with pytest.raises(ValueError):
        dist.cumulative(tagged(spark, ref, prod), ["x"], 6)


def test_identical_and_disjoint_slices(spark):
    same = [float(i) for i in range(50)]
    got = drift.numeric_statistics(tagged(spark, same, same), ["x"], 4).first()
    assert (got["ks_statistic"], got["ks_p_value"], got["wasserstein_norm"]) == (0.0, 1.0, 0.0)
    far = [v + 1000 for v in same]
    got = drift.numeric_statistics(tagged(spark, same, far), ["x"], 4).first()
    assert got["ks_statistic"] == 1.0 and got["ks_p_value"] < 1e-9
    cats = drift.category_statistics(tagged(spark, ["a", "b"] * 9, ["a", "b"] * 9, "string"), ["x"]).first()
    assert (cats["chi2_statistic"], cats["chi2_p_value"]) == (0.0, 1.0)
    assert (cats["z_statistic"], cats["z_p_value"], cats["js_distance"]) == (0.0, 1.0, 0.0)


def test_one_category_has_no_test(spark):
    df = tagged(spark, ["a"] * 5, ["a"] * 7, "string")
    got = drift.category_statistics(df, ["x"]).first()
    assert got["chi2_p_value"] is None and got["z_p_value"] is None
    assert drift.feature_drift(df, categorical=["x"]).first()["drift_detected"] is False


def test_category_new_in_production(spark):
    got = drift.category_statistics(tagged(spark, ["a", "b"] * 10, ["a", "b", "c"] * 10, "string"), ["x"]).first()
    expected = 0.0
    for o_ref, o_prod in ((10, 10), (10, 10), (0, 10)):
        for o, n in ((o_ref, 20), (o_prod, 30)):
            e = (o_ref + o_prod) * n / 50
            expected += (o - e) ** 2 / e
    assert got["chi2_statistic"] == pytest.approx(expected)
    assert got["degrees"] == 2


def test_chi_square_against_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    rng = random.Random(11)
    ref = [rng.choice("aabcd") for _ in range(200)] + [None] * 3
    prod = [rng.choice("abbcd") for _ in range(250)]
    df = tagged(spark, ref, prod, "string")
    got = drift.category_statistics(df, ["x"]).first()
    indexed = StringIndexer(inputCol="x", outputCol="i").fit(df.dropna()).transform(df.dropna())
    ready = VectorAssembler(inputCols=["i"], outputCol="f").transform(indexed).withColumn("l", F.col("in_ref").cast("double"))
    expected = ChiSquareTest.test(ready, "f", "l").first()
    assert got["chi2_statistic"] == pytest.approx(expected["statistics"][0])
    assert got["chi2_p_value"] == pytest.approx(expected["pValues"][0], abs=1e-9)


def test_z_is_the_root_of_chi_square(spark):
    got = drift.category_statistics(tagged(spark, ["a"] * 30 + ["b"] * 70, ["a"] * 45 + ["b"] * 55, "string"), ["x"]).first()
    pooled = 75 / 200
    z = abs(0.30 - 0.45) / math.sqrt(pooled * (1 - pooled) * (2 / 100))
    assert got["z_statistic"] == pytest.approx(z)
    assert got["z_statistic"] ** 2 == pytest.approx(got["chi2_statistic"])
    assert got["z_p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_choice_of_test_and_decision(spark):
    data = [(float(i % 7), "ab"[i % 2], "abc"[i % 3], i < 60, i >= 60) for i in range(120)]
    df = spark.createDataFrame(data, "n double, two string, three string, in_ref boolean, in_prod boolean")
    got = {r["feature"]: r["stattest_name"] for r in drift.feature_drift(df, ["n"], ["two", "three"]).collect()}
    assert got == {"n": "ks", "two": "z", "three": "chi2_homogeneity"}
    far = {r["feature"]: r["stattest_name"] for r in drift.feature_drift(df, ["n"], ["two"], "distance").collect()}
    assert far == {"n": "wasserstein_norm", "two": "js"}
    with pytest.raises(ValueError):
        drift.feature_drift(df)
    with pytest.raises(ValueError):
        drift.feature_drift(df, ["n"], method="other")


def test_drift_tables_have_declared_schemas(spark):
    from evenkeel import schemas

    df = tagged(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 4.0])
    roles = ColumnRoles(target="x", numerical=("x",), target_is_numeric=True)
    table = drift.dataset_drift(df, roles, "p", "m", "2022-12-17")
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schemas.DATASET_DRIFT]
    label = drift.label_drift(df, roles, "p", "m", "2022-12-17")
    assert [(f.name, f.dataType) for f in label.schema] == [(f.name, f.dataType) for f in schemas.LABEL_DRIFT]
    assert label.first()["date"] == dt.date(2022, 12, 17)
    assert label.first()["model_name"] == "m"


def test_empty_slice_has_no_score(spark):
    df = tagged(spark, [1.0, 2.0], [])
    got = drift.numeric_statistics(df, ["x"]).first()
    assert (got["n_prod"], got["ks_statistic"], got["wasserstein_norm"]) == (0, None, None)
    assert drift.category_statistics(df, ["x"]).first()["chi2_p_value"] is None
    assert drift.feature_drift(df, ["x"]).first()["drift_detected"] is False
    for profile in (quality.numeric_profile(df, ["x"]), quality.category_profile(df, ["x"])):
        empty = profile.where("dataset = 'prod'").first()
        assert (empty["n_rows"], empty["n_missing"], empty["n_distinct"]) == (0, 0, 0)


def test_feature_without_values_in_one_slice(spark):
    """All values missing in production: no score, not an error."""
    df = tagged(spark, [1.0, 2.0], [None, None])
    got = drift.feature_drift(df, ["x"]).first()
    assert got["drift_score"] is None and got["drift_detected"] is False
    profile = {r["dataset"]: r for r in quality.numeric_profile(df, ["x"]).collect()}
    assert profile["prod"]["n_missing"] == 2 and profile["prod"]["mean"] is None
    assert drift.category_statistics(tagged(spark, ["a", "b"], [None], "string"), ["x"]).first()["chi2_p_value"] is None


def test_results_do_not_depend_on_partitions(spark):
    rng = random.Random(1)
    df = tagged(spark, [rng.gauss(0, 1) for _ in range(300)], [rng.gauss(0.2, 1) for _ in range(300)])
    found = []
    for n in (1, 16):
        r = drift.numeric_statistics(df.repartition(n), ["x"], 8).first()
        found.append((r["ks_statistic"], round(r["wasserstein_norm"], 9)))
    assert found[0] == found[1]


def test_histogram(spark):
    df = tagged(spark, [0.0, 0.0, 5.0, 10.0, None], [2.5, 10.0])
    got = {(r["dataset"], r["bucket"]): r["n"] for r in dist.histogram(df, ["x"], 4).collect()}
    assert got[("ref", 1)] == 2 and got[("ref", 3)] == 1 and got[("ref", 4)] == 1
    assert got[("prod", 2)] == 1 and got[("prod", 4)] == 1
    flat = dist.histogram(tagged(spark, [3.0, 3.0], [3.0]), ["x"], 4).collect()
    assert {(r["dataset"], r["bucket"], r["n"], r["share"]) for r in flat} == {("ref", 1, 2, 1.0), ("prod", 1, 1, 1.0)}


def test_quality_profile_against_numpy(spark):
    rng = random.Random(9)
    ref = [round(rng.expovariate(1), 1) for _ in range(301)] + [None] * 7
    prod = [round(rng.expovariate(0.5), 1) for _ in range(200)]
    got = {r["dataset"]: r for r in quality.numeric_profile(tagged(spark, ref, prod), ["x"], 8).collect()}
    for side, values in (("ref", ref), ("prod", prod)):
        there = np.array([v for v in values if v is not None])
        row = got[side]
        assert (row["n_rows"], row["n_missing"]) == (len(values), len(values) - len(there))
        assert row["n_distinct"] == len(set(there))
        for column, expected in (
            ("min_value", there.min()), ("max_value", there.max()), ("mean", there.mean()),
            ("stddev", there.std(ddof=1)), ("q25", np.quantile(there, 0.25)),
            ("q50", np.quantile(there, 0.5)), ("q75", np.quantile(there, 0.75)),
        ):
            assert row[column] == pytest.approx(expected), column
        values_, counts = np.unique(there, return_counts=True)
        assert row["top_number"] == values_[np.argmax(counts)]
        assert row["top_share"] == pytest.approx(counts.max() / len(there))


def test_quality_profile_of_categories(spark):
    got = rows(
        quality.category_profile(tagged(spark, ["a", "b", "b", None], ["c"], "string"), ["x"]),
        "dataset", "n_rows", "n_missing", "n_distinct", "top_category", "top_share",
    )
    assert got == [("prod", 1, 0, 1, "c", 1.0), ("ref", 4, 1, 2, "b", pytest.approx(2 / 3))]


def test_numeric_drift_needs_no_exchange_reuse(spark, small):
    name = "spark.sql.exchange.reuse"
    found = []
    for reuse in ("true", "false", "false"):
        spark.conf.set(name, reuse)
        try:
            found.append(rows(catalog.QUERIES["drift_ks"](spark, small)))
        finally:
            spark.conf.unset(name)
    assert found[0] == found[1] == found[2]
