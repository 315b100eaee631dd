"""Drift of features and targets between a reference and a production slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import DISTANCE_LIMIT, SIGNIFICANCE, ColumnRoles
from evenkeel.functions.statistics import chi_square_tail, kolmogorov_tail, normal_two_sided
from evenkeel.operators import distribution as dist
from evenkeel.operators.prepare import as_date

# A reference without any spread would make the normalized distance infinite.
SMALLEST_SPREAD = 0.001


def numeric_statistics(
    tagged: dist.Tagged, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Kolmogorov-Smirnov and normalized Wasserstein distance per numeric feature.

    ``wasserstein_norm`` is the area between the two distribution functions in
    units of the reference's population standard deviation.
    """
    ranked = dist.cumulative(tagged, features, buckets)
    gap = F.abs(
        F.try_divide(F.col("cum_ref"), F.col("total_ref"))
        - F.try_divide(F.col("cum_prod"), F.col("total_prod"))
    )
    off = F.col("value") - F.col("mean_ref")
    sums = ranked.groupBy("feature").agg(
        F.any_value("total_ref").alias("n_ref"),
        F.any_value("total_prod").alias("n_prod"),
        F.max(F.when(F.col("value").isNotNull(), gap)).alias("ks"),
        F.sum(gap * (F.col("next_value") - F.col("value"))).alias("area"),
        F.sum(F.col("n_ref") * off * off).alias("squares"),
    )
    out = dist.named(sums, features)
    spread = F.greatest(
        F.sqrt(F.try_divide(F.col("squares"), F.col("n_ref"))), F.lit(SMALLEST_SPREAD)
    )
    distance = F.coalesce(F.col("area"), F.lit(0.0)) / spread
    return out.select(
        "feature",
        "n_ref",
        "n_prod",
        F.col("ks").alias("ks_statistic"),
        kolmogorov_tail(F.col("ks"), F.col("n_ref"), F.col("n_prod")).alias("ks_p_value"),
        F.when(F.col("ks").isNotNull(), distance).alias("wasserstein_norm"),
    )


def category_statistics(tagged: dist.Tagged, features: Sequence[str]) -> DataFrame:
    """Chi-square homogeneity, two-proportion z and Jensen-Shannon per feature.

    The chi-square compares both slices with their pooled shares, so a category
    seen in one slice only is fine. The z-test is given where a feature has
    exactly two values; its statistic is the absolute value, which is the same
    for either of them. The Jensen-Shannon distance uses natural logarithms.
    """
    counts = dist.with_totals(dist.value_counts(tagged, features, "string"))
    # Missing values weigh nothing. Filtering them out would change the counts'
    # plan below its shuffle, and the totals could not share that shuffle.
    a, b = dist.present("n_ref").cast("double"), dist.present("n_prod").cast("double")
    total_a, total_b = F.col("total_ref").cast("double"), F.col("total_prod").cast("double")
    cross = a * total_b - b * total_a
    term = F.try_divide(cross * cross, (a + b) * total_a * total_b)
    p, q = F.try_divide(a, total_a), F.try_divide(b, total_b)
    middle = (p + q) / 2

    def divergence(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / middle)).when(share == 0, 0.0)

    out = counts.groupBy("feature").agg(
        F.any_value("total_ref").alias("n_ref"),
        F.any_value("total_prod").alias("n_prod"),
        F.any_value("n_values").alias("n_values"),
        F.sum(term).alias("chi2"),
        F.sum((divergence(p) + divergence(q)) / 2).alias("js"),
        F.sum(F.abs(p - q)).alias("apart"),
        F.sum(F.pow(F.try_divide(a + b, total_a + total_b), F.lit(2))).alias("same"),
    )
    return _with_tests(dist.named(out, features))


def _with_tests(out: DataFrame) -> DataFrame:
    both = (F.col("n_ref") > 0) & (F.col("n_prod") > 0)
    degrees = F.col("n_values") - 1
    n_a, n_b = F.col("n_ref"), F.col("n_prod")
    # With two values of pooled shares s and 1 - s: the sum of absolute gaps is
    # twice the gap, and one minus the sum of squared shares is 2 s (1 - s).
    error = F.sqrt(
        (1 - F.col("same")) / 2 * (F.try_divide(F.lit(1), n_a) + F.try_divide(F.lit(1), n_b))
    )
    z = F.when(F.col("n_values") == 2, F.try_divide(F.col("apart") / 2, error))
    tested = out.select(
        "feature",
        "n_ref",
        "n_prod",
        "n_values",
        F.when(both & (degrees > 0), F.col("chi2")).alias("chi2_statistic"),
        F.when(both & (degrees > 0), degrees).alias("degrees"),
        z.alias("z_statistic"),
        F.when(both, F.sqrt(F.greatest(F.col("js"), F.lit(0.0)))).alias("js_distance"),
    )
    return tested.select(
        "*",
        chi_square_tail(F.col("chi2_statistic"), F.col("degrees")).alias("chi2_p_value"),
        normal_two_sided(F.col("z_statistic")).alias("z_p_value"),
    )


def _decided(df: DataFrame) -> DataFrame:
    score = F.col("drift_score")
    distance = F.col("stattest_name").isin("wasserstein_norm", "js")
    drifted = F.when(distance, score >= DISTANCE_LIMIT).otherwise(score < SIGNIFICANCE)
    return df.withColumn("drift_detected", F.coalesce(drifted, F.lit(False)))


def _numeric_scores(
    tagged: dist.Tagged, features: Sequence[str], method: str, buckets: int | None
) -> DataFrame:
    name, score = {
        "test": ("ks", "ks_p_value"),
        "distance": ("wasserstein_norm", "wasserstein_norm"),
    }[method]
    return numeric_statistics(tagged, features, buckets).select(
        "feature",
        F.lit("num").alias("feature_type"),
        F.lit(name).alias("stattest_name"),
        F.col(score).alias("drift_score"),
    )


def _category_scores(tagged: dist.Tagged, features: Sequence[str], method: str) -> DataFrame:
    stats = category_statistics(tagged, features)
    if method == "distance":
        name, score = F.lit("js"), F.col("js_distance")
    else:
        two = F.col("n_values") == 2
        name = F.when(two, "z").otherwise("chi2_homogeneity")
        score = F.when(two, F.col("z_p_value")).otherwise(F.col("chi2_p_value"))
    return stats.select(
        "feature",
        F.lit("cat").alias("feature_type"),
        name.alias("stattest_name"),
        score.alias("drift_score"),
    )


def feature_drift(
    tagged: dist.Tagged,
    numerical: Sequence[str] = (),
    categorical: Sequence[str] = (),
    method: str = "test",
    buckets: int | None = None,
) -> DataFrame:
    """One row per feature: which test, its score, and whether it means drift.

    ``method="test"``: p-values, drift below 0.05 (KS for numeric features, z for
    two-valued and chi-square for other categories). ``method="distance"``: for
    slices so large that every p-value is tiny; Wasserstein and Jensen-Shannon,
    drift from 0.1.
    """
    if method not in ("test", "distance"):
        raise ValueError("method must be 'test' or 'distance'")
    parts = []
    if categorical:
        parts.append(_category_scores(tagged, categorical, method))
    if numerical:
        parts.append(_numeric_scores(tagged, numerical, method, buckets))
    if not parts:
        raise ValueError("no features to compare")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _decided(rows)


def _signed(df: DataFrame, project: str, model: str, as_of: str | Column | None) -> DataFrame:
    return df.select(
        "*",
        as_date(as_of).alias("date"),
        F.lit(project).alias("project_name"),
        F.lit(model).alias("model_name"),
    )


def dataset_drift(
    tagged: dist.Tagged,
    roles: ColumnRoles,
    project: str,
    model: str,
    as_of: str | Column | None = None,
    method: str = "test",
) -> DataFrame:
    """The dataset-drift table of a run, in its declared schema."""
    rows = feature_drift(tagged, roles.numerical, roles.categorical, method)
    return _signed(
        rows.select("feature", "feature_type", "stattest_name", "drift_score", "drift_detected"),
        project,
        model,
        as_of,
    )


def label_drift(
    tagged: dist.Tagged,
    roles: ColumnRoles,
    project: str,
    model: str,
    as_of: str | Column | None = None,
    method: str = "test",
) -> DataFrame:
    """The label-drift table of a run: the target, and the prediction if present."""
    targets = [c for c in (roles.target, roles.prediction) if c and c in tagged.columns]
    if not targets:
        raise ValueError("neither target nor prediction is a column of the frame")
    numeric, categories = (targets, ()) if roles.target_is_numeric else ((), targets)
    rows = feature_drift(tagged, numeric, categories, method)
    return _signed(
        rows.select(
            F.col("feature").alias("target_name"),
            F.col("feature_type").alias("target_type"),
            "stattest_name",
            "drift_score",
            "drift_detected",
        ),
        project,
        model,
        as_of,
    )


def drift_report(tagged: dist.Tagged, roles: ColumnRoles, bins: int = 10) -> DataFrame:
    """The distributions behind a drift report: bins of numeric features and
    targets, categories of the others, per slice with counts and shares."""
    targets = tuple(c for c in (roles.target, roles.prediction) if c and c in tagged.columns)
    numeric = roles.numerical + (targets if roles.target_is_numeric else ())
    categories = roles.categorical + (() if roles.target_is_numeric else targets)
    parts = []
    if numeric:
        parts.append(
            dist.histogram(tagged, numeric, bins).select(
                "feature", "dataset", F.col("bucket").cast("string").alias("bucket"), "n", "share"
            )
        )
    if categories:
        parts.append(
            dist.category_shares(tagged, categories).select(
                "feature", "dataset", F.col("category").alias("bucket"), "n", "share"
            )
        )
    if not parts:
        raise ValueError("no columns to report on")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
