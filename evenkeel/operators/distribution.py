"""Counts of feature values in a reference and a production slice.

All drift tests, histograms of categories and quality measures are functions of
how often each distinct value occurs in either slice, so the rows are read once,
reduced to those counts inside the map tasks, and shuffled once.

Input frames carry the flags ``in_ref`` and ``in_prod`` (see
``prepare.tag_windows``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.config import ColumnRoles
from evenkeel.operators.joins import LANES, task_number

SIDES = ("ref", "prod")
MIN_BUCKETS = 256
MAX_BUCKETS = 8192


def _finite(column: Column) -> Column:
    """A number as a double; values that are undefined or infinite count as missing."""
    number = column.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


@dataclass(frozen=True)
class Summary:
    """Value counts that stand for the rows they were taken from.

    ``counts``: rows of ``summarize`` with the flags ``in_ref`` and ``in_prod``. All
    measures take a summary in place of tagged rows, and give the same results.
    """

    counts: DataFrame
    features: tuple[str, ...]

    @property
    def sparkSession(self) -> SparkSession:  # noqa: N802
        return self.counts.sparkSession

    @property
    def columns(self) -> list[str]:
        return list(self.features)

    def long(self, features: Sequence[str], kind: str) -> DataFrame:
        if lacking := set(features) - set(self.features):
            raise ValueError(f"no counts are stored for {sorted(lacking)}")
        own, value = ("num", "number") if kind == "double" else ("cat", "category")
        place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1
        return self.counts.where((F.col("kind") == own) & F.col("feature").isin(list(features))).select(
            place.cast("int").alias("feature"), F.col(value).alias("value"), "in_ref", "in_prod", "n"
        )


Tagged = DataFrame | Summary


def summarize(df: DataFrame, roles: ColumnRoles, by: Sequence[str]) -> DataFrame:
    """``(*by, feature, kind, number, category, n)``: how often each value occurs.

    Counts of parts add up to those of the whole, so reports over any windows of the
    ``by`` columns can be made from them. Combined in the map tasks; a column with few
    distinct values leaves few rows however many there were.
    """

    def cell(name: str, numeric: bool) -> Column:
        column = F.col(f"`{name}`")
        none = F.lit(None)
        return F.struct(
            F.lit(name).alias("feature"),
            F.lit("num" if numeric else "cat").alias("kind"),
            (_finite(column) if numeric else none.cast("double")).alias("number"),
            (none if numeric else column).cast("string").alias("category"),
        )

    numeric = {*roles.numerical, *(roles.targets if roles.target_is_numeric else ())}
    cells = [cell(c, c in numeric) for c in roles.columns]
    long = df.select(*by, F.inline(F.array(*cells)))
    return long.groupBy(*by, "feature", "kind", "number", "category").agg(F.count(F.lit(1)).alias("n"))


def _rows(tagged: Tagged, flag: str) -> Column:
    """The number of rows with a flag."""
    if isinstance(tagged, Summary):
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(F.lit(0).cast("long")))
    return F.count_if(flag)


def infinite_values(tagged: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, dataset, n_infinite)``: infinite values, which other measures count as missing."""
    sides = [
        F.count_if(F.col(f"in_{s}") & (F.abs(F.col(f"`{c}`").cast("double")) == F.lit(float("inf")))).alias(f"{s}_{i}")
        for i, c in enumerate(features) for s in SIDES
    ]
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(s).alias("dataset"), F.col(f"{s}_{i}").alias("n_infinite"))
        for i, c in enumerate(features) for s in SIDES
    ]
    return tagged.agg(*sides).select(F.inline(F.array(*rows)))


def _long(tagged: Tagged, features: Sequence[str], kind: str) -> DataFrame:
    """One row per row and feature: ``feature``, ``value``, ``in_ref``, ``in_prod``.

    A feature is a number, its place in ``features``: shorter to shuffle and
    quicker to compare than its name, which ``named`` puts back.

    The flags travel inside the unpivoted value. As identifier columns of the
    unpivot they would keep Spark from recognizing that two uses of this frame
    in one query are the same, and the input would be read and shuffled twice.
    """

    if isinstance(tagged, Summary):
        return tagged.long(features, kind)

    def value(name: str) -> Column:
        column = F.col(f"`{name}`")
        return _finite(column) if kind == "double" else column.cast(kind)

    cells = tagged.select(
        *[
            F.struct(
                F.lit(i).alias("feature"), value(f).alias("value"), F.col("in_ref"), F.col("in_prod")
            ).alias(f)
            for i, f in enumerate(features)
        ]
    )
    return cells.unpivot([], list(features), "name", "cell").select(
        "cell.feature", "cell.value", "cell.in_ref", "cell.in_prod"
    )


def named(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature numbers replaced by feature names."""
    names = F.array(*[F.lit(f) for f in features])
    return df.withColumn("feature", F.get(names, F.col("feature")))


def value_counts(tagged: Tagged, features: Sequence[str], kind: str) -> DataFrame:
    """Rows per (feature, value) in either slice; missing values are a null value.

    ``kind`` is ``double`` for numeric features and ``string`` for categories.
    """
    return (
        _long(tagged, features, kind)
        .groupBy("feature", "value")
        .agg(_rows(tagged, "in_ref").alias("n_ref"), _rows(tagged, "in_prod").alias("n_prod"))
    )


def present(n: str) -> Column:
    return F.when(F.col("value").isNotNull(), F.col(n)).otherwise(F.lit(0).cast("long"))


def absent(n: str) -> Column:
    return F.when(F.col("value").isNull(), F.col(n)).otherwise(F.lit(0).cast("long"))


def totals(counts: DataFrame) -> DataFrame:
    """One row per feature: rows with a value, and number of values."""
    return counts.groupBy("feature").agg(
        *[F.sum(present(f"n_{s}")).alias(f"total_{s}") for s in SIDES],
        F.count("value").alias("n_values"),
    )


def with_totals(counts: DataFrame) -> DataFrame:
    """Counts next to their feature's totals (as many broadcast rows as features)."""
    return counts.join(F.broadcast(totals(counts)), "feature")


def default_buckets(df: Tagged) -> int:
    """A power of two, some four times the number of shuffle partitions."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = MIN_BUCKETS
    while buckets < min(wanted, MAX_BUCKETS):
        buckets *= 2
    return buckets


def _search(df: DataFrame, bounds: str, value: str, size: int) -> DataFrame:
    """Adds ``bucket``: how many of the ``size`` - 1 sorted bounds lie below the value.

    A binary search written out as one projection per halving, so that it stays
    inside generated code.
    """
    df = df.withColumn("bucket", F.lit(0))
    step = size // 2
    while step:
        halved = (
            f"CASE WHEN get({bounds}, bucket + {step - 1}) < {value} "
            f"THEN bucket + {step} ELSE bucket END"
        )
        df = df.withColumn("bucket", F.expr(halved))
        step //= 2
    return df


def quantile_bounds(tagged: Tagged, features: Sequence[str], buckets: int) -> DataFrame:
    """Approximate quantiles of each feature, from a mergeable sketch: one row
    per feature, null bounds where it has no value."""
    accuracy = min(16 * buckets, 65535)
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    # The sketches of the tasks are merged in lanes first: a feature is one group,
    # and one task could not take in a sketch from every task of a large scan.
    lanes = (
        _long(tagged, features, "double")
        .select("feature", "value", task_number(LANES).alias("lane"))
        .groupBy("feature", "lane")
        .agg(
            F.expr(f"kll_sketch_agg_double(value, {accuracy})").alias("sketch"),
            F.count("value").alias("n"),
        )
    )
    sketched = lanes.groupBy("feature").agg(
        F.expr(f"kll_merge_agg_double(sketch, {accuracy})").alias("sketch"), F.sum("n").alias("n")
    )
    return sketched.selectExpr(
        "feature",
        "CASE WHEN n > 0 THEN "
        f"kll_sketch_get_quantile_double(sketch, array({shares})) END AS bounds",
    )


def cumulative(
    tagged: Tagged, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Numeric value counts with running totals over the sorted values of a feature.

    A window over the whole feature would sort all its values in one task.
    Instead each feature is cut at approximate quantiles into buckets; running
    totals are taken within a bucket, and the totals of the buckets before it
    (at most ``buckets`` rows per feature, broadcast) are added. The result is
    exact however rough the quantiles are, as they are fixed before. A bucket holds about one part in
    ``buckets`` of the rows, and a value that is more frequent than that is a
    single row by then.

    Per distinct value: ``n_*`` rows, ``cum_*`` rows up to and including it, and
    the ``next_value``; missing values are one row with a null value and
    ``missing_*`` rows. Per feature: ``rows_*``, ``total_*`` rows with a value,
    and the ``mean_*``.
    """
    buckets = buckets or default_buckets(tagged)
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    counts = value_counts(tagged, features, "double")
    # The sketch is randomized, so its cut points are taken once: a row per feature.
    # Both uses of ``placed`` then agree even if Spark plans them apart.
    cuts = quantile_bounds(tagged, features, buckets)
    fixed = tagged.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
    bounds = F.broadcast(fixed)
    # One explicit shuffle that both uses below share.
    placed = (
        _search(counts.join(bounds, "feature"), "bounds", "value", buckets)
        .select("feature", "bucket", "value", "n_ref", "n_prod")
        .repartition("feature", "bucket")
    )
    starts = _bucket_starts(placed)
    inside = W.partitionBy("feature", "bucket").orderBy("value")
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = placed.withColumns(
        {
            **{f"run_{s}": F.sum(present(f"n_{s}")).over(running) for s in SIDES},
            "next_inside": F.lead("value").over(inside),
        }
    )
    return local.join(F.broadcast(starts), ["feature", "bucket"]).select(
        "feature",
        "value",
        *[present(f"n_{s}").alias(f"n_{s}") for s in SIDES],
        *[absent(f"n_{s}").alias(f"missing_{s}") for s in SIDES],
        *[(F.col(f"start_{s}") + F.col(f"run_{s}")).alias(f"cum_{s}") for s in SIDES],
        *[f"{name}_{s}" for s in SIDES for name in ("rows", "total", "mean")],
        F.coalesce("next_inside", "next_start").alias("next_value"),
    )


def _bucket_starts(placed: DataFrame) -> DataFrame:
    """Per bucket the running totals before it, with the totals of its feature."""
    sums = placed.groupBy("feature", "bucket").agg(
        *[F.sum(f"n_{s}").alias(f"b_rows_{s}") for s in SIDES],
        *[F.sum(present(f"n_{s}")).alias(f"b_total_{s}") for s in SIDES],
        *[F.sum(F.col(f"n_{s}") * F.col("value")).alias(f"b_sum_{s}") for s in SIDES],
        F.min("value").alias("first_value"),
    )
    whole = W.partitionBy("feature")
    order = whole.orderBy("bucket")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    columns = []
    for s in SIDES:
        total = F.sum(f"b_total_{s}").over(whole)
        columns += [
            F.coalesce(F.sum(f"b_total_{s}").over(before), F.lit(0)).alias(f"start_{s}"),
            F.sum(f"b_rows_{s}").over(whole).alias(f"rows_{s}"),
            total.alias(f"total_{s}"),
            F.try_divide(F.sum(f"b_sum_{s}").over(whole), total).alias(f"mean_{s}"),
        ]
    return sums.select(
        "feature", "bucket", *columns, F.lead("first_value").over(order).alias("next_start")
    )


def numeric_edges(tagged: Tagged, features: Sequence[str]) -> DataFrame:
    """Lowest and highest value of each feature over both slices: one row each."""
    return (
        _long(tagged, features, "double")
        .groupBy("feature")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )


def histogram(tagged: Tagged, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Rows per feature, slice and bin; both slices share ``bins`` equal-width bins."""
    edges = F.broadcast(numeric_edges(tagged, features))
    width = F.col("high") - F.col("low")
    position = F.floor(F.try_divide(F.col("value") - F.col("low"), width) * bins).cast("int") + 1
    bucket = F.least(F.lit(bins), F.coalesce(position, F.lit(1)))
    counted = (
        _long(tagged, features, "double")
        .where(F.col("value").isNotNull())
        .join(edges, "feature")
        .groupBy("feature", bucket.alias("bucket"), "low", "high")
        .agg(_rows(tagged, "in_ref").alias("n_ref"), _rows(tagged, "in_prod").alias("n_prod"))
    )
    lower = F.col("low") + (F.col("bucket") - 1) * (F.col("high") - F.col("low")) / bins
    sides = by_side(
        counted.select("feature", "bucket", lower.alias("lower_edge"), "n_ref", "n_prod"),
        ["feature", "bucket", "lower_edge"],
    )
    return named(sides, features)


def category_shares(tagged: Tagged, features: Sequence[str]) -> DataFrame:
    """Rows and share per feature, slice and category."""
    counts = value_counts(tagged, features, "string").where(F.col("value").isNotNull())
    sides = by_side(counts.withColumnRenamed("value", "category"), ["feature", "category"])
    return named(sides, features)


def by_side(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n_ref`` and ``n_prod`` as rows, with the share within feature and slice.

    Totals come from a small aggregation rather than from a window, which would
    gather all categories of a feature in one task.
    """
    sums = df.groupBy("feature").agg(
        F.sum("n_ref").alias("sum_ref"), F.sum("n_prod").alias("sum_prod")
    )
    sides = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("dataset"),
                    F.col(f"n_{s}").alias("n"),
                    F.try_divide(F.col(f"n_{s}"), F.col(f"sum_{s}")).alias("share"),
                )
                for s in SIDES
            ]
        )
    )
    return df.join(F.broadcast(sums), "feature").select(*keys, sides)
