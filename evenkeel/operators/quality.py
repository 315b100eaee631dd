"""Data-quality profile of every column in a reference and a production slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import ColumnRoles
from evenkeel.operators import distribution as dist

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
_COLUMNS = (
    "feature", "feature_type", "dataset", "n_rows", "n_missing", "n_distinct",
    "min_value", "max_value", "mean", "stddev", "q25", "q50", "q75",
    "top_number", "top_category", "top_share",
)


def _position(share: float, total: Column) -> Column:
    return F.lit(share) * (total - 1)


def _numeric_side(s: str) -> list[Column]:
    """Aggregates of one slice over the ranked values of a feature.

    A quartile needs the values at two ranks; each is the lowest value whose
    running count exceeds the rank, so a plain minimum finds it.
    """
    n, value, cum, total = (F.col(f"n_{s}"), F.col("value"), F.col(f"cum_{s}"), F.col(f"total_{s}"))
    there = n > 0
    off = value - F.col(f"mean_{s}")
    ranks = []
    for name, share in QUARTILES.items():
        position = _position(share, total)
        ranks.append(F.min(F.when(cum > F.floor(position), value)).alias(f"{name}_low_{s}"))
        ranks.append(F.min(F.when(cum > F.ceil(position), value)).alias(f"{name}_high_{s}"))
    return [
        F.any_value(f"rows_{s}").alias(f"rows_{s}"),
        F.any_value(f"total_{s}").alias(f"total_{s}"),
        F.any_value(f"mean_{s}").alias(f"mean_{s}"),
        F.sum(f"missing_{s}").alias(f"missing_{s}"),
        F.count_if(there).alias(f"distinct_{s}"),
        F.min(F.when(there, value)).alias(f"min_{s}"),
        F.max(F.when(there, value)).alias(f"max_{s}"),
        F.sum(n * off * off).alias(f"squares_{s}"),
        F.min(F.when(there, F.struct((-n).alias("rank"), value.alias("value")))).alias(f"top_{s}"),
        *ranks,
    ]


def _numeric_row(s: str) -> Column:
    total = F.col(f"total_{s}")
    quartiles = []
    for name, share in QUARTILES.items():
        position = _position(share, total)
        low, high = F.col(f"{name}_low_{s}"), F.col(f"{name}_high_{s}")
        inside = low + (high - low) * (position - F.floor(position))
        quartiles.append(inside.alias(name))
    return F.struct(
        F.lit(s).alias("dataset"),
        F.col(f"rows_{s}").alias("n_rows"),
        F.col(f"missing_{s}").alias("n_missing"),
        F.col(f"distinct_{s}").alias("n_distinct"),
        F.col(f"min_{s}").alias("min_value"),
        F.col(f"max_{s}").alias("max_value"),
        F.col(f"mean_{s}").alias("mean"),
        F.sqrt(F.try_divide(F.col(f"squares_{s}"), total - 1)).alias("stddev"),
        *quartiles,
        F.col(f"top_{s}.value").alias("top_number"),
        F.lit(None).cast("string").alias("top_category"),
        F.try_divide(-F.col(f"top_{s}.rank"), total).alias("top_share"),
    )


def numeric_profile(
    tagged: dist.Tagged, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Profile of numeric columns; quartiles are exact and interpolated."""
    ranked = dist.cumulative(tagged, features, buckets)
    sides = [c for s in dist.SIDES for c in _numeric_side(s)]
    wide = dist.named(ranked.groupBy("feature").agg(*sides), features)
    return wide.select(
        "feature",
        F.lit("num").alias("feature_type"),
        F.inline(F.array(*[_numeric_row(s) for s in dist.SIDES])),
    ).select(*_COLUMNS)


def category_profile(tagged: dist.Tagged, features: Sequence[str]) -> DataFrame:
    """Profile of categorical columns."""
    counts = dist.value_counts(tagged, features, "string")
    value = F.col("value")

    def side(s: str) -> list[Column]:
        n = F.col(f"n_{s}")
        there = (n > 0) & value.isNotNull()
        return [
            F.sum(n).alias(f"rows_{s}"),
            F.sum(dist.present(f"n_{s}")).alias(f"total_{s}"),
            F.count_if(there).alias(f"distinct_{s}"),
            F.min(F.when(there, F.struct((-n).alias("rank"), value.alias("value")))).alias(
                f"top_{s}"
            ),
        ]

    none = F.lit(None).cast("double")

    def row(s: str) -> Column:
        return F.struct(
            F.lit(s).alias("dataset"),
            F.col(f"rows_{s}").alias("n_rows"),
            (F.col(f"rows_{s}") - F.col(f"total_{s}")).alias("n_missing"),
            F.col(f"distinct_{s}").alias("n_distinct"),
            *[none.alias(c) for c in _COLUMNS[6:14]],
            F.col(f"top_{s}.value").alias("top_category"),
            F.try_divide(-F.col(f"top_{s}.rank"), F.col(f"total_{s}")).alias("top_share"),
        )

    sides = counts.groupBy("feature").agg(*[c for s in dist.SIDES for c in side(s)])
    wide = dist.named(sides, features)
    return wide.select(
        "feature",
        F.lit("cat").alias("feature_type"),
        F.inline(F.array(*[row(s) for s in dist.SIDES])),
    ).select(*_COLUMNS)


def quality_profile(tagged: dist.Tagged, roles: ColumnRoles, buckets: int | None = None) -> DataFrame:
    """One row per column and slice."""
    targets = tuple(c for c in (roles.target, roles.prediction) if c and c in tagged.columns)
    numeric = roles.numerical + (targets if roles.target_is_numeric else ())
    categories = roles.categorical + (() if roles.target_is_numeric else targets)
    parts = []
    if numeric:
        parts.append(numeric_profile(tagged, numeric, buckets))
    if categories:
        parts.append(category_profile(tagged, categories))
    if not parts:
        raise ValueError("no columns to profile")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
