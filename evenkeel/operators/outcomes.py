"""How outcomes are distributed within each protected group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from evenkeel.config import KEY, LABEL, PREDICTION
from evenkeel.functions.expressions import protected_name


_COUNTED = ["protected_var", "group_value", "outcome", "outcome_value"]


def _distinct_clients(
    rows: DataFrame, key: str, protected: Sequence[str], outcomes: Sequence[str]
) -> DataFrame:
    """Distinct clients per variable, group, outcome and value, by unpivoting rows."""
    by_group = rows.unpivot([key, *outcomes], list(protected), "protected_var", "group_value")
    long = by_group.unpivot(
        [key, "protected_var", "group_value"], list(outcomes), "outcome", "outcome_value"
    ).where("group_value IS NOT NULL AND outcome_value IS NOT NULL")
    return long.groupBy(*_COUNTED).agg(F.countDistinct(key).alias("n_users"))


def _settled_clients(
    rows: DataFrame, key: str, protected: Sequence[str], outcomes: Sequence[str]
) -> DataFrame:
    """The same counts, unpivoting only clients whose rows disagree.

    Equal rows of a client are merged first, inside map tasks too, so a client
    with very many rows is a few records when rows are gathered by client. A
    client with one record left (nearly all) is counted in a cell of values, and
    the few cells are unpivoted in place of the rows.
    """
    columns = [*protected, *outcomes]
    by_client = rows.distinct().repartition(key)
    counted = by_client.groupBy(key).agg(
        F.count("*").alias("n"), *[F.min(c).alias(c) for c in columns]
    )
    cells = counted.where("n = 1").groupBy(*columns).agg(F.count("*").alias("n_users"))
    by_group = cells.unpivot(
        [*outcomes, "n_users"], list(protected), "protected_var", "group_value"
    )
    settled = by_group.unpivot(
        ["protected_var", "group_value", "n_users"], list(outcomes), "outcome", "outcome_value"
    ).where("group_value IS NOT NULL AND outcome_value IS NOT NULL")
    several = counted.where("n > 1").select(key).hint("shuffle_hash")
    mixed = _distinct_clients(by_client.join(several, key, "left_semi"), key, protected, outcomes)
    return (
        settled.select(*_COUNTED, "n_users")
        .unionByName(mixed)
        .groupBy(*_COUNTED)
        .agg(F.sum("n_users").alias("n_users"))
    )


def outcome_rates(
    df: DataFrame,
    protected: Sequence[str] = ("SEX", "MARRIAGE"),
    outcomes: Sequence[str] = (LABEL, PREDICTION),
    key: str = KEY,
) -> DataFrame:
    """Distinct clients and their share in percent per group and outcome value.

    All protected variables and outcomes are counted in one scan. Neither a large
    group nor a client with very many rows lands on one task.
    """
    kinds = {df.schema[p].dataType for p in protected}
    coded = len(kinds) == 1 and all(isinstance(k, NumericType) for k in kinds)
    narrow = df.select(
        key,
        *[F.col(f"`{p}`") if coded else F.col(f"`{p}`").cast("string").alias(p) for p in protected],
        *[F.col(f"`{o}`").cast("int").alias(o) for o in outcomes],
    ).where(F.col(key).isNotNull())
    # A minimum of strings would have to sort the rows of every task.
    count = _settled_clients if coded else _distinct_clients
    counts = count(narrow, key, protected, outcomes)
    group = W.partitionBy("protected_var", "group_value", "outcome")
    return counts.select(
        "protected_var",
        F.col("group_value").cast("string").alias("group_value"),
        protected_name(F.col("protected_var"), F.col("group_value")).alias("group_name"),
        "outcome",
        "outcome_value",
        "n_users",
        (F.col("n_users") * 100 / F.sum("n_users").over(group)).alias("pct_total"),
    )


def distinct_values(df: DataFrame, column: str = "protected_var") -> DataFrame:
    return df.select(column).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))
