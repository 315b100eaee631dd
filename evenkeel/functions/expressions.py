"""Column expressions for preparing credit records. All run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array


def recode_marriage(marriage: Column) -> Column:
    """Fold the classes 0 and 3 into 1; null stays null."""
    return F.when(marriage.isin(0, 3), 1).otherwise(marriage)


def payment_unmet(status: Column) -> Column:
    """1 where a payment was late; a missing status counts as 0."""
    return F.when(status > 0, 1).otherwise(0)


def payment_met(status: Column) -> Column:
    """1 where a payment was on time; a missing status counts as 0."""
    return F.when(status <= 0, 1).otherwise(0)


def row_sum(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def sex_name(sex: Column) -> Column:
    return F.when(sex == 1, "MALE").otherwise("FEMALE")


def marriage_name(marriage: Column) -> Column:
    return F.when(marriage == 1, "MARRIED").otherwise("SINGLE")


def protected_name(variable: Column, value: Column) -> Column:
    """Readable name of a protected group in a long (variable, value) table."""
    return (
        F.when(variable == "SEX", sex_name(value))
        .when(variable == "MARRIAGE", marriage_name(value))
        .otherwise(value.cast("string"))
    )


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(text, pattern)


def cast_all(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c in columns})


def select_matching(df: DataFrame, fragments: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Columns whose name contains one of ``fragments``, followed by ``extra``."""
    matched = [c for c in df.columns if any(part in c for part in fragments)]
    return df.select(*matched, *extra)


def class_probability(probability: Column, label: int = 1) -> Column:
    return vector_to_array(probability)[label]


def confidence(probability: Column) -> Column:
    """Largest class probability of a row, whichever class it belongs to."""
    return F.array_max(vector_to_array(probability))


def hash_draw(*columns: Column, seed: int, steps: int) -> Column:
    """A number below ``steps`` from a seeded md5: always the same for a row, in any engine."""
    text = F.concat_ws(":", *[c.cast("string") for c in columns], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(steps))


def hash_percent(*columns: Column, seed: int) -> Column:
    """0..99, always the same for a row."""
    return hash_draw(*columns, seed=seed, steps=100).cast("int")


def keep_map_keys(mapping: Column, keys: Sequence[str]) -> Column:
    wanted = list(keys)
    return F.map_filter(mapping, lambda key, _: key.isin(wanted))
