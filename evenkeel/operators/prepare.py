"""From raw records to clean ones, and the stamps a monitored table carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import DATE, KEY, PAY_AMOUNT_COLUMNS, Window
from evenkeel.functions.expressions import hash_draw, cast_all, parse_date, recode_marriage


def clean(df: DataFrame) -> DataFrame:
    """Two marriage classes instead of four; every other column as it is."""
    return df.withColumn("MARRIAGE", recode_marriage(F.col("MARRIAGE")))


def label_column(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.col(f"`{label}`").alias("label"))


def guard_column(df: DataFrame, name: str) -> None:
    """Refuse a name that the frame already uses."""
    if name in df.columns:
        raise ValueError(f"column {name!r} exists already, choose another name")


def as_date(value: str | Column | None) -> Column:
    """A date to stamp rows with: text or a column; today if none is given."""
    if value is None:
        return F.current_date()
    return parse_date(F.lit(value)) if isinstance(value, str) else value.cast("date")


def stamp(
    df: DataFrame,
    project: str,
    model: str,
    as_of: str | Column | None = None,
    date_column: str = DATE,
) -> DataFrame:
    """Date, project and model name on every row."""
    return df.withColumns(
        {date_column: as_date(as_of), "project_name": F.lit(project), "model_name": F.lit(model)}
    )


def amounts_to_double(df: DataFrame, columns: Sequence[str] = PAY_AMOUNT_COLUMNS) -> DataFrame:
    return cast_all(df, [c for c in columns if c in df.columns])


def inside(df: DataFrame, column: str, window: Window) -> Column:
    """Strictly between the bounds.

    The bounds take the column's own type, so the column is not cast and the
    comparison reaches the file scan and the partition filter.
    """
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    return (value > F.lit(window.start).cast(kind)) & (value < F.lit(window.end).cast(kind))


def within(df: DataFrame, window: Window, column: str = DATE) -> DataFrame:
    """Rows strictly after the start and strictly before the end."""
    return df.where(inside(df, column, window))


def tag_windows(
    df: DataFrame, reference: Window, production: Window, column: str = DATE
) -> DataFrame:
    """Rows of either window with flags ``in_ref`` and ``in_prod``, in one scan.

    Two flags rather than one tag: windows may overlap, and then a row counts
    in both.
    """
    in_ref = inside(df, column, reference)
    in_prod = inside(df, column, production)
    return df.where(in_ref | in_prod).withColumns({"in_ref": in_ref, "in_prod": in_prod})


def sample_rows(df: DataFrame, fraction: float, key: str = KEY, seed: int = 0) -> DataFrame:
    """A repeatable sample by key; 1.0 keeps every row."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    if fraction == 1.0:
        return df
    steps = 1_000_000
    draw = hash_draw(F.col(f"`{key}`"), seed=seed, steps=steps)
    return df.where(draw < int(fraction * steps))
