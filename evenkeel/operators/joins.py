"""Key joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A key with at least one row in HOT_SHARE is hot. The sketch may take a key of
# slightly less for hot, never more than HOT_LIMIT keys whatever the data's size.
HOT_SHARE = 100
HOT_LIMIT = 128
SALTS = 256
LANES = 512
# A looked-up table of at most so many rows is broadcast.
SMALL_ROWS = 100_000
_TRACKED = 4096


def task_number(modulo: int) -> Column:
    """The number of the running task, modulo ``modulo``.

    Unlike a random number it is the same when a lost task runs again, and
    unlike a hash it differs between identical rows of different tasks.
    """
    return F.pmod(F.spark_partition_id(), F.lit(modulo))


def _code(keys: str | Sequence[str]) -> Column:
    """What stands for a key in sketches: the column, or a hash of several; null if one is null."""
    if isinstance(keys, str):
        return F.col(f"`{keys}`")
    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    return F.when(whole, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))


def hot_keys(df: DataFrame, key: str | Sequence[str]) -> list:
    """Keys holding about 1 % of the rows or more: at most 128 values, hashes for several columns.

    One pass with a frequent-items sketch over the key column, whose error is
    below 0.1 % of the rows. The sketches of the tasks are combined in lanes
    first, so that no single task has to take in all of them. A key flagged
    wrongly costs a few copies. The values come to the driver at once: both sides
    of a join must treat the same keys as hot, so they are found only once.
    """
    lanes = (
        df.select(_code(key).alias("code"), task_number(LANES).alias("lane"))
        .groupBy("lane")
        .agg(
            F.expr(f"approx_top_k_accumulate(code, {_TRACKED})").alias("sketch"),
            F.count("code").alias("n"),
        )
    )
    # Grouped by a constant: without a grouping, a task that gets no lane would
    # have to hand on a sketch of nothing, which the function cannot write.
    found = lanes.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_combine(sketch, {_TRACKED})").alias("sketch"), F.sum("n").alias("n")
    ).select(F.expr(f"explode(approx_top_k_estimate(sketch, {HOT_LIMIT}))").alias("top"), "n")
    hot = F.col("top.item").isNotNull() & (F.col("top.count") * HOT_SHARE >= F.col("n"))
    return [row[0] for row in found.where(hot).select("top.item").collect()]


def _among(key: str | Sequence[str], hot: Sequence) -> Column:
    return F.coalesce(_code(key).isin(list(hot)), F.lit(False)) if hot else F.lit(False)


def _salted(df: DataFrame, spread: Column, salt: str, salts: int) -> DataFrame:
    """The salt of a row: its task number where ``spread`` holds, else 0."""
    return df.withColumn(salt, F.when(spread, task_number(salts)).otherwise(0))


def _repeated(df: DataFrame, spread: Column, salt: str, salts: int) -> DataFrame:
    """A row once per salt where the key is hot on the other side, else once."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.when(spread, every).otherwise(F.array(F.lit(0)))
    return df.withColumn(salt, F.explode(copies))


def look_up_by_key(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str | Sequence[str],
    salts: int = SALTS,
    hot: Sequence | None = None,
) -> DataFrame:
    """``left`` with the columns of tables that hold each key at most once.

    A key of several columns is salted by its hash; their types must agree on all sides.

    A left join. Rows of a hot key of ``left`` get a salt as a second join key,
    and the one matching row of each table is repeated per salt; rows without a
    key are spread as well. ``left`` is shuffled once however many tables follow.
    ``hot`` names the hot keys where they are known already.
    """
    columns = [key] if isinstance(key, str) else list(key)
    kinds = [left.schema[c].dataType for c in columns]
    for right in rights:
        if len(columns) > 1 and [right.schema[c].dataType for c in columns] != kinds:
            raise ValueError(f"the types of {columns} differ between the tables")
    hot = hot_keys(left, key) if hot is None else hot
    joined = _salted(left, _among(key, hot) | _code(key).isNull(), "_salt", salts)
    for right in rights:
        copies = _repeated(right, _among(key, hot), "_salt", salts)
        joined = joined.join(copies, [*columns, "_salt"], "left")
    return joined.drop("_salt")


def look_up_checked(left: DataFrame, right: DataFrame, key: str, most: int = SMALL_ROWS) -> DataFrame:
    """``look_up_by_key``, but a ``right`` of at most ``most`` rows is broadcast.

    For tables that are small by nature, such as one row per model or run. Then neither
    are hot keys searched nor is ``left`` shuffled; a larger table is joined as usual.
    """
    if right.limit(most + 1).count() <= most:
        return left.join(F.broadcast(right), key, "left")
    return look_up_by_key(left, [right], key)


def balanced_join(left: DataFrame, right: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Inner join on ``key`` where either side may have hot keys.

    Each side's hot rows are salted and the other side's matching rows are
    repeated per salt, so that every pair still meets exactly once.
    """
    in_left, in_right = (_among(key, hot_keys(df, key)) for df in (left, right))
    a = _repeated(_salted(left, in_left, "_salt_l", salts), in_right, "_salt_r", salts)
    b = _repeated(_salted(right, in_right, "_salt_r", salts), in_left, "_salt_l", salts)
    return a.join(b, [key, "_salt_l", "_salt_r"]).drop("_salt_l", "_salt_r")


def attach_label(
    scored: DataFrame, labelled: DataFrame, label: str, key: str
) -> DataFrame:
    """Inner join of scored rows to their labels; repeated keys multiply rows."""
    return balanced_join(scored, labelled.select(key, label), key)


def orphans(base: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``base`` that the feature table lacks, once each."""
    keys = list(keys)
    known = features.select(*keys).distinct()
    return base.select(*keys).distinct().join(known, keys, "left_anti")


def look_up_as_of(
    base: DataFrame,
    features: DataFrame,
    names: Sequence[str],
    key: str,
    base_date: str,
    feature_date: str,
    salts: int = SALTS,
    hot: Sequence | None = None,
) -> DataFrame:
    """``base`` with ``names`` and ``feature_date`` of its key's newest row not after ``base_date``.

    A left join: a row without key, without date or without an earlier feature row gets
    nulls. Of feature rows of one key and date the largest by ``names`` counts; those
    without key or date count for nothing. Both sides are stacked, sorted once by key
    and date, and the last feature row is carried along, so no pair of rows that does
    not belong together is ever made. Rows of a hot key are dealt out with a salt and
    its feature rows are repeated per salt.
    """
    hot = hot_keys(base, key) if hot is None else hot
    spread = _among(key, hot) | F.col(f"`{key}`").isNull()
    records = _salted(base, spread, "_salt", salts).select(
        F.col(f"`{key}`").alias("_key"),
        "_salt",
        F.col(f"`{base_date}`").cast("timestamp_ntz").alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row"),
    )
    dated = features.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{feature_date}`").isNotNull())
    found = F.struct(F.col(f"`{feature_date}`"), *[F.col(f"`{c}`") for c in names])
    known = _repeated(dated, _among(key, hot), "_salt", salts).select(
        F.col(f"`{key}`").alias("_key"),
        "_salt",
        F.col(f"`{feature_date}`").cast("timestamp_ntz").alias("_at"),
        F.lit(0).alias("_side"),
        found.alias("_found"),
    )
    order = W.partitionBy("_key", "_salt").orderBy("_at", "_side", "_found")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = F.last("_found", ignorenulls=True).over(running)
    dated_row = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    joined = records.unionByName(known, allowMissingColumns=True).withColumn("_found", F.when(dated_row, carried))
    return joined.where("_side = 1").select("_row.*", "_found.*")
