"""Payment features, keyed feature tables and the training set built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.config import KEY, LABEL, PAY_COLUMNS, FeatureLookup
from evenkeel.functions.expressions import payment_met, payment_unmet, row_sum, select_matching
from evenkeel.operators.joins import hot_keys, look_up_by_key

AMOUNT_FRAGMENTS = ("BILL_AMT", "PAY_AMT")
BASE_COLUMNS = (KEY, "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", LABEL)


def num_paym_unmet(df: DataFrame) -> DataFrame:
    """How many of the six payments of a client were late."""
    total = row_sum([payment_unmet(F.col(c)) for c in PAY_COLUMNS])
    return df.select(KEY, total.alias("NUM_PAYM_UNMET"))


def num_paym_met(df: DataFrame) -> DataFrame:
    """How many of the six payments of a client were on time."""
    total = row_sum([payment_met(F.col(c)) for c in PAY_COLUMNS])
    return df.select(KEY, total.alias("NUM_PAYM_MET"))


def payment_features(df: DataFrame) -> DataFrame:
    """Both payment features in one projection."""
    return df.select(
        KEY,
        row_sum([payment_unmet(F.col(c)) for c in PAY_COLUMNS]).alias("NUM_PAYM_UNMET"),
        row_sum([payment_met(F.col(c)) for c in PAY_COLUMNS]).alias("NUM_PAYM_MET"),
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their row count."""
    keys = list(keys)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(f"`{key}`").isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing)


def create_feature_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str] = (KEY,),
    description: str = "",
    buckets: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Store a feature table after checking its key.

    ``buckets`` stores it hashed and sorted by the key, so that lookups against
    a base table bucketed alike need no shuffle.
    """
    bad = key_violations(df, keys).take(1)
    if bad:
        raise ValueError(f"{name}: key {list(keys)} is null or repeated, e.g. {bad[0].asDict()}")
    writer = df.write.format(fmt).mode("errorifexists")
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    text = description.replace("\\", "\\\\").replace("'", "\\'")
    listed = ",".join(keys)
    spark.sql(
        f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = '{text}', 'primary_keys' = '{listed}')"
    )


def _lookup_frame(spark: SparkSession, lookup: FeatureLookup) -> DataFrame:
    table = spark.table(lookup.table) if isinstance(lookup.table, str) else lookup.table
    return table.select(*lookup.lookup_key, *lookup.feature_names)


def look_up(
    base: DataFrame, lookups: Sequence[FeatureLookup], skewed: bool = True
) -> DataFrame:
    """Left join of every looked-up feature; a missing key leaves it null.

    Lookups by the same key share one shuffle of the base rows. ``skewed=False``
    skips the search for hot keys: right where the base table is known to hold
    each key once, as with bucketed tables.
    """
    by_key: dict[tuple[str, ...], list[DataFrame]] = {}
    for lookup in lookups:
        features = _lookup_frame(base.sparkSession, lookup)
        by_key.setdefault(tuple(lookup.lookup_key), []).append(features)
    joined = base
    for keys, frames in by_key.items():
        kinds = {tuple(f.schema[k].dataType for k in keys) for f in (joined, *frames)}
        # Keys of several columns are salted by a hash, which types must agree on.
        if skewed and (len(keys) == 1 or len(kinds) == 1):
            # Looking up by unique keys repeats no row, so the base tells what is hot.
            key = keys[0] if len(keys) == 1 else keys
            joined = look_up_by_key(joined, frames, key, hot=hot_keys(base, key))
        else:
            for features in frames:
                joined = joined.join(features, list(keys), "left")
    return joined


def create_training_set(
    base: DataFrame,
    lookups: Sequence[FeatureLookup],
    label: str = LABEL,
    exclude: Sequence[str] = (),
    skewed: bool = True,
) -> DataFrame:
    """Base columns, looked-up features and the label last, without ``exclude``."""
    joined = look_up(base, lookups, skewed)
    kept = [c for c in joined.columns if c != label and c not in set(exclude)]
    return joined.select(*kept, label)


def training_base(df: DataFrame) -> DataFrame:
    """Amount columns by name, then the other columns a model is trained on."""
    return select_matching(df, AMOUNT_FRAGMENTS, BASE_COLUMNS)
