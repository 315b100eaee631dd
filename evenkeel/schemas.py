"""Declared schemas of the inputs and of every persisted result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.config import BILL_AMOUNT_COLUMNS, PAY_AMOUNT_COLUMNS, PAY_COLUMNS


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

CREDIT = _struct(
    ("USER_ID", _L),
    ("LIMIT_BAL", _D),
    ("SEX", _I),
    ("EDUCATION", _I),
    ("MARRIAGE", _I),
    ("AGE", _I),
    *[(c, _I) for c in PAY_COLUMNS],
    *[(c, _D) for c in BILL_AMOUNT_COLUMNS],
    *[(c, _D) for c in PAY_AMOUNT_COLUMNS],
    ("default", _I),
)

DATASET_DRIFT = _struct(
    ("feature", _S),
    ("feature_type", _S),
    ("stattest_name", _S),
    ("drift_score", _D),
    ("drift_detected", _B),
    ("date", T.DateType()),
    ("project_name", _S),
    ("model_name", _S),
)

LABEL_DRIFT = _struct(
    ("target_name", _S),
    ("target_type", _S),
    ("stattest_name", _S),
    ("drift_score", _D),
    ("drift_detected", _B),
    ("date", T.DateType()),
    ("project_name", _S),
    ("model_name", _S),
)

REGISTRY_EVENT = _struct(
    ("model_name", _S),
    ("version", _S),
    ("text", _S),
    ("webhook_id", _S),
)

DEPLOYMENT_HISTORY = _struct(
    *[(f.name, f.dataType) for f in REGISTRY_EVENT.fields],
    ("run_ts", T.TimestampType()),
    ("protected_var", _S),
    ("parity_check", _I),
)

FAIRNESS = _struct(
    ("model_run_id", _S),
    ("protected_var", _S),
    ("metric", _S),
    ("parity", _D),
)

PERFORMANCE = _struct(
    ("run_id", _S),
    ("metric", _S),
    ("value", _D),
    ("ci_low", _D),
    ("ci_high", _D),
)

TRADEOFF = _struct(
    ("run_id", _S),
    ("protected_var", _S),
    ("metrics", _S),
    ("thresh_1", _I),
    ("thresh_2", _I),
    ("balanced_accuracy", _D),
)

CONCLUSION = _struct(
    ("run_id", _S),
    ("protected_var", _S),
    ("metric", _S),
    ("value", _D),
    ("threshold", _D),
    ("conclusion", _S),
)

SCORECARD = _struct(
    ("model_name", _S),
    ("version", _L),
    ("position", _I),
    ("feature", _S),
    ("mean", _D),
    ("scale", _D),
    ("weight", _D),
)

CERTIFICATE = _struct(
    ("feature", _S),
    ("position", _I),
    ("n_rows", _L),
    ("mean", _D),
    ("scale", _D),
    ("weight", _D),
    ("gradient", _D),
    ("start_gradient", _D),
    ("objective", _D),
)

# The version is the marker's partition.
MANIFEST = _struct(("version", _L), ("folder", _S), ("schema", _S))

DEPLOYMENT_EVENT = _struct(
    ("event_id", _S),
    ("event_ts", T.TimestampType()),
    *[(f.name, f.dataType) for f in REGISTRY_EVENT.fields],
)

RUNS = _struct(("run_id", _S), ("source_data", _S))

FAIR_METRICS_DOCUMENT = T.MapType(_S, T.MapType(_S, T.ArrayType(_D)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; columns the frame lacks become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def compare(expected: T.StructType, actual: T.StructType) -> dict[str, list[str]]:
    """Columns added to, missing from, or retyped in ``actual``."""
    old = {f.name: f.dataType for f in expected.fields}
    new = {f.name: f.dataType for f in actual.fields}
    return {
        "added": [c for c in new if c not in old],
        "missing": [c for c in old if c not in new],
        "retyped": [c for c in old if c in new and old[c] != new[c]],
    }
