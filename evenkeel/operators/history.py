"""Run artifacts and deployment history as tables and JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenkeel import schemas
from evenkeel.config import FAIRNESS_METRICS
from evenkeel.functions.expressions import keep_map_keys
from evenkeel.operators.joins import look_up_checked
from evenkeel.sources.tables import parse_json, replace_partitions


def registry_events(events: DataFrame, column: str = "event_message") -> DataFrame:
    """The fields kept of registry events given as JSON text."""
    return parse_json(events, column, schemas.REGISTRY_EVENT)


def metric_documents(fairness: DataFrame, run: str = "model_run_id") -> DataFrame:
    """One JSON document per run: protected variable -> metric -> [value].

    The groups are small by nature: as many entries as variables and metrics.
    """
    # A run saved twice has each value twice; the document holds it once.
    once = fairness.groupBy(run, "protected_var", "metric").agg(F.max("parity").alias("parity"))
    per_variable = once.groupBy(run, "protected_var").agg(
        F.array_sort(F.collect_list(F.struct("metric", F.array("parity")))).alias("metrics")
    )
    per_run = per_variable.groupBy(run).agg(
        F.array_sort(F.collect_list(F.struct("protected_var", "metrics"))).alias("variables")
    )
    document = F.map_from_entries(
        F.transform(
            "variables",
            lambda v: F.struct(v["protected_var"], F.map_from_entries(v["metrics"])),
        )
    )
    return per_run.select(run, F.to_json(document).alias("fair_metrics"))


def read_metric_documents(
    documents: DataFrame,
    metrics: Sequence[str] = FAIRNESS_METRICS,
    column: str = "fair_metrics",
    run: str = "model_run_id",
) -> DataFrame:
    """Metric documents as the long fairness table; other metrics are ignored."""
    parsed = documents.select(
        run, F.from_json(column, schemas.FAIR_METRICS_DOCUMENT).alias("document")
    )
    variables = parsed.select(run, F.explode("document").alias("protected_var", "values"))
    wanted = variables.select(
        run, "protected_var", F.explode(keep_map_keys(F.col("values"), metrics)).alias("metric", "v")
    )
    return wanted.select(run, "protected_var", "metric", F.get("v", F.lit(0)).alias("parity"))


def lookup_metric(document: Column, variable: str, metric: str) -> Column:
    """One value of a parsed metric document; null where it is absent."""
    values = F.try_element_at(F.try_element_at(document, F.lit(variable)), F.lit(metric))
    return F.get(values, F.lit(0))


def save_run(
    root: str,
    run_id: str,
    source_data: str,
    fairness: DataFrame,
    performance: DataFrame,
    tradeoff: DataFrame,
    conclusion: DataFrame,
) -> None:
    """Store the results of a run in the result tables below ``root``.

    The tables are partitioned by run; saving a run again replaces its rows.
    """
    spark = fairness.sparkSession
    run = spark.createDataFrame([(run_id, source_data)], schemas.RUNS)

    def keep(df: DataFrame, name: str, schema: StructType, key: str = "run_id") -> None:
        rows = schemas.conform(df.withColumn(key, F.lit(run_id)), schema)
        replace_partitions(rows, f"{root}/{name}", [key])

    keep(run, "runs", schemas.RUNS)
    keep(fairness, "fairness", schemas.FAIRNESS, "model_run_id")
    keep(performance, "perf", schemas.PERFORMANCE)
    keep(tradeoff, "tradeoff", schemas.TRADEOFF)
    keep(conclusion, "conclusion", schemas.CONCLUSION)


def deployment_rows(events: DataFrame, gate: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Registry events with the gate's result per protected variable.

    ``events`` has the event fields and ``run_id``; an event whose run has no
    gate result is kept with nulls.
    """
    when = F.current_timestamp() if run_ts is None else run_ts
    checks = gate.select(F.col("model_run_id").alias("run_id"), "protected_var", "parity_check")
    # One row per run, so that an event meets its run once, and one row per
    # protected variable again afterwards.
    per_run = checks.groupBy("run_id").agg(
        F.collect_set(F.struct("protected_var", "parity_check")).alias("checks")
    )
    joined = look_up_checked(events, per_run, "run_id").select(
        *events.columns, F.inline_outer("checks")
    )
    joined = joined.withColumn("run_ts", when)
    return schemas.conform(joined, schemas.DEPLOYMENT_HISTORY)
