"""Checking a deployment request against the fairness of the model behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from evenkeel.operators import fairness as fair
from evenkeel.operators import history, versions
from evenkeel.operators.joins import look_up_checked


def gate_deployments(
    events: DataFrame,
    model_versions: DataFrame,
    fairness: DataFrame,
    mode: str = "any_signed",
    column: str = "event_message",
    run_ts: Column | None = None,
) -> DataFrame:
    """Deployment-history rows for registry events given as JSON text.

    An event is judged by the newest run of its model, as a whole query: parse,
    find the run, keep that run's fairness rows, gate, combine.
    """
    parsed = history.registry_events(events, column)
    newest = versions.latest_version(model_versions)
    current = fairness.join(
        newest.select(newest["run_id"].alias("model_run_id")).distinct(),
        "model_run_id",
        "left_semi",
    )
    checked = fair.parity_gate(current, mode)
    runs = newest.select("model_name", "run_id")
    with_run = look_up_checked(parsed, runs, "model_name")
    return history.deployment_rows(with_run, checked, run_ts)
