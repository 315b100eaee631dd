"""Monitoring table, model, versions, history, gate, stream."""

import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel import schemas
from evenkeel.config import CREDIT_ROLES, PRODUCTION_WINDOW, REFERENCE_WINDOW, Window
from evenkeel.operators import fairness as fair
from evenkeel.operators import history, model, versions
from evenkeel.plans import training
from evenkeel.plans.catalog import clean_credit, rule_scorer
from evenkeel.plans.gate import gate_deployments
from evenkeel.plans.monitor import Monitor
from evenkeel.session import scratch_path
from evenkeel.sources import tables
from evenkeel.sources.credit import credit_view
from evenkeel.streaming.append import stream_new_data

COLUMNS = [*schemas.CREDIT.fieldNames(), "score"]


@pytest.fixture(scope="module")
def records(spark, small):
    """The credit table, stored once so that the tests here stay quick."""
    path = scratch_path(spark, "records")
    tables.overwrite(credit_view(spark, small).select(*COLUMNS), path)
    return tables.read(spark, path)


def new_monitor(spark, scorer=rule_scorer):
    return Monitor(spark, scratch_path(spark, "monitor"), "p", "m", scorer)


def test_baseline_and_batches(spark, records):
    monitor = new_monitor(spark)
    path = monitor.register_baseline(records, as_of="2022-03-01")
    assert monitor.read().where("MARRIAGE IN (0, 3)").count() == 0
    assert monitor.add_new_data(records.limit(40), as_of="2022-12-17", load_id="b1") == 40
    assert monitor.add_new_data(records.limit(40), as_of="2022-12-17", load_id="b1") == 40
    assert monitor.read().count() == records.count() + 40
    monitor.add_new_data(records.limit(5).withColumn("extra", F.lit("x")), as_of="2022-12-18")
    again = Monitor(spark, path.rsplit("/", 2)[0], "p", "m", rule_scorer)
    assert again.read().where("extra = 'x'").count() == 5
    assert again.read().where("extra IS NULL").count() == records.count() + 40
    ref, prod = again.slices(REFERENCE_WINDOW, PRODUCTION_WINDOW)
    assert (ref.count(), prod.count()) == (records.count(), 45)
    tagged = again.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW)
    assert tagged.where("in_prod").count() == 45
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan.replace("isnotnull(monitoring_date#", "((")
    with pytest.raises(ValueError, match="no rows"):
        again.slices(Window("2020-01-01", "2020-02-01"), PRODUCTION_WINDOW)


def test_a_load_may_be_repeated(spark, records):
    """For another date or without rows, too; other loads stay."""
    monitor = new_monitor(spark)
    monitor.register_baseline(records.limit(10), as_of="2022-03-01")
    monitor.add_new_data(records.limit(7), as_of="2022-12-17", load_id="other")
    assert monitor.add_new_data(records.limit(30), as_of="2022-12-17", load_id="a/b=1") == 30
    assert monitor.add_new_data(records.limit(20), as_of="2022-12-18", load_id="a/b=1") == 20
    assert monitor.read().count() == 37
    assert monitor.add_new_data(records.limit(0), as_of="2022-12-18", load_id="a/b=1") == 0
    assert monitor.read().count() == 17


def test_types_of_a_batch_follow_the_table(spark, records):
    monitor = new_monitor(spark)
    monitor.register_baseline(records, as_of="2022-03-01")
    odd = records.limit(3).withColumn("PAY_AMT1", F.lit(7)).withColumn("SEX", F.lit("2"))
    monitor.add_new_data(odd, as_of="2022-12-17")
    kinds = dict(monitor.read().dtypes)
    assert (kinds["PAY_AMT1"], kinds["SEX"]) == ("double", "int")
    changes = monitor.schema_changes(odd)
    assert changes["retyped"] == ["SEX", "PAY_AMT1"]


def test_separate_labels_are_joined(spark, records):
    monitor = new_monitor(spark)
    labels = records.where("USER_ID < 50").select("USER_ID", "default")
    monitor.register_baseline(records.drop("default"), labels=labels, as_of="2022-03-01")
    assert monitor.read().count() == 50


def test_guard_and_missing_scorer(spark, records):
    with pytest.raises(ValueError):
        new_monitor(spark).register_baseline(records.withColumn("monitoring_date", F.current_date()))
    with pytest.raises(ValueError):
        new_monitor(spark, None).register_baseline(records)


def test_saved_reports_append(spark, records):
    monitor = new_monitor(spark)
    monitor.register_baseline(records, as_of="2022-03-01")
    monitor.add_new_data(records.where("USER_ID % 2 = 0"), as_of="2022-12-17")
    tagged = monitor.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW)
    for _ in range(2):
        drift_path = monitor.save_dataset_drift(tagged, CREDIT_ROLES, "2022-12-17")
    assert tables.read(spark, drift_path).count() == 10
    label = tables.read(spark, monitor.save_label_drift(tagged, CREDIT_ROLES, "2022-12-17"))
    assert [r[0] for r in label.select("target_name").orderBy("target_name").collect()] == ["default", "prediction"]
    drifted = {r["feature"] for r in tables.read(spark, drift_path).where("drift_detected").collect()}
    assert "SEX" in drifted and "LIMIT_BAL" not in drifted
    profile = tables.read(spark, monitor.save_quality(tagged, CREDIT_ROLES, "2022-12-17"))
    assert profile.count() == 14
    tables.recreate_database(spark, "test_reports", scratch_path(spark, "reports"))
    monitor.save_quality_table(tagged, CREDIT_ROLES, "test_reports.quality", "2022-12-17")
    assert spark.table("test_reports.quality").count() == 14


def test_streamed_append_is_repeatable(spark, records):
    monitor = new_monitor(spark)
    monitor.register_baseline(records, as_of="2022-03-01")
    source = scratch_path(spark, "incoming")
    records.where("USER_ID < 30").repartition(3).write.parquet(source)
    schema = records.schema

    def run(checkpoint):
        stream_new_data(
            monitor, source, schema, "2022-12-17", checkpoint, max_files=1
        ).awaitTermination()
        return monitor.read().where("monitoring_date = DATE '2022-12-17'").count()

    checkpoint = scratch_path(spark, "checkpoint")
    assert run(checkpoint) == 30
    assert run(checkpoint) == 30
    # A lost checkpoint replays all files; the same batches replace themselves.
    assert run(scratch_path(spark, "checkpoint")) == 30


def test_split_is_stable(spark, small):
    df = clean_credit(spark, small).select("USER_ID")
    one = rows(model.split(df))
    assert one == rows(model.split(df.repartition(9)))
    share = sum(r[1] == "test" for r in one) / len(one)
    assert 0.15 < share < 0.35


def test_regression_solves_the_intended_problem(spark):
    """The gradient of C * sum(loss) + |w|^2 / 2 over population-scaled columns vanishes."""
    rng = random.Random(4)
    data = []
    for _ in range(300):
        a, b = rng.gauss(3, 2), rng.gauss(-1, 5)
        data.append((a, b, int(rng.random() < 1 / (1 + np.exp(-(a - 3 + 0.3 * b))))))
    df = spark.createDataFrame(data, "a double, b double, default int")
    fitted = model.train(df, ["a", "b"])
    x = np.array([d[:2] for d in data])
    y = np.array([d[2] for d in data])
    n = len(data)
    scaled = (x - x.mean(0)) / x.std(0)
    w = fitted.stages[2].coefficients.toArray() * x.std(0) / x.std(0, ddof=1)
    margin = scaled @ w + fitted.stages[2].intercept
    gradient = 0.1 * scaled.T @ (1 / (1 + np.exp(-margin)) - y) + w
    assert np.abs(gradient).max() < 1e-3
    assert model.regularization(n) == pytest.approx(1 / (0.1 * n) * (n - 1) / n)


def test_scoring_keeps_rows_and_label(spark, tmp_path):
    rng = random.Random(7)
    data = [(i, float(i % 10), None if i % 7 == 0 else rng.random(), int(i % 10 > 4)) for i in range(200)]
    df = spark.createDataFrame(data, "USER_ID long, a double, b double, default int")
    fitted = model.train(df, ["a", "b"])
    assert model.feature_names(fitted) == ["a", "b"]
    scored = model.score(fitted, df)
    assert scored.columns == ["USER_ID", "a", "b", "default", "prediction", "probability", "confidence"]
    assert scored.where("b IS NULL").count() == 29
    assert scored.where("confidence < 0.5 OR probability > 1").count() == 0
    assert scored.where("prediction <> default").count() == 0
    model.save(fitted, f"{tmp_path}/model")
    loaded = model.load(f"{tmp_path}/model")
    assert rows(model.score(loaded, df.drop("default")), "USER_ID", "prediction") == rows(scored, "USER_ID", "prediction")
    with pytest.raises(ValueError):
        model.train(df.where("false"), ["a", "b"])


def test_train_and_audit(spark, small, tmp_path):
    audit = training.train_and_audit(clean_credit(spark, small), "run_9")
    assert audit.fairness.count() == 6
    accuracy = {r["metric"]: r["value"] for r in audit.performance.collect()}
    assert accuracy["balanced_accuracy"] > 0.6
    audit.save(str(tmp_path), "run_9", "silver")
    for name, n in (("runs", 1), ("fairness", 6), ("perf", 6), ("tradeoff", 6), ("conclusion", 2)):
        assert tables.read(spark, f"{tmp_path}/{name}").count() == n, name
    stored = tables.read(spark, f"{tmp_path}/fairness")
    assert rows(fair.of_run(stored, "run_9").select("metric").distinct()) == [
        ("demographic_parity",), ("equal_odds",), ("equal_opportunity",)
    ]


VERSIONS = "model_name string, version int, stage string, run_id string"


def test_version_choices(spark):
    data = [
        ("one", 1, "None", "r1"),
        ("many", 1, "Staging", "r2"), ("many", 2, "Staging", "r3"), ("many", 3, "Production", "r4"),
        ("none", 1, "Archived", "r5"), ("none", 2, "Production", "r6"),
    ]
    df = spark.createDataFrame(data, VERSIONS)
    assert rows(versions.version_for_stage(df), "model_name", "version") == [("many", 2), ("one", 1)]
    ranked = rows(versions.latest_and_previous(df).where("model_name = 'many'"), "version", "version_rank")
    assert ranked == [(2, 2), (3, 1)]
    runs = spark.createDataFrame([("r3", "path")], "run_id string, source_data string")
    assert rows(versions.run_of_model(df, runs), "model_name", "source_data") == [("many", "path")]


def test_gate_and_history(spark, tmp_path):
    events = spark.createDataFrame(
        [('{"model_name": "m", "version": "2", "text": "please", "webhook_id": "w", "other": 1}',), ("not json",)],
        "event_message string",
    )
    model_versions = spark.createDataFrame([("m", 1, "None", "old"), ("m", 2, "None", "new")], VERSIONS)
    fairness = spark.createDataFrame(
        [("new", "SEX", "a", 0.5), ("new", "SEX", "b", 0.2), ("old", "SEX", "a", 0.0)], schemas.FAIRNESS
    )
    when = F.lit(dt.datetime(2022, 12, 17))
    got = gate_deployments(events, model_versions, fairness, run_ts=when)
    declared = schemas.DEPLOYMENT_HISTORY
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in declared]
    assert rows(got, "model_name", "version", "protected_var", "parity_check") == [
        ("m", "2", "SEX", 0), (None, None, None, None)
    ]
    tables.append(got, f"{tmp_path}/history")
    tables.append(got.withColumn("note", F.lit("x")), f"{tmp_path}/history")
    assert tables.read(spark, f"{tmp_path}/history", merge_schema=True).where("note IS NULL").count() == 2


def test_metric_documents(spark):
    fairness = spark.createDataFrame(
        [("r", "SEX", "equal_odds", 0.5), ("r", "SEX", "other", 1.0), ("r", "MARRIAGE", "equal_odds", -0.25)],
        schemas.FAIRNESS,
    )
    documents = history.metric_documents(fairness)
    assert documents.first()["fair_metrics"] == (
        '{"MARRIAGE":{"equal_odds":[-0.25]},"SEX":{"equal_odds":[0.5],"other":[1.0]}}'
    )
    back = history.read_metric_documents(documents, ["equal_odds"])
    assert rows(back) == [("r", "MARRIAGE", "equal_odds", -0.25), ("r", "SEX", "equal_odds", 0.5)]
    parsed = F.from_json("fair_metrics", schemas.FAIR_METRICS_DOCUMENT)
    picked = documents.select(
        history.lookup_metric(parsed, "SEX", "other"), history.lookup_metric(parsed, "AGE", "other")
    )
    assert tuple(picked.first()) == (1.0, None)
