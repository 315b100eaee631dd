"""Scorecards, the registry, and reports from stored value counts."""

import math
from dataclasses import replace

import pytest
from conftest import rows

from evenkeel.config import KEY, LABEL, PRODUCTION_WINDOW, REFERENCE_WINDOW, ColumnRoles
from evenkeel.operators import distribution as dist
from evenkeel.operators import drift, model, quality, scorecard
from evenkeel.plans import catalog, training
from evenkeel.plans.monitor import Monitor
from evenkeel.plans.registry import Registry
from evenkeel.session import scratch_path
from evenkeel.sources import tables


@pytest.fixture(scope="module")
def data(spark, small):
    """The training set, stored once."""
    path = scratch_path(spark, "training")
    tables.overwrite(model.split(training.training_set(catalog.clean_credit(spark, small))), path)
    return tables.read(spark, path)


def test_scorecard_equals_the_pipeline(spark, data, tmp_path):
    inputs = [c for c in data.columns if c not in (KEY, LABEL, "split")]
    fitted = model.train(data, inputs)
    card = scorecard.from_pipeline(fitted)
    scorecard.save(spark, card, str(tmp_path), "m", 1)
    scorecard.save(spark, scorecard.Scorecard(0.0, card.entries[:1]), str(tmp_path), "m", 2)
    stored = scorecard.load(spark, str(tmp_path), "m", 1)
    assert stored == card
    columns = (KEY, "prediction", "probability", "confidence")
    ours = {r[0]: r[1:] for r in rows(scorecard.score(data, stored), *columns)}
    theirs = {r[0]: r[1:] for r in rows(model.score(fitted, data), *columns)}
    assert ours.keys() == theirs.keys()
    for client, scored in ours.items():
        assert scored[0] == theirs[client][0]
        assert scored[1:] == pytest.approx(theirs[client][1:], abs=1e-12)


def test_certificate_tells_a_wrong_fit(data):
    inputs = [c for c in data.columns if c not in (KEY, LABEL, "split")]
    card = scorecard.from_pipeline(model.train(data, inputs))
    checked = scorecard.certificate(data, card)
    assert checked.where(~scorecard.is_optimal(checked)).count() == 0
    first, *rest = card.entries
    moved = scorecard.Scorecard(card.intercept, (replace(first, weight=first.weight + 0.5), *rest))
    worse = scorecard.certificate(data, moved)
    assert worse.where(~scorecard.is_optimal(worse)).count() > 0
    assert worse.first().objective > checked.first().objective
    with pytest.raises(ValueError, match="no labelled rows"):
        scorecard.certificate(data.where("false"), card)


def test_scorecard_must_be_whole(spark):
    card = scorecard.Scorecard(0.5, (scorecard.Entry("AGE", 1.0, 0.0, 2.0),))
    table = scorecard.as_table(spark, card, "m", 1)
    with pytest.raises(ValueError, match="whole"):
        scorecard.from_rows(table.where("position = 1"))
    # A constant feature has no scale and adds nothing; a missing number counts as 0.
    scored = scorecard.score(spark.createDataFrame([(1, None)], "USER_ID int, AGE double"), card).first()
    assert scored.prediction == 1 and scored.probability == pytest.approx(1 / (1 + math.exp(-0.5)))
    with pytest.raises(ValueError, match="neither"):
        scorecard.looked_up(spark.range(1), card, [])


def test_registry_wants_one_run(spark):
    versions = spark.createDataFrame(
        [("m", 1, "Production", "a"), ("m", 2, "Staging", "b")],
        "model_name string, version long, stage string, run_id string",
    )
    runs = spark.createDataFrame([("a", "x"), ("b", "y")], "run_id string, source_data string")
    found = Registry(versions, runs, "").chosen("m", "Production")
    assert (found.version, found.run_id, found.source_data) == (1, "a", "x")
    with pytest.raises(ValueError, match="no run"):
        Registry(versions, runs, "").chosen("other")


def test_reports_from_counts_read_no_row(spark, tmp_path):
    roles = ColumnRoles(target="y", numerical=("v",), categorical=("c",))
    monitor = Monitor(spark, str(tmp_path), "p", "m", scorer=lambda df: df, roles=roles)
    kind = "v double, c string, y int"
    monitor.register_baseline(
        spark.createDataFrame([(1.0, "a", 0), (2.0, "a", 1), (None, None, 1)], kind), as_of="2022-03-01"
    )
    batch = spark.createDataFrame([(2.0, "b", 0), (float("inf"), "a", 1), (float("nan"), "a", 1)], kind)
    monitor.add_new_data(batch, as_of="2022-09-01", load_id="x")
    monitor.add_new_data(batch, as_of="2022-10-01", load_id="x")
    counts = monitor.tagged_summary(REFERENCE_WINDOW, PRODUCTION_WINDOW)
    tagged = monitor.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW)
    for report in (
        lambda t: drift.dataset_drift(t, roles, "p", "m", "2022-12-17"),
        lambda t: drift.dataset_drift(t, roles, "p", "m", "2022-12-17", "distance"),
        lambda t: drift.label_drift(t, roles, "p", "m", "2022-12-17"),
        lambda t: quality.quality_profile(t, roles),
        lambda t: drift.drift_report(t, roles),
    ):
        stored = report(counts)
        assert rows(stored) == rows(report(tagged))
        files = {f.rpartition("/")[0].split("_monitoring/")[1].split("/")[0] for f in stored.inputFiles()}
        assert files <= {"m_summary"}
    with pytest.raises(ValueError, match="no counts"):
        drift.numeric_statistics(counts, ["other"])


def test_infinite_values_on_one_side(spark):
    kind = "v double, in_ref boolean, in_prod boolean"
    finite = [(float(i), i % 2 == 0, i % 2 == 1) for i in range(20)]
    odd = [(float("inf"), True, False), (float("-inf"), True, False), (float("nan"), True, False)]
    plain, mixed = (spark.createDataFrame(r, kind) for r in (finite, finite + odd))
    assert rows(drift.numeric_statistics(mixed, ["v"])) == rows(drift.numeric_statistics(plain, ["v"]))
    assert rows(dist.histogram(mixed, ["v"])) == rows(dist.histogram(plain, ["v"]))
    profile = {r.dataset: r for r in quality.numeric_profile(mixed, ["v"]).collect()}
    assert profile["ref"].n_missing == 3 and profile["ref"].max_value == 18.0 and profile["prod"].n_missing == 0
    assert rows(dist.infinite_values(mixed, ["v"])) == [("v", "prod", 0), ("v", "ref", 2)]
