"""Features as of a date, published versions, and the stream of deployment events."""

import datetime as dt
import json

import pytest
from conftest import rows

from evenkeel import schemas
from evenkeel.operators.joins import look_up_as_of
from evenkeel.sources import tables
from evenkeel.streaming.deployments import read_history, stream_history, stream_quarantine

DAY = dt.date(2022, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


@pytest.mark.parametrize("hot", [[], [1]])
def test_newest_feature_not_after_the_date(spark, hot):
    base = [(1, 5, "a"), (1, 9, "b"), (1, 0, "c"), (2, 5, "d"), (None, 5, "e"), (1, None, "f"), (1, 5, "a"), (4, 9, "g")]
    known = [(1, 1, 10), (1, 5, 20), (1, 5, 30), (1, 8, None), (2, 6, 40), (None, 1, 50), (1, None, 60), (3, 1, 70), (4, 2, 80)]
    records = spark.createDataFrame([(k, day(d), t) for k, d, t in base], "k int, seen date, tag string").repartition(3)
    features = spark.createDataFrame([(k, day(d), v) for k, d, v in known], "k int, at date, v int").repartition(2)
    got = look_up_as_of(records, features, ["v"], "k", "seen", "at", hot=hot)
    expected = []
    for k, d, tag in base:
        before = [(at, v is not None, v) for key, at, v in known if None not in (k, d, at) and key == k and at <= d]
        at, _, v = max(before) if before else (None, None, None)
        expected.append((k, day(d), tag, day(at), v))
    assert rows(got) == sorted(expected, key=repr)
    assert got.columns == ["k", "seen", "tag", "at", "v"]
    assert look_up_as_of(records, features.limit(0), ["v"], "k", "seen", "at").where("at is null").count() == len(base)


def test_as_of_makes_no_pairs(spark, small):
    from evenkeel.plans import catalog

    plan = catalog.features_as_of(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and plan.count("Window ") == 1


def test_versions_are_read_by_their_marker(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no published version"):
        tables.read_version(spark, path)
    for version, n in ((1, 3), (2, 5), (10, 7)):
        tables.publish_version(spark.range(n), path, version)
    spark.range(100).write.parquet(f"{path}/data/000000000011-unfinished")
    newest, pinned = tables.read_version(spark, path), tables.read_version(spark, path, 2)
    assert (newest.count(), pinned.count(), tables.newest_version(spark, path)) == (7, 5, 10)
    assert {f.split("/data/")[1][:12] for f in pinned.inputFiles()} == {"000000000002"}
    with pytest.raises(ValueError, match="no published version 3"):
        tables.read_version(spark, path, 3)
    # A version may be published again; readers of the old files keep them.
    tables.publish_version(spark.range(6), path, 2)
    assert tables.read_version(spark, path, 2).count() == 6 and pinned.count() == 5


def test_schema_changes_between_versions(spark, tmp_path):
    for version, kind in enumerate(("a int, b string", "a bigint, c date", "a string, c timestamp"), 1):
        tables.publish_version(spark.createDataFrame([], kind), str(tmp_path), version)
    assert rows(tables.schema_history(spark, str(tmp_path))) == [
        (2, "a", "widened", "int", "bigint"),
        (2, "b", "missing", "string", None),
        (2, "c", "added", None, "date"),
        (3, "a", "widened", "bigint", "string"),
        (3, "c", "retyped", "date", "timestamp"),
    ]


def event(number, second=None, **changes):
    fields = {
        "event_id": f"e{number}",
        "event_ts": f"2022-12-01T00:00:{number if second is None else second:02d}Z",
        "model_name": "m",
        "version": str(number),
    }
    return json.dumps({k: v for k, v in (fields | changes).items() if v is not None})


def test_replayed_events_are_kept_once(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / name) for name in ("in", "history", "state"))

    def gate(events):
        return schemas.conform(tables.parse_json(events, "event_message", schemas.REGISTRY_EVENT), schemas.DEPLOYMENT_HISTORY)

    def send(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(source)

    def run():
        stream_history(spark, source, path, checkpoint, gate, max_files=1).awaitTermination()
        stream_quarantine(spark, source, f"{path}_bad", f"{checkpoint}_bad").awaitTermination()
        return rows(read_history(spark, path), "version")

    send(event(1), event(2), event(2, second=5), "{not json", "")
    assert run() == [("1",), ("2",)]
    send(event(1), event(3), event(4, model_name=None), event(5, event_id=None))
    send(event(3, second=40))
    # A message later than the watermark allows is dropped.
    send(event(9, event_ts="2022-11-01T00:00:00Z"))
    assert run() == [("1",), ("2",), ("3",)]
    assert run() == [("1",), ("2",), ("3",)]
    assert [r[0] for r in rows(tables.read(spark, f"{path}_bad"), "reason")] == [
        "lacks event_id",
        "lacks event_id, event_ts, model_name",
        "lacks event_id, event_ts, model_name",
        "lacks model_name",
    ]
