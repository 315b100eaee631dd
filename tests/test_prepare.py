import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel import schemas
from evenkeel.config import ColumnRoles, FeatureLookup, Window
from evenkeel.functions import expressions as ex
from evenkeel.operators import features, joins, outcomes, prepare
from evenkeel.sources import tables


def credit_rows(spark, *statuses):
    names = ["USER_ID", *[f"PAY_{i}" for i in range(1, 7)]]
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(statuses)], ", ".join(["USER_ID long", *[f"{n} int" for n in names[1:]]])
    )


def test_recode(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "MARRIAGE int")
    assert [r[0] for r in prepare.clean(df).collect()] == [1, 1, 2, 1, None]


def test_payment_features(spark):
    df = credit_rows(spark, [None] * 6, [-1, 0, 1, 2, None, -2], [9] * 6)
    assert rows(features.payment_features(df)) == [(0, 0, 0), (1, 2, 3), (2, 6, 0)]
    assert rows(features.num_paym_unmet(df)) == [(0, 0), (1, 2), (2, 6)]
    assert rows(features.num_paym_met(df)) == [(0, 0), (1, 3), (2, 0)]


def test_window_bounds_are_excluded(spark):
    days = [dt.date(2022, 1, 1), dt.date(2022, 1, 2), dt.date(2022, 6, 29), dt.date(2022, 6, 30)]
    df = spark.createDataFrame([(d,) for d in days], "monitoring_date date")
    kept = prepare.within(df, Window("2022-01-01", "2022-06-30"))
    assert [r[0] for r in kept.collect()] == days[1:3]


def test_overlapping_windows_count_twice(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, d),) for d in range(1, 11)], "monitoring_date date")
    tagged = prepare.tag_windows(df, Window("2022-01-01", "2022-01-06"), Window("2022-01-04", "2022-01-09"))
    assert tagged.where("in_ref").count() == 4
    assert tagged.where("in_prod").count() == 4
    assert tagged.where("in_ref AND in_prod").count() == 1


def test_guard_and_stamp(spark):
    df = spark.range(2)
    with pytest.raises(ValueError):
        prepare.guard_column(df, "id")
    stamped = prepare.stamp(df, "p", "m", "2022-12-17")
    assert stamped.columns == ["id", "monitoring_date", "project_name", "model_name"]
    assert stamped.first()["monitoring_date"] == dt.date(2022, 12, 17)


def test_sampling_repeats_and_is_monotone(spark):
    df = spark.range(5000).withColumnRenamed("id", "USER_ID")
    one = {r[0] for r in prepare.sample_rows(df, 0.2).collect()}
    again = {r[0] for r in prepare.sample_rows(df.repartition(7), 0.2).collect()}
    more = {r[0] for r in prepare.sample_rows(df, 0.5).collect()}
    assert one == again and one < more
    assert 800 < len(one) < 1200
    assert prepare.sample_rows(df, 1.0).count() == 5000
    with pytest.raises(ValueError):
        prepare.sample_rows(df, 1.5)


def test_names_of_groups(spark):
    df = spark.createDataFrame([("SEX", 1), ("SEX", 2), ("MARRIAGE", 1), ("MARRIAGE", 2)], "v string, g int")
    named = df.select(ex.protected_name(F.col("v"), F.col("g")))
    assert [r[0] for r in named.collect()] == ["MALE", "FEMALE", "MARRIED", "SINGLE"]


def test_roles_reject_overlap():
    with pytest.raises(ValueError):
        ColumnRoles(numerical=("a",), categorical=("a",))


def test_schema_comparison(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string").schema
    new = spark.createDataFrame([(1.0, 2)], "a double, c int").schema
    assert schemas.compare(old, new) == {"added": ["c"], "missing": ["b"], "retyped": ["a"]}


def test_hot_keys_and_balanced_join(spark):
    """A key with 40 % of the rows, identical rows and null keys among them."""
    left = spark.range(2000).select(
        F.when(F.col("id") < 800, 7).when(F.col("id") < 900, None).otherwise(F.col("id")).alias("k"),
        F.lit("same").alias("x"),
    ).repartition(5)
    right = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    twice = right.unionByName(right.where("k = 7").withColumn("v", F.lit(-1).cast("long")))
    assert joins.hot_keys(left, "k") == [7]
    renamed = right.withColumnRenamed("v", "w")
    looked = joins.look_up_by_key(left, [right, renamed], "k", salts=3)
    assert rows(looked) == rows(left.join(right, "k", "left").join(renamed, "k", "left"))
    assert rows(joins.balanced_join(left, twice, "k", salts=4)) == rows(left.join(twice, "k"))
    assert rows(joins.balanced_join(right, left, "k", salts=4)) == rows(right.join(left, "k"))


def test_balanced_join_with_keys_hot_on_both_sides(spark):
    left = spark.range(90).select((F.col("id") % 3).alias("k"), F.col("id").alias("l")).repartition(4)
    right = spark.range(60).select((F.col("id") % 4).alias("k"), F.col("id").alias("r")).repartition(3)
    assert rows(joins.balanced_join(left, right, "k", salts=3)) == rows(left.join(right, "k"))


def test_hot_rows_are_spread(spark):
    """The hot key's rows do not meet in one partition of the join."""
    left = spark.range(0, 4000, 1, 8).select(F.lit(7).alias("k"), "id")
    right = spark.createDataFrame([(7, 1)], "k int, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.look_up_by_key(left, [right], "k")
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in parts) == 4000
        assert len(parts) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_joins_of_empty_frames(spark):
    left = spark.createDataFrame([], "k long, l int")
    right = spark.createDataFrame([(1, 2)], "k long, r int")
    assert joins.hot_keys(left, "k") == []
    assert joins.balanced_join(left, right, "k").collect() == []
    assert rows(joins.look_up_by_key(right, [left], "k")) == [(1, 2, None)]


def test_orphans(spark):
    base = spark.createDataFrame([(1,), (1,), (2,), (3,)], "USER_ID long")
    known = spark.createDataFrame([(2,), (4,)], "USER_ID long")
    assert rows(joins.orphans(base, known, ["USER_ID"])) == [(1,), (3,)]


def test_key_violations_and_feature_table(spark):
    good = spark.createDataFrame([(1, 5), (2, 6)], "USER_ID long, f int")
    bad = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "USER_ID long, f int")
    assert rows(features.key_violations(bad, ["USER_ID"])) == [(1, 2), (None, 1)]
    tables.recreate_database(spark, "test_features", spark.conf.get("spark.checkpoint.dir") + "/test_features")
    with pytest.raises(ValueError):
        features.create_feature_table(spark, "test_features.bad", bad)
    features.create_feature_table(spark, "test_features.good", good, description="it's fine", buckets=2)
    assert rows(spark.table("test_features.good")) == [(1, 5), (2, 6)]
    from evenkeel.config import FeatureLookup

    base = spark.createDataFrame([(1, "a"), (3, "b")], "USER_ID long, x string")
    looked = features.look_up(base, [FeatureLookup("test_features.good", ("f",))])
    assert rows(looked, "USER_ID", "x", "f") == [(1, "a", 5), (3, "b", None)]
    tables.drop_table(spark, "test_features.good")
    assert not spark.catalog.tableExists("test_features.good")


def test_outcome_rates_count_clients_once(spark):
    data = [(1, 1, 1, 0, 1), (1, 1, 1, 0, 1), (2, 1, 2, 1, 1), (3, 2, 1, 1, 0), (4, None, 1, None, 0)]
    df = spark.createDataFrame(data, "USER_ID long, SEX int, MARRIAGE int, default int, prediction int")
    got = {
        (r.protected_var, r.group_value, r.outcome, r.outcome_value): (r.n_users, r.pct_total)
        for r in outcomes.outcome_rates(df).collect()
    }
    assert got[("SEX", "1", "default", 0)] == (1, 50.0)
    assert got[("SEX", "1", "prediction", 1)] == (2, 100.0)
    assert got[("MARRIAGE", "1", "default", 1)] == (1, 50.0)
    assert got[("MARRIAGE", "1", "prediction", 0)] == (2, pytest.approx(200 / 3))
    assert all(key[1] is not None and key[3] is not None for key in got)


def test_outcome_rates_against_plain_counts(spark):
    """Clients with several differing rows, missing values and text groups."""
    import random

    rng = random.Random(8)

    def maybe(*values):
        return rng.choice([*values, None])

    data = [
        (rng.choice([None, 7, *range(80)]), maybe(1, 2), maybe(1, 2, 3), maybe(0, 1), maybe(0, 1))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "USER_ID long, SEX int, MARRIAGE int, default int, prediction int")
    expected = {}
    for user, sex, marriage, default, prediction in data:
        for var, group in (("SEX", sex), ("MARRIAGE", marriage)):
            for outcome, value in (("default", default), ("prediction", prediction)):
                if None not in (user, group, value):
                    expected.setdefault((var, str(group), outcome, value), set()).add(user)
    expected = {k: len(v) for k, v in expected.items()}
    for frame in (df, df.withColumn("MARRIAGE", F.col("MARRIAGE").cast("string"))):
        got = {
            (r.protected_var, r.group_value, r.outcome, r.outcome_value): r.n_users
            for r in outcomes.outcome_rates(frame).collect()
        }
        assert got == expected


def test_storage_round_trips(spark, tmp_path):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([(3, "x")], "a int, c string")
    tables.append(one, f"{tmp_path}/t")
    tables.append(two, f"{tmp_path}/t")
    merged = tables.read(spark, f"{tmp_path}/t", merge_schema=True)
    assert rows(merged, "a", "b", "c") == [(1, 2, None), (3, None, "x")]
    tables.overwrite(two, f"{tmp_path}/t")
    assert tables.read(spark, f"{tmp_path}/t").columns == ["a", "c"]
    tables.overwrite(one, f"{tmp_path}/u")
    tagged = tables.read_lineage(spark, f"{tmp_path}/t, {tmp_path}/u")
    assert rows(tagged, "a", "b", "c") == [(1, 2, None), (3, None, "x")]
    assert tables.read_lineage(spark, f"{tmp_path}/u").columns == ["a", "b"]
    with pytest.raises(ValueError):
        tables.read_lineage(spark, " , ")


def test_snapshots(spark, tmp_path):
    path = f"{tmp_path}/snap"
    tables.write_snapshot(spark.createDataFrame([(1,)], "a int"), path, 1)
    tables.write_snapshot(spark.createDataFrame([(2,), (3,)], "a int"), path, 2)
    tables.write_snapshot(spark.createDataFrame([(4,)], "a int"), path, 2)
    assert tables.latest_snapshot(tables.read(spark, path)).first()[0] == 2
    assert rows(tables.read_snapshot(spark, path), "a") == [(4,)]
    assert rows(tables.read_snapshot(spark, path, 1), "a") == [(1,)]


def test_json_document_file(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"SEX": {\n "equal_opportunity": [0.25, null],\n "x": [1.0]}}')
    document = tables.read_json_document(spark, str(tmp_path / "m.json"), schemas.FAIR_METRICS_DOCUMENT)
    assert document.first()["document"]["SEX"]["equal_opportunity"] == [0.25, None]


def test_csv_header_is_checked(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    schema = spark.createDataFrame([(1, 2)], "a int, b int").schema
    assert rows(tables.read_csv(spark, str(tmp_path / "c.csv"), schema)) == [(1, 2)]
    wrong = spark.createDataFrame([(1, 2)], "a int, z int").schema
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "c.csv"), wrong).collect()


def test_hot_keys_of_several_columns(spark):
    base = [(1, "a", i) for i in range(400)] + [(i, "b", i) for i in range(50)] + [(None, "a", 1), (1, None, 2)]
    known = [(1, "a", 10), (2, "b", 20), (1, "b", 30), (None, "a", 40)]
    left = spark.createDataFrame(base, "x int, y string, n int").repartition(4)
    right = spark.createDataFrame(known, "x int, y string, v int")
    assert len(joins.hot_keys(left, ("x", "y"))) >= 1
    got = features.look_up(left, [FeatureLookup(right, ("v",), ("x", "y"))])
    values = {(x, y): v for x, y, v in known if x is not None}
    assert rows(got, "x", "y", "n", "v") == sorted(((x, y, n, values.get((x, y))) for x, y, n in base), key=repr)
    # Keys of other types are joined too, but not salted.
    wide = right.withColumn("x", F.col("x").cast("long"))
    assert features.look_up(left, [FeatureLookup(wide, ("v",), ("x", "y"))]).where("v = 10").count() == 400
    with pytest.raises(ValueError, match="types"):
        joins.look_up_by_key(left, [wide], ("x", "y"))


@pytest.mark.parametrize("most", [1, 100])
def test_small_tables_are_broadcast(spark, most):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, t string")
    right = spark.createDataFrame([(1, 10), (3, 30)], "k int, v int")
    got = joins.look_up_checked(left, right, "k", most)
    assert rows(got, "k", "t", "v") == [(1, "a", 10), (2, "b", None), (None, "c", None)]
