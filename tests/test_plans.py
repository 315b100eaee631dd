"""What the plans promise about scans, shuffles and joins."""

import re

import pytest

from evenkeel.plans import catalog
from evenkeel.operators import drift, fairness, tradeoff


def executed(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_category_counts_are_scanned_and_shuffled_once(spark, small):
    df = drift.category_statistics(catalog.lineitem_slices(spark, small), ["l_returnflag", "l_linestatus"])
    plan = executed(df)
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan
    assert re.search(r"PushedFilters: \[Or\(And\(GreaterThan\(l_shipdate", plan)
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan


def test_numeric_counts_are_shuffled_once(spark, small):
    """One scan for the counts; the cut points come from an earlier job."""
    df = drift.numeric_statistics(catalog.lineitem_slices(spark, small), ["l_quantity", "l_tax"])
    plan = executed(df)
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") >= 1


def test_confusion_counts_aggregate_before_the_shuffle(spark, small):
    df = fairness.confusion_by_group(catalog.labelled_documents(spark, small), {"lang": ("en",)})
    plan = executed(df)
    assert "partial_count" in plan
    assert "text:string" not in plan


def test_tradeoff_enumerates_no_pairs(spark, small):
    plan = executed(tradeoff.tradeoff(catalog.clean_credit(spark, small)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Join" not in plan.replace("Join [c_custkey", "")


def test_history_is_limited_before_the_shuffle(spark, small):
    plan = executed(catalog.payment_features(spark, small))
    assert re.search(r"WindowGroupLimit \[o_custkey.*Partial", plan)


def test_bucketed_tables_meet_without_a_shuffle(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.stored_training_set(spark, small)
        plan = executed(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert df.count() == catalog.credit_view(spark, small).count()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_query_joins_without_keys(spark, small, name):
    """Only built, not run: storage queries write when they are built."""
    df = catalog.QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan
