"""Every registered query: a function of a session and a folder of tables.

Values that come out of floating-point sums are rounded to six decimals, so that
the order in which tasks finish cannot show.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel import schemas
from evenkeel.config import (
    CREDIT_ROLES,
    FAIRNESS_METRICS,
    KEY,
    LABEL,
    PAY_AMOUNT_COLUMNS,
    PREDICTION,
    PRODUCTION_WINDOW,
    REFERENCE_WINDOW,
    ColumnRoles,
    FeatureLookup,
    Window,
)
from evenkeel.operators import distribution as dist
from evenkeel.operators import drift, features, history, joins, model, outcomes, prepare, quality, scorecard
from evenkeel.operators import fairness as fair
from evenkeel.operators import performance as perf
from evenkeel.operators import tradeoff as trade
from evenkeel.operators import versions
from evenkeel.plans import training
from evenkeel.plans.gate import gate_deployments
from evenkeel.plans.monitor import LOAD, Monitor
from evenkeel.plans.registry import Registry
from evenkeel.session import scratch_path
from evenkeel.sources import tables
from evenkeel.sources.credit import credit_view, labelled_documents, table
from evenkeel.streaming.append import stream_new_data
from evenkeel.streaming.deployments import read_history, stream_history, stream_quarantine

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2022-12-17"
PROJECT = "fairness"
MODEL = "credit_scoring"
RUN = "run_1"
LINEITEM_WINDOWS = (Window("1995-01-01", "1998-06-01"), Window("1998-06-01", "2001-12-31"))
ORDERS_WINDOWS = (Window("1994-12-31", "1999-01-01"), Window("1998-12-31", "2001-12-31"))
EVENTS_WINDOWS = (Window("2023-12-31", "2024-01-16"), Window("2024-01-16", "2024-02-01"))
LINEITEM_ROLES = ColumnRoles(
    numerical=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
)
ORDERS_ROLES = ColumnRoles(
    target="o_totalprice",
    numerical=("o_totalprice",),
    categorical=("o_orderpriority", "o_orderstatus"),
    target_is_numeric=True,
)
EVENTS_ROLES = ColumnRoles(numerical=("value",), categorical=("event_type",))
LANG_PROTECTED = {"lang": ("en",)}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def clean_credit(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.clean(credit_view(spark, sf))


def lineitem_slices(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.tag_windows(table(spark, sf, "lineitem"), *LINEITEM_WINDOWS, "l_shipdate")


def orders_slices(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.tag_windows(table(spark, sf, "orders"), *ORDERS_WINDOWS, "o_orderdate")


def events_slices(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.tag_windows(table(spark, sf, "events"), *EVENTS_WINDOWS, "ts")


def credit_slices(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.tag_windows(clean_credit(spark, sf), REFERENCE_WINDOW, PRODUCTION_WINDOW)


def rule_scorer(df: DataFrame) -> DataFrame:
    """A stand-in for a model: the prediction follows from the integer score."""
    return df.withColumn(PREDICTION, F.when(F.col("score") >= 40, 1).otherwise(0))


# --- preparing ---------------------------------------------------------------


@query
def recode_marriage(spark: SparkSession, sf: str) -> DataFrame:
    raw = credit_view(spark, sf).withColumn("marriage_raw", F.col("MARRIAGE"))
    return prepare.clean(raw).select(KEY, "marriage_raw", "MARRIAGE")


@query
def payment_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.payment_features(credit_view(spark, sf))


@query
def labels_only(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.label_column(credit_view(spark, sf), LABEL)


@query
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    records = clean_credit(spark, sf)
    return features.create_training_set(
        features.training_base(records), training.payment_lookups(records), exclude=(KEY,)
    )


@query
def stored_training_set(spark: SparkSession, sf: str) -> DataFrame:
    """The training set from tables stored in buckets of the client: joined without a shuffle."""
    database = "evenkeel_features"
    tables.recreate_database(spark, database, scratch_path(spark, "features"))
    source = scratch_path(spark, "clean_credit")
    tables.overwrite(clean_credit(spark, sf), source)
    records = tables.read(spark, source)
    base = features.training_base(records)
    features.create_feature_table(spark, f"{database}.base", base, buckets=8, description="Clients to train on")
    lookups = []
    for name, made in (("unmet", features.num_paym_unmet), ("met", features.num_paym_met)):
        features.create_feature_table(spark, f"{database}.{name}", made(records), buckets=8, description=f"Payments {name}")
        lookups.append(FeatureLookup(f"{database}.{name}", (f"NUM_PAYM_{name.upper()}",)))
    return features.create_training_set(spark.table(f"{database}.base"), lookups, exclude=(KEY,), skewed=False)


@query
def feature_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Clients of the whole table that features of the reference window lack."""
    records = clean_credit(spark, sf)
    known = features.num_paym_unmet(prepare.within(records, REFERENCE_WINDOW))
    return joins.orphans(records, known, [KEY])


@query
def lookup_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Features known for the reference window only: the others stay null."""
    records = clean_credit(spark, sf)
    known = features.num_paym_unmet(prepare.within(records, REFERENCE_WINDOW))
    lookup = FeatureLookup(known, ("NUM_PAYM_UNMET",))
    return features.look_up(records.select(KEY, "LIMIT_BAL"), [lookup])


@query
def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return features.key_violations(table(spark, sf, "orders"), ["o_custkey"])


@query
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed feature table written to the catalog and read back."""
    database = "evenkeel_features"
    tables.recreate_database(spark, database, scratch_path(spark, "features"))
    name = f"{database}.num_paym_unmet_feature"
    tables.drop_table(spark, name)
    features.create_feature_table(
        spark, name, features.num_paym_unmet(clean_credit(spark, sf)),
        description="late payments of a client over six months", buckets=8,
    )
    return spark.table(name)


@query
def score_label_join(spark: SparkSession, sf: str) -> DataFrame:
    records = clean_credit(spark, sf)
    scored = rule_scorer(records.drop(LABEL, PREDICTION)).select(KEY, *PAY_AMOUNT_COLUMNS, PREDICTION)
    labelled = joins.attach_label(scored, records, LABEL, KEY)
    stamped = prepare.stamp(labelled, PROJECT, MODEL, AS_OF)
    return prepare.amounts_to_double(stamped)


@query
def ref_prod_slice(spark: SparkSession, sf: str) -> DataFrame:
    return credit_slices(spark, sf).select(KEY, "monitoring_date", "in_ref", "in_prod")


@query
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as one list of parties; suppliers lack a segment."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("balance"),
    )
    return tables.stack([customers, suppliers], same_columns=False)


# --- outcomes and fairness ---------------------------------------------------


@query
def outcome_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(outcomes.outcome_rates(clean_credit(spark, sf)), ["pct_total"])


@query
def outcome_rates_production(spark: SparkSession, sf: str) -> DataFrame:
    production = prepare.within(clean_credit(spark, sf), PRODUCTION_WINDOW)
    return rounded(outcomes.outcome_rates(production), ["pct_total"])


@query
def batch_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.row_count(prepare.within(credit_view(spark, sf), PRODUCTION_WINDOW))


@query
def confusion_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return fair.confusion_by_group(clean_credit(spark, sf))


@query
def confusion_by_language(spark: SparkSession, sf: str) -> DataFrame:
    return fair.confusion_by_group(labelled_documents(spark, sf), LANG_PROTECTED)


def _fairness_of(df: DataFrame, protected=None, run: Column | None = None) -> DataFrame:
    protected = protected or {"SEX": (1,), "MARRIAGE": (1,)}
    named = df.withColumn("model_run_id", F.lit(RUN) if run is None else run)
    by = ["model_run_id"]
    groups = fair.confusion_by_group(named, protected, by=by)
    return fair.fairness_long(fair.fairness_metrics(groups, by))


@query
def fairness_long(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_fairness_of(clean_credit(spark, sf)), ["parity"])


@query
def fairness_language(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_fairness_of(labelled_documents(spark, sf), LANG_PROTECTED), ["parity"])


def _fairness_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return _fairness_of(clean_credit(spark, sf), run=F.col("segment"))


@query
def fairness_by_run(spark: SparkSession, sf: str) -> DataFrame:
    """Many runs at once: each market segment stands for a run."""
    return rounded(_fairness_by_segment(spark, sf), ["parity"])


@query
def fairness_benefit(spark: SparkSession, sf: str) -> DataFrame:
    """The same measures with 'no default' as the favorable outcome."""
    groups = fair.confusion_by_group(clean_credit(spark, sf), favorable=0)
    gaps = fair.fairness_metrics(groups).withColumn("model_run_id", F.lit(RUN))
    return rounded(fair.fairness_long(gaps), ["parity"])


@query
def protected_variables(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.distinct_values(_fairness_of(clean_credit(spark, sf)))


@query
def parity_gate_any(spark: SparkSession, sf: str) -> DataFrame:
    return fair.parity_gate(_fairness_by_segment(spark, sf), "any_signed")


@query
def parity_gate_all(spark: SparkSession, sf: str) -> DataFrame:
    return fair.parity_gate(_fairness_by_segment(spark, sf), "all_abs")


@query
def parity_gate_one_run(spark: SparkSession, sf: str) -> DataFrame:
    """Both gate modes of a single run side by side."""
    long = fair.of_run(_fairness_of(clean_credit(spark, sf)), RUN)
    strict = fair.parity_gate(long, "all_abs").select(
        "protected_var", F.col("parity_check").alias("strict_check")
    )
    return fair.parity_gate(long, "any_signed").join(strict, "protected_var")


@query
def fair_conclusion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fair.fair_conclusion(_fairness_by_segment(spark, sf)), ["value"])


@query
def perf_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(perf.performance(fair.cells(clean_credit(spark, sf))), ["value"])


@query
def mean_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(perf.mean_accuracy(credit_view(spark, sf), LABEL, PREDICTION), ["accuracy"])


@query
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    intervals = perf.performance_intervals(fair.cells(clean_credit(spark, sf)))
    return rounded(intervals, ["value", "ci_low", "ci_high"])


@query
def fairness_ci(spark: SparkSession, sf: str) -> DataFrame:
    intervals = perf.fairness_intervals(fair.cells(clean_credit(spark, sf)))
    return rounded(intervals, ["value", "ci_low", "ci_high"])


@query
def perf_values(spark: SparkSession, sf: str) -> DataFrame:
    """The metric table of a run with its interval rows dropped."""
    intervals = perf.performance_intervals(fair.cells(clean_credit(spark, sf)))
    return rounded(perf.values_only(perf.performance_table(intervals, RUN)), ["value"])


@query
def tradeoff(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(trade.tradeoff(clean_credit(spark, sf)), ["balanced_accuracy"])


@query
def tradeoff_parity(spark: SparkSession, sf: str) -> DataFrame:
    points = trade.tradeoff(clean_credit(spark, sf), metric="demographic_parity")
    return rounded(points, ["balanced_accuracy"])


# --- drift and quality -------------------------------------------------------


@query
def drift_ks(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.numeric_statistics(lineitem_slices(spark, sf), LINEITEM_ROLES.numerical)
    return rounded(
        stats.select("feature", "n_ref", "n_prod", "ks_statistic", "ks_p_value"),
        ["ks_statistic", "ks_p_value"],
    )


@query
def drift_chi2(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.category_statistics(orders_slices(spark, sf), ORDERS_ROLES.categorical)
    return rounded(
        stats.select("feature", "n_ref", "n_prod", "chi2_statistic", "degrees", "chi2_p_value"),
        ["chi2_statistic", "chi2_p_value"],
    )


@query
def drift_z(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.category_statistics(lineitem_slices(spark, sf), ["l_linestatus"])
    return rounded(
        stats.select("feature", "n_ref", "n_prod", "z_statistic", "z_p_value"),
        ["z_statistic", "z_p_value"],
    )


@query
def drift_distance(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.feature_drift(
        lineitem_slices(spark, sf), LINEITEM_ROLES.numerical, LINEITEM_ROLES.categorical, "distance"
    )
    return rounded(rows, ["drift_score"])


@query
def dataset_drift(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.dataset_drift(credit_slices(spark, sf), CREDIT_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(rows, ["drift_score"])


@query
def dataset_drift_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.dataset_drift(orders_slices(spark, sf), ORDERS_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(rows, ["drift_score"])


@query
def dataset_drift_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.dataset_drift(events_slices(spark, sf), EVENTS_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(rows, ["drift_score"])


@query
def label_drift_cat(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.label_drift(credit_slices(spark, sf), CREDIT_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(rows, ["drift_score"])


@query
def label_drift_num(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.label_drift(orders_slices(spark, sf), ORDERS_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(rows, ["drift_score"])


@query
def drift_histogram(spark: SparkSession, sf: str) -> DataFrame:
    bins = dist.histogram(lineitem_slices(spark, sf), LINEITEM_ROLES.numerical)
    return rounded(bins, ["lower_edge", "share"])


@query
def category_shares(spark: SparkSession, sf: str) -> DataFrame:
    shares = dist.category_shares(lineitem_slices(spark, sf), LINEITEM_ROLES.categorical)
    return rounded(shares, ["share"])


@query
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.drift_report(credit_slices(spark, sf), CREDIT_ROLES), ["share"])


QUALITY_NUMBERS = (
    "min_value", "max_value", "mean", "stddev", "q25", "q50", "q75", "top_number", "top_share",
)


@query
def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.quality_profile(lineitem_slices(spark, sf), LINEITEM_ROLES)
    return rounded(rows, QUALITY_NUMBERS)


@query
def quality_profile_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Columns with missing values: the payment history of the credit table."""
    roles = ColumnRoles(numerical=("BILL_AMT6", "PAY_AMT6"), categorical=("PAY_6",))
    return rounded(quality.quality_profile(credit_slices(spark, sf), roles), QUALITY_NUMBERS)


# --- versions, events, documents ---------------------------------------------


def order_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as model versions: a customer is a model, an order a version."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("model_name"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderstatus").alias("stage"),
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
    )


@query
def latest_previous(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_and_previous(order_versions(spark, sf))


@query
def stage_version(spark: SparkSession, sf: str) -> DataFrame:
    return versions.version_for_stage(order_versions(spark, sf), "F")


@query
def run_of_stage(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select(
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        F.concat(F.lit("silver/"), F.col("o_orderpriority")).alias("source_data"),
    )
    return versions.run_of_model(order_versions(spark, sf), runs, "F")


@query
def event_payload(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("payload")
    )
    return parsed.select("event_id", "payload.k", prepare.as_date(AS_OF).alias("run_date"))


@query
def deployment_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Every event asks to deploy a segment's model; its newest run is gated."""
    segments = clean_credit(spark, sf)
    fairness = _fairness_by_segment(spark, sf)
    model_versions = segments.groupBy("segment").agg(F.max(KEY).alias("version")).select(
        F.col("segment").alias("model_name"),
        "version",
        F.lit("Staging").alias("stage"),
        F.col("segment").alias("run_id"),
    )
    messages = table(spark, sf, "customer").select(
        F.to_json(
            F.struct(
                F.col("c_mktsegment").alias("model_name"),
                F.col("c_custkey").cast("string").alias("version"),
                F.col("c_name").alias("text"),
                F.concat(F.lit("hook-"), F.col("c_nationkey")).alias("webhook_id"),
            )
        ).alias("event_message")
    )
    history_rows = gate_deployments(messages, model_versions, fairness)
    # The time of the run differs from run to run.
    return history_rows.drop("run_ts")


def _segment_gate(spark: SparkSession, sf: str) -> Callable[[DataFrame], DataFrame]:
    """Gates events by the stored fairness of their segment's newest version."""
    path = scratch_path(spark, "segment-fairness")
    tables.overwrite(_fairness_by_segment(spark, sf), path)
    newest = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.max("c_custkey").alias("version"))
    own = F.col("c_mktsegment")
    model_versions = newest.select(own.alias("model_name"), "version", F.lit("Staging").alias("stage"), own.alias("run_id"))
    return lambda events: gate_deployments(events, model_versions, tables.read(spark, path))


def _deployment_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Events of all customers, and lines that are none."""
    customers = table(spark, sf, "customer")
    event = F.struct(
        F.concat(F.lit("event-"), F.col("c_custkey")).alias("event_id"),
        F.timestamp_seconds(F.lit(1669852800) + F.col("c_custkey") % 86400).alias("event_ts"),
        F.col("c_mktsegment").alias("model_name"),
        F.col("c_custkey").cast("string").alias("version"),
        F.col("c_name").alias("text"),
        F.concat(F.lit("hook-"), F.col("c_nationkey")).alias("webhook_id"),
    )
    broken = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("broken "), F.col("c_name"))).otherwise(
        F.concat(F.lit('{"model_name":"'), F.col("c_mktsegment"), F.lit('"}'))
    )
    return customers.select("c_custkey", F.to_json(event).alias("value")), customers.select(broken.alias("value"))


@query
def deployment_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Deployment events as a stream, most of them sent twice, gated and read back."""
    events, broken = _deployment_lines(spark, sf)
    root = scratch_path(spark, "deployments")
    gate = _segment_gate(spark, sf)
    for sent in (events.where("c_custkey % 3 <> 0").select("value"), events.select("value").union(broken)):
        sent.write.mode("append").text(f"{root}/incoming")
        stream_history(spark, f"{root}/incoming", f"{root}/history", f"{root}/checkpoint", gate).awaitTermination()
    return read_history(spark, f"{root}/history").drop("run_ts")


@query
def deployment_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the stream that are no event, counted with the reason."""
    events, broken = _deployment_lines(spark, sf)
    root = scratch_path(spark, "quarantine")
    for sent in (broken, events.select("value")):
        sent.write.mode("append").text(f"{root}/incoming")
        stream_quarantine(spark, f"{root}/incoming", f"{root}/lines", f"{root}/checkpoint").awaitTermination()
    return tables.read(spark, f"{root}/lines").groupBy("event_message", "reason").agg(F.count("*").alias("n_lines"))


@query
def metric_doc(spark: SparkSession, sf: str) -> DataFrame:
    """Fairness results written as JSON documents and read back."""
    documents = history.metric_documents(_fairness_by_segment(spark, sf))
    wanted = FAIRNESS_METRICS[:2]
    return rounded(history.read_metric_documents(documents, wanted), ["parity"])


@query
def metric_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One value picked out of each document by variable, metric and position."""
    documents = history.metric_documents(_fairness_by_segment(spark, sf))
    document = F.from_json("fair_metrics", schemas.FAIR_METRICS_DOCUMENT)
    picked = documents.select(
        "model_run_id", history.lookup_metric(document, "SEX", "equal_opportunity").alias("parity")
    )
    return rounded(picked, ["parity"])


@query
def metric_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Metric names and values held in parallel arrays, paired by position."""
    gaps = fair.fairness_metrics(fair.confusion_by_group(clean_credit(spark, sf)))
    arrays = gaps.select(
        "protected_var",
        F.array(*[F.lit(m) for m in FAIRNESS_METRICS]).alias("names"),
        F.array(*FAIRNESS_METRICS).alias("gaps"),
    )
    return rounded(fair.pair_metrics(arrays, "names", "gaps", ["protected_var"]), ["parity"])


@query
def json_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tables.as_json(table(spark, sf, "nation"), keep=["n_nationkey"])


# --- tables on storage -------------------------------------------------------


@query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV files with a header, read as one table under a declared schema."""
    records = credit_view(spark, sf).select(*schemas.CREDIT.fieldNames())
    parts = []
    for name, sex in (("credit_one", 1), ("credit_two", 2)):
        path = scratch_path(spark, name)
        records.where(F.col("SEX") == sex).write.option("header", True).csv(path)
        parts.append(path)
    return tables.read_csv(spark, parts)


@query
def lineage_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The tables named by a run's comma-separated lineage tag."""
    return tables.read_lineage(
        spark, f"{sf}/customer.parquet,{sf}/supplier.parquet"
    ).select("c_custkey", "c_name", "s_suppkey", "s_name")


@query
def schema_merge_append(spark: SparkSession, sf: str) -> DataFrame:
    """A second batch brings a new column; the first batch's rows get null."""
    path = scratch_path(spark, "merged")
    records = clean_credit(spark, sf)
    tables.append(
        prepare.within(records, REFERENCE_WINDOW).select(KEY, "LIMIT_BAL"), path
    )
    tables.append(
        prepare.within(records, PRODUCTION_WINDOW).select(KEY, "LIMIT_BAL", "score"), path
    )
    return tables.read(spark, path, merge_schema=True)


@query
def overwrite_replaces_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "replaced")
    records = credit_view(spark, sf)
    tables.overwrite(records.select(KEY, "SEX"), path)
    tables.overwrite(records.select(KEY, "AGE", "score"), path)
    return tables.read(spark, path)


@query
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The newest of two versions of a table."""
    path = scratch_path(spark, "snapshots")
    records = credit_view(spark, sf).select(KEY, "MARRIAGE", "AGE")
    tables.write_snapshot(records, path, 1)
    tables.write_snapshot(prepare.clean(records), path, 2)
    return tables.read_snapshot(spark, path)


def _published(spark: SparkSession, sf: str, name: str) -> str:
    """Raw and clean records as versions 1 and 2, and a third one that was never finished."""
    path = scratch_path(spark, name)
    records = credit_view(spark, sf).select(KEY, "MARRIAGE", "AGE")
    tables.publish_version(records, path, 1)
    tables.publish_version(prepare.clean(records), path, 2)
    records.where("AGE > 30").write.parquet(f"{path}/data/000000000003-unfinished")
    return path


@query
def published_newest(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_version(spark, _published(spark, sf, "published-newest"))


@query
def published_pinned(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_version(spark, _published(spark, sf, "published-pinned"), 1)


@query
def schema_history(spark: SparkSession, sf: str) -> DataFrame:
    """What three versions of the credit table changed, and how many rows have the newest schema."""
    path = scratch_path(spark, "schemas")
    records = credit_view(spark, sf).select(KEY, "SEX", "AGE", "LIMIT_BAL")
    tables.publish_version(records, path, 1)
    tables.publish_version(records.drop("SEX").withColumn("AGE", F.col("AGE").cast("double")), path, 2)
    tables.publish_version(
        records.withColumns({"LIMIT_BAL": F.col("LIMIT_BAL").cast("int"), "score": F.lit(1)}), path, 3
    )
    n_rows = tables.read_version(spark, path).agg(F.count("score").alias("n_rows"))
    return tables.schema_history(spark, path).withColumn("n_rows", F.lit(n_rows.first()[0]).cast("long"))


@query
def ingested(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV files stacked, stored raw, cleaned and stored again."""
    root = scratch_path(spark, "ingested")
    records = credit_view(spark, sf).select(*schemas.CREDIT.fieldNames())
    for part in (0, 1):
        records.where(F.col(KEY) % 2 == part).write.option("header", True).csv(f"{root}/raw_{part}")
    return tables.read(spark, training.ingest(spark, [f"{root}/raw_0", f"{root}/raw_1"], root))


@query
def composite_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the price and quantity summary of their part and supplier, a key of two columns."""
    lines = table(spark, sf, "lineitem")
    keys = ("l_partkey", "l_suppkey")
    summary = lines.groupBy(*keys).agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(20,2)")).cast("double").alias("quantity")
    ).where("n_lines > 1")
    base = lines.select("l_orderkey", "l_linenumber", *keys)
    return features.look_up(base, [FeatureLookup(summary, ("n_lines", "quantity"), keys)])


@query
def features_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """For two dates of each client the newest order up to then, with gaps and ties."""
    seen = F.date_add(F.to_date(F.lit("1995-01-01")), F.col("day").cast("int"))
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(KEY), F.explode(F.array(F.col("c_custkey") * 37 % 2000, F.col("c_custkey") * 37 % 2000 + 300)).alias("day")
    ).select(KEY, seen.alias("seen_on"))
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias(KEY), F.col("o_orderdate").cast("date").alias("feature_date"), "o_totalprice", "o_orderkey"
    )
    return joins.look_up_as_of(base, orders, ("o_totalprice", "o_orderkey"), KEY, "seen_on", "feature_date")


@query
def catalog_append(spark: SparkSession, sf: str) -> DataFrame:
    """Drift rows of two runs appended to a catalog table."""
    database = "evenkeel_reports"
    tables.recreate_database(spark, database, scratch_path(spark, "reports"))
    name = f"{database}.drift"
    for as_of in ("2022-12-17", "2022-12-18"):
        rows = drift.dataset_drift(events_slices(spark, sf), EVENTS_ROLES, PROJECT, MODEL, as_of)
        tables.append_catalog(schemas.conform(rows, schemas.DATASET_DRIFT), name)
    return rounded(spark.table(name), ["drift_score"])


def _monitor(spark: SparkSession, name: str) -> Monitor:
    return Monitor(spark, scratch_path(spark, name), PROJECT, MODEL, rule_scorer)


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    columns = [*schemas.CREDIT.fieldNames(), "score"]
    records = credit_view(spark, sf)
    return (
        prepare.within(records, REFERENCE_WINDOW).select(*columns),
        prepare.within(records, PRODUCTION_WINDOW).select(*columns),
    )


@query
def baseline_and_append(spark: SparkSession, sf: str) -> DataFrame:
    monitor = _monitor(spark, "monitor")
    baseline, batch = _batches(spark, sf)
    monitor.register_baseline(prepare.clean(baseline), as_of="2022-03-01", load_id="baseline")
    monitor.add_new_data(batch, as_of=AS_OF, load_id="second")
    return monitor.read()


@query
def monitored_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of a second batch against the baseline, through the stored tables."""
    monitor = _monitor(spark, "drift")
    baseline, batch = _batches(spark, sf)
    monitor.register_baseline(prepare.clean(baseline), as_of="2022-03-01")
    monitor.add_new_data(batch, as_of=AS_OF, load_id="second")
    tagged = monitor.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    path = monitor.save_dataset_drift(tagged, CREDIT_ROLES, AS_OF)
    return rounded(tables.read(spark, path), ["drift_score"])


@query
def saved_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality profile of the monitored batches, stored as a table."""
    monitor = _monitor(spark, "quality")
    baseline, batch = _batches(spark, sf)
    monitor.register_baseline(prepare.clean(baseline), as_of="2022-03-01")
    monitor.add_new_data(batch, as_of=AS_OF, load_id="second")
    tagged = monitor.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    path = monitor.save_quality(tagged, CREDIT_ROLES, AS_OF)
    return rounded(tables.read(spark, path), QUALITY_NUMBERS)


@query
def saved_run(spark: SparkSession, sf: str) -> DataFrame:
    """Results of a run stored in the result tables, read back with its lineage."""
    root = scratch_path(spark, "run")
    records = clean_credit(spark, sf)
    scored = records.withColumn("probability", F.col("score") / 100)
    results = training.audit_scored(scored, RUN)
    history.save_run(root, RUN, "clean/credit", **results)
    conclusion = tables.read(spark, f"{root}/conclusion")
    return rounded(conclusion.join(tables.read(spark, f"{root}/runs"), "run_id"), ["value"])


def _saved_run(spark: SparkSession, sf: str, name: str) -> str:
    root = scratch_path(spark, name)
    path = scratch_path(spark, "scored")
    tables.overwrite(clean_credit(spark, sf).withColumn("probability", F.col("score") / 100), path)
    history.save_run(root, RUN, "clean/credit", **training.audit_scored(tables.read(spark, path), RUN))
    return root


@query
def saved_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A run's fairness and performance read back from its tables."""
    root = _saved_run(spark, sf, "saved-metrics")
    fairness = tables.read(spark, f"{root}/fairness").where(F.col("model_run_id") == RUN)
    performance = tables.read(spark, f"{root}/perf").where(F.col("run_id") == RUN)
    both = fairness.select("protected_var", "metric", F.col("parity").alias("value")).unionByName(
        performance.select("metric", "value"), allowMissingColumns=True
    )
    return rounded(both, ["value"])


@query
def saved_tradeoff(spark: SparkSession, sf: str) -> DataFrame:
    """A run's thresholds read back from its table."""
    root = _saved_run(spark, sf, "saved-tradeoff")
    return rounded(tables.read(spark, f"{root}/tradeoff").drop("run_id"), ["balanced_accuracy"])


@query
def unscored_baseline(spark: SparkSession, sf: str) -> DataFrame:
    monitor = Monitor(spark, scratch_path(spark, "unscored"), PROJECT, MODEL)
    records = credit_view(spark, sf).select(KEY, "SEX", "default")
    monitor.register_baseline(records, score=False, as_of="2022-03-01")
    return monitor.read()


@query
def streamed_append(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch arrives as files of a stream."""
    monitor = _monitor(spark, "stream")
    baseline, batch = _batches(spark, sf)
    monitor.register_baseline(prepare.clean(baseline), as_of="2022-03-01")
    source = scratch_path(spark, "incoming")
    batch.write.parquet(source)
    stream_new_data(
        monitor, source, batch.schema, AS_OF, scratch_path(spark, "stream-checkpoint")
    ).awaitTermination()
    return monitor.read().drop(LOAD)


# --- reports from stored counts ------------------------------------------------


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All records: those of the first half of the year, and the others."""
    records = credit_view(spark, sf).select(*schemas.CREDIT.fieldNames(), "score", "monitoring_date")
    first = F.col("monitoring_date") <= "2022-06-30"
    return records.where(first), records.where(~first)


def _counted_monitor(spark: SparkSession, sf: str, name: str) -> Monitor:
    """Two loads, dated by month; days that bound a window keep their date. The second was loaded twice."""
    monitor = Monitor(
        spark, scratch_path(spark, name), PROJECT, MODEL, rule_scorer, roles=CREDIT_ROLES, date_column="seen_on"
    )
    baseline, batch = _halves(spark, sf)
    day = F.col("monitoring_date")
    bounds = [F.to_date(F.lit(d)) for w in (REFERENCE_WINDOW, PRODUCTION_WINDOW) for d in (w.start, w.end)]
    own = F.when(day.isin(bounds), day).otherwise(F.date_add(F.trunc(day, "month"), 14))
    monitor.register_baseline(baseline, as_of=own, load_id="baseline")
    monitor.add_new_data(batch.where("USER_ID % 2 = 0"), as_of=own, load_id="second")
    monitor.add_new_data(batch, as_of=own, load_id="second")
    return monitor


@query
def summary_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Dataset drift from the counts stored with each load."""
    monitor = _counted_monitor(spark, sf, "summary-drift")
    counts = monitor.tagged_summary(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    path = monitor.save_dataset_drift(counts, CREDIT_ROLES, AS_OF)
    return rounded(tables.read(spark, path), ["drift_score"])


@query
def summary_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Label drift and drift by distance, from the counts stored with each load."""
    monitor = _counted_monitor(spark, sf, "summary-distance")
    counts = monitor.tagged_summary(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    labels = drift.label_drift(counts, CREDIT_ROLES, PROJECT, MODEL, AS_OF)
    return rounded(labels, ["drift_score"])


@query
def summary_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality profile from stored counts, appended to a catalog table and read back."""
    monitor = _counted_monitor(spark, sf, "summary-quality")
    counts = monitor.tagged_summary(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    database = "evenkeel_quality"
    tables.recreate_database(spark, database, scratch_path(spark, "quality-tables"))
    name = monitor.save_quality_table(counts, CREDIT_ROLES, f"{database}.profile", AS_OF)
    return rounded(spark.table(name), QUALITY_NUMBERS)


@query
def summary_report(spark: SparkSession, sf: str) -> DataFrame:
    """Bins and categories of all reported columns, from stored counts."""
    monitor = _counted_monitor(spark, sf, "summary-report")
    counts = monitor.tagged_summary(REFERENCE_WINDOW, PRODUCTION_WINDOW, allow_empty=True)
    return rounded(drift.drift_report(counts, CREDIT_ROLES), ["share"])


@query
def sampled_windows(spark: SparkSession, sf: str) -> DataFrame:
    """A repeatable third of the clients of both windows."""
    monitor = _counted_monitor(spark, sf, "sampled")
    rows = monitor.tagged(REFERENCE_WINDOW, PRODUCTION_WINDOW, sample_fraction=0.3, allow_empty=True)
    return rows.select(KEY, "seen_on", "in_ref", "in_prod")


# --- model -------------------------------------------------------------------

DECLARED_WEIGHTS = {"NUM_PAYM_UNMET": 0.9, "NUM_PAYM_MET": -0.4, "LIMIT_BAL": -0.2, "AGE": 0.1, "SEX": 0.25}
DECLARED_INTERCEPT = -0.7


def _registry(spark: SparkSession, root: str, card: scorecard.Scorecard, source_data: str) -> Registry:
    """Two versions of a model; the second, in staging, has the scorecard."""
    scorecard.save(spark, card, f"{root}/scorecards", MODEL, 2)
    versions_table = spark.createDataFrame(
        [(MODEL, 1, "Production", "run_0"), (MODEL, 2, "Staging", RUN)],
        "model_name string, version long, stage string, run_id string",
    )
    runs = spark.createDataFrame([("run_0", "nowhere"), (RUN, source_data)], schemas.RUNS)
    return Registry(versions_table, runs, f"{root}/scorecards")


def _silver(spark: SparkSession, sf: str, root: str) -> tuple[str, DataFrame]:
    """The clean first half stored as two tables named in one lineage tag, and the raw second half."""
    baseline, batch = _halves(spark, sf)
    clean = prepare.clean(baseline).drop("score", "monitoring_date")
    for part in (1, 2):
        tables.overwrite(clean.where(F.col("SEX") == part), f"{root}/silver_{part}")
    return f"{root}/silver_1,{root}/silver_2", batch.drop("score", "monitoring_date")


def _with_payment_features(df: DataFrame) -> DataFrame:
    """Both payment features looked up by client."""
    return features.look_up(df, [FeatureLookup(features.payment_features(df), ("NUM_PAYM_UNMET", "NUM_PAYM_MET"))])


_SCORED = (KEY, LABEL, PREDICTION, "probability", "confidence", "monitoring_date", "project_name", "model_name", LOAD)


@query
def registered_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Baseline and batch scored by a stored model: version, run, lineage, lookup, score."""
    root = scratch_path(spark, "registered")
    source_data, batch = _silver(spark, sf, root)
    silver = _with_payment_features(model.split(tables.read_lineage(spark, source_data)))
    card = scorecard.declared(silver.where("split = 'train'"), DECLARED_WEIGHTS, DECLARED_INTERCEPT)
    registry = _registry(spark, root, card, source_data)
    monitor = Monitor(spark, root, PROJECT, MODEL)
    monitor.register_model_baseline(registry, "Staging", _with_payment_features, as_of="2022-03-01")
    labels = batch.select(KEY, LABEL)
    monitor.add_new_data(batch.drop(LABEL), labels=labels, as_of=AS_OF, load_id="second")
    return rounded(monitor.read().select(*_SCORED), ["probability", "confidence"])


def _stored_training_set(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "training_rows")
    tables.overwrite(model.split(training.training_set(clean_credit(spark, sf))), path, ["split"])
    return tables.read(spark, path)


def _fitted(data: DataFrame) -> scorecard.Scorecard:
    inputs = [c for c in data.columns if c not in (KEY, LABEL, "split")]
    return scorecard.from_pipeline(model.train(data.where("split = 'train'"), inputs))


@query
def fit_certificate(spark: SparkSession, sf: str) -> DataFrame:
    """The trained model as a table, with proof that its weights are the optimum."""
    data = _stored_training_set(spark, sf)
    checked = scorecard.certificate(data.where("split = 'train'"), _fitted(data))
    return rounded(
        checked.select("feature", "position", "n_rows", "mean", "scale", scorecard.is_optimal(checked).alias("optimal")),
        ["mean", "scale"],
    )


@query
def trained_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """A monitored table scored by the trained model; on training rows it predicts the base rate."""
    root = scratch_path(spark, "trained")
    data = _stored_training_set(spark, sf)
    source = f"{root}/silver"
    tables.overwrite(clean_credit(spark, sf).select(*schemas.CREDIT.fieldNames()), source)
    registry = _registry(spark, root, _fitted(data), source)
    monitor = Monitor(spark, root, PROJECT, MODEL)
    monitor.register_model_baseline(registry, "Staging", _with_payment_features, as_of="2022-03-01")
    scored = model.split(monitor.read())
    surest = F.greatest(F.col("probability"), 1 - F.col("probability")) == F.col("confidence")
    agrees = (F.col("probability") > 0.5).cast("int") == F.col(PREDICTION)
    return scored.groupBy("split", "monitoring_date", LOAD).agg(
        F.count("*").alias("n_rows"),
        F.sum(LABEL).cast("long").alias("n_default"),
        F.when(F.col("split") == "train", F.round(F.avg("probability"), 4)).alias("mean_probability"),
        F.every(surest & agrees).alias("consistent"),
    )



@query
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return model.split(credit_view(spark, sf)).select(KEY, "split")


@query
def train_score(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the larger part of the clients and score the rest."""
    data = model.split(training.training_set(clean_credit(spark, sf)))
    inputs = [c for c in data.columns if c not in (KEY, LABEL, "split")]
    fitted = model.train(data.where(F.col("split") == "train"), inputs)
    scored = model.score(fitted, data.where(F.col("split") == "test"))
    return rounded(
        scored.select(KEY, LABEL, PREDICTION, "probability", "confidence"),
        ["probability", "confidence"],
    )


@query
def train_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Fairness of a model trained on the credit table."""
    return rounded(training.train_and_audit(clean_credit(spark, sf), RUN).fairness, ["parity"])
