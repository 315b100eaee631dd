"""The credit table seen over the customer and orders tables.

One row per customer; the six most recent orders stand for the six months of
payment history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.config import BILL_AMOUNT_COLUMNS, PAY_AMOUNT_COLUMNS, PAY_COLUMNS
from evenkeel.operators.joins import balanced_join

HISTORY_MONTHS = 6
SCORE_THRESHOLD = 40
FIRST_DATE = "2022-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def payment_history(orders: DataFrame) -> DataFrame:
    """Six most recent orders per customer, one column per order and measure.

    The rank filter is applied before the shuffle too (a partial group limit),
    so a customer with very many orders sends at most six rows per map task.
    The pivot reuses the window's partitioning.
    """
    newest = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    ranked = orders.withColumn("month", F.row_number().over(newest)).where(
        f"month <= {HISTORY_MONTHS}"
    )
    months = ranked.selectExpr(
        "o_custkey",
        "month",
        "CASE o_orderstatus WHEN 'F' THEN -1 WHEN 'P' THEN 0 "
        "ELSE CAST(1 + o_orderkey % 9 AS INT) END AS pay",
        "o_totalprice AS bill",
        "CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN o_totalprice / 2 "
        "ELSE 0D END AS paid",
    )
    pivoted = [
        F.expr(f"max(CASE WHEN month = {k} THEN {measure} END) AS {prefix}{k}")
        for prefix, measure in (("PAY_", "pay"), ("BILL_AMT", "bill"), ("PAY_AMT", "paid"))
        for k in range(1, HISTORY_MONTHS + 1)
    ]
    return months.groupBy("o_custkey").agg(*pivoted)


def credit_view(spark: SparkSession, folder: str) -> DataFrame:
    """Credit records with label, integer score, prediction and monitoring date."""
    history = payment_history(table(spark, folder, "orders"))
    customers = table(spark, folder, "customer")
    joined = customers.join(history, customers["c_custkey"] == history["o_custkey"], "left")
    unmet = " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in PAY_COLUMNS)
    records = joined.selectExpr(
        "c_custkey AS USER_ID",
        "c_acctbal AS LIMIT_BAL",
        "CAST(1 + c_custkey % 2 AS INT) AS SEX",
        "CAST(1 + c_custkey % 6 AS INT) AS EDUCATION",
        "CAST(c_nationkey % 4 AS INT) AS MARRIAGE",
        "CAST(21 + c_custkey % 50 AS INT) AS AGE",
        *PAY_COLUMNS,
        *BILL_AMOUNT_COLUMNS,
        *PAY_AMOUNT_COLUMNS,
        f"{unmet} AS unmet",
        "c_mktsegment AS segment",
    )
    scored = records.selectExpr(
        "*", "least(100, 15 * unmet + CAST(USER_ID % 7 AS INT)) AS score"
    )
    return scored.selectExpr(
        *[c for c in records.columns if c not in ("unmet", "segment")],
        "CASE WHEN (unmet >= 3 AND USER_ID % 10 < 8) OR USER_ID % 10 = 9 "
        "THEN 1 ELSE 0 END AS default",
        "score",
        f"CASE WHEN score >= {SCORE_THRESHOLD} THEN 1 ELSE 0 END AS prediction",
        f"date_add(DATE '{FIRST_DATE}', CAST(USER_ID % 365 AS INT)) AS monitoring_date",
        "segment",
    )


def labelled_documents(spark: SparkSession, folder: str, long_text: int = 500) -> DataFrame:
    """Documents with a quality label and a length rule as the prediction."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return balanced_join(labels, documents, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("default"),
        F.when(F.col("n_chars") >= long_text, 1).otherwise(0).alias("prediction"),
    )
