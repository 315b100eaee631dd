"""Picking model versions and runs from plain tables of versions and runs.

``versions``: model_name, version, stage, run_id. ``runs``: run_id, source_data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_and_previous(versions: DataFrame) -> DataFrame:
    """The newest two versions of each model, ranked 1 and 2.

    Spark keeps only two rows per model and map task before the shuffle.
    """
    newest = W.partitionBy("model_name").orderBy(F.desc("version"), F.desc("run_id"))
    ranked = versions.withColumn("version_rank", F.row_number().over(newest))
    return ranked.where(F.col("version_rank") <= 2).select(
        "model_name", "version", "run_id", "version_rank"
    )


def latest_version(versions: DataFrame) -> DataFrame:
    return latest_and_previous(versions).where(F.col("version_rank") == 1).drop("version_rank")


def version_for_stage(versions: DataFrame, stage: str = "Staging") -> DataFrame:
    """Each model's newest version in ``stage``; an only version counts anyway.

    One aggregation with a map-side half rather than windows, so a model with
    very many versions does not fill a task.
    """
    entry = F.struct("version", "run_id", "stage")
    picked = versions.groupBy("model_name").agg(
        F.count("*").alias("n"),
        F.max(entry).alias("newest"),
        F.max(F.when(F.col("stage") == stage, entry)).alias("in_stage"),
    )
    chosen = F.when(F.col("n") == 1, F.col("newest")).otherwise(F.col("in_stage"))
    return (
        picked.select("model_name", chosen.alias("v"))
        .where(F.col("v").isNotNull())
        .select("model_name", "v.version", "v.run_id", "v.stage")
    )


def run_of_model(versions: DataFrame, runs: DataFrame, stage: str = "Staging") -> DataFrame:
    """The run behind each model's version for a stage."""
    return version_for_stage(versions, stage).join(runs, "run_id")
