"""From clean records to a trained, scored and audited model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.config import KEY, LABEL, PREDICTION, PROTECTED, FeatureLookup, Protected
from evenkeel.operators import fairness as fair
from evenkeel.operators import features, history, model, performance, prepare
from evenkeel.operators.tradeoff import probability_bins, tradeoff
from evenkeel.session import scratch_path
from evenkeel.sources import tables


@dataclass(frozen=True)
class Audit:
    """A run's model, its scored test rows and its result tables (all lazy)."""

    model: PipelineModel
    scored: DataFrame
    fairness: DataFrame
    performance: DataFrame
    tradeoff: DataFrame
    conclusion: DataFrame

    def save(self, root: str, run_id: str, source_data: str) -> None:
        history.save_run(
            root, run_id, source_data,
            self.fairness, self.performance, self.tradeoff, self.conclusion,
        )


def ingest(spark: SparkSession, paths: Sequence[str], root: str) -> str:
    """CSV files to the raw table ``bronze`` and the clean table ``silver``; returns the latter's path."""
    tables.overwrite(tables.read_csv(spark, paths), f"{root}/bronze")
    tables.overwrite(prepare.clean(tables.read(spark, f"{root}/bronze")), f"{root}/silver")
    return f"{root}/silver"


def payment_lookups(records: DataFrame) -> list[FeatureLookup]:
    """Both payment features, computed for the records at hand."""
    return [
        FeatureLookup(features.num_paym_unmet(records), ("NUM_PAYM_UNMET",)),
        FeatureLookup(features.num_paym_met(records), ("NUM_PAYM_MET",)),
    ]


def training_set(records: DataFrame, lookups: list[FeatureLookup] | None = None) -> DataFrame:
    """Training columns with looked-up features, the key kept for the split."""
    return features.create_training_set(
        features.training_base(records), lookups or payment_lookups(records)
    )


def audit_scored(scored: DataFrame, run_id: str, protected: Protected = PROTECTED) -> dict[str, DataFrame]:
    """Fairness, performance, trade-off and conclusion of scored rows."""
    counted = fair.cells(scored, protected)
    gaps = fair.fairness_metrics(fair.by_group(counted, protected))
    long = fair.fairness_long(gaps.withColumn("model_run_id", F.lit(run_id)))
    binned = scored.withColumn("score", probability_bins(F.col("probability")))
    return {
        "fairness": long,
        "performance": performance.performance_intervals(counted, protected),
        "tradeoff": tradeoff(binned, protected),
        "conclusion": fair.fair_conclusion(long),
    }


def train_and_audit(
    records: DataFrame,
    run_id: str,
    lookups: list[FeatureLookup] | None = None,
    protected: Protected = PROTECTED,
) -> Audit:
    """Split, train on the larger part, score and audit the test part.

    The training set is stored once below the shared folder: training, scoring
    and every audit read it from there instead of repeating the lookups.
    """
    spark = records.sparkSession
    path = scratch_path(spark, "training_set")
    tables.overwrite(model.split(training_set(records, lookups)), path, ["split"])
    data = tables.read(spark, path)
    inputs = [c for c in data.columns if c not in (KEY, LABEL, PREDICTION, "split")]
    fitted = model.train(data.where(F.col("split") == "train"), inputs)
    scored = model.score(fitted, data.where(F.col("split") == "test"))
    return Audit(fitted, scored, **audit_scored(scored, run_id, protected))
