"""Models by name and stage: their versions, runs, scorecards and scorers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from evenkeel.operators import scorecard, versions

Features = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Registry:
    """Tables of model versions and runs (see ``versions``), and the folder of scorecards."""

    versions: DataFrame
    runs: DataFrame
    scorecards: str

    def chosen(self, model_name: str, stage: str = "Staging") -> Row:
        """The version, run and source data behind a model's stage."""
        own = self.versions.where(F.col("model_name") == model_name)
        found = versions.run_of_model(own, self.runs, stage).take(2)
        if len(found) != 1:
            raise ValueError(f"{model_name} has {len(found) or 'no'} run(s) for stage {stage}")
        return found[0]

    def scorer(self, model_name: str, stage: str = "Staging", add_features: Features | None = None) -> Features:
        """What scores a frame of records with the chosen version's scorecard.

        ``add_features`` brings in what the records lack: a projection over the records
        at hand, or a lookup of feature tables.
        """
        version = self.chosen(model_name, stage).version
        card = scorecard.load(self.versions.sparkSession, self.scorecards, model_name, version)

        def scored(df: DataFrame) -> DataFrame:
            return scorecard.score(add_features(df) if add_features else df, card)

        return scored
