"""The life of a monitored table: baseline, new batches, windows, reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel import schemas
from evenkeel.config import DATE, KEY, LABEL, ColumnRoles, Window
from evenkeel.operators import distribution as dist
from evenkeel.operators import drift, prepare, quality
from evenkeel.operators.joins import attach_label
from evenkeel.plans.registry import Features, Registry
from evenkeel.sources import tables

LOAD = "load_id"
Scorer = Callable[[DataFrame], DataFrame]


def clean_credit(df: DataFrame) -> DataFrame:
    """Records with a marriage class are cleaned, others stay as they are."""
    return prepare.clean(df) if "MARRIAGE" in df.columns else df


class Monitor:
    """A monitoring table partitioned by date and load.

    ``scorer`` turns a frame into the same rows with a prediction; it is handed
    unlabelled or labelled frames alike and leaves the label alone. ``clean`` is
    applied to every frame before. With ``roles``, each load also stores how often the
    values of their columns occur, and reports can be made from these counts.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        project: str,
        model: str,
        scorer: Scorer | None = None,
        key: str = KEY,
        label: str = LABEL,
        date_column: str = DATE,
        clean: Scorer = clean_credit,
        roles: ColumnRoles | None = None,
    ):
        self.spark = spark
        self.root = root
        self.project = project
        self.model = model
        self.scorer = scorer
        self.key = key
        self.label = label
        self.date_column = date_column
        self.clean = clean
        self.roles = roles
        self.schema = None
        self.path = f"{root}/{project}_monitoring/{model}"
        self.summary_path = f"{self.path}_summary"

    @property
    def _partitions(self) -> list[str]:
        return [self.date_column, LOAD]

    def _scored(self, df: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Cleaned and scored rows with their label.

        Every batch is cleaned like the training data; raw classes in new data
        alone would look like drift. The label of a row passes through the scorer.
        Only labels that arrive as a frame of their own are joined by key.
        """
        if self.scorer is None:
            raise ValueError("this monitor has no scorer")
        df = self.clean(df)
        if labels is None:
            return self.scorer(df)
        unlabelled = df.drop(self.label) if self.label in df.columns else df
        return attach_label(self.scorer(unlabelled), labels, self.label, self.key)

    def _stamped(self, df: DataFrame, as_of: str | Column | None, load_id: str) -> DataFrame:
        stamped = prepare.stamp(df, self.project, self.model, as_of, self.date_column)
        return stamped.withColumn(LOAD, F.lit(load_id))

    def register_baseline(
        self,
        data: DataFrame | str,
        score: bool = True,
        labels: DataFrame | None = None,
        as_of: str | Column | None = None,
        load_id: str = "baseline",
    ) -> str:
        """Replace the table by the training data of the model, scored or as it is.

        ``data`` is a frame or a lineage tag naming one or more tables.
        """
        df = tables.read_lineage(self.spark, data) if isinstance(data, str) else data
        prepare.guard_column(df, self.date_column)
        rows = self._scored(df, labels) if score else df
        stamped = self._stamped(rows, as_of, load_id)
        self.schema = stamped.schema
        tables.overwrite(stamped, self.path, self._partitions)
        if self.roles:
            tables.overwrite(self._summary(load_id), self.summary_path, self._partitions)
        return self.path

    def register_model_baseline(
        self,
        registry: Registry,
        stage: str = "Staging",
        add_features: Features | None = None,
        as_of: str | Column | None = None,
        load_id: str = "baseline",
    ) -> str:
        """Replace the table by the data that the model's version for ``stage`` was trained on.

        Version, run and source data come from the registry; the version's scorecard
        scores the baseline and from then on every new batch.
        """
        chosen = registry.chosen(self.model, stage)
        self.scorer = registry.scorer(self.model, stage, add_features)
        return self.register_baseline(chosen.source_data, as_of=as_of, load_id=load_id)

    def _summary(self, load_id: str) -> DataFrame:
        """Value counts of a load, from its own partitions."""
        rows = self.read().where(F.col(LOAD) == load_id)
        return dist.summarize(rows, self.roles, self._partitions)

    def add_new_data(
        self,
        df: DataFrame,
        labels: DataFrame | None = None,
        as_of: str | Column | None = None,
        load_id: str | None = None,
    ) -> int:
        """Score, stamp and append a batch; returns the number of rows added.

        A batch with an explicit ``load_id`` may be repeated after a failure: it
        replaces all that the load wrote earlier, for whatever date; a repeat
        without rows leaves nothing of it. Columns known from the table are cast
        to its types; new ones are allowed. The count comes from the file footers
        of the load's own partitions, not from a second run of the scorer.
        """
        load_id = load_id or f"load-{uuid.uuid4().hex[:12]}"
        rows = self._cast_known(self._scored(df, labels))
        written = self._replace(self._stamped(rows, as_of, load_id), self.path, load_id)
        if self.roles:
            self._replace(self._summary(load_id), self.summary_path, load_id)
        return self.spark.read.parquet(*written).count() if written else 0

    def _replace(self, df: DataFrame, path: str, load_id: str) -> list[str]:
        """Write a load's partitions; returns their folders."""
        earlier = tables.partition_files(self.spark, path, LOAD, load_id)
        tables.replace_partitions(df, path, self._partitions)
        written = tables.partition_files(self.spark, path, LOAD, load_id)
        # What the write left alone belongs to the load's earlier run.
        for folder in [f for f, files in written.items() if files == earlier.get(f)]:
            tables.remove_folder(self.spark, folder)
            del written[folder]
        return list(written)

    def _cast_known(self, df: DataFrame) -> DataFrame:
        if self.schema is None:
            self.schema = self.read().schema
        known = {f.name: f.dataType for f in self.schema.fields}
        return df.withColumns(
            {c: F.col(c).cast(known[c]) for c in df.columns if c in known}
        )

    def schema_changes(self, df: DataFrame) -> dict[str, list[str]]:
        """How a batch differs from the registered schema."""
        stamps = {self.date_column, LOAD, "project_name", "model_name"}
        fields = [f for f in (self.schema or self.read().schema).fields if f.name not in stamps]
        return schemas.compare(type(df.schema)(fields), df.schema)

    def read(self) -> DataFrame:
        return tables.read(self.spark, self.path, merge_schema=True)

    def _check(self, df: DataFrame, windows: tuple[Window, ...]) -> None:
        for window in windows:
            if prepare.within(df, window, self.date_column).isEmpty():
                raise ValueError(f"no rows strictly between {window.start} and {window.end}")

    def tagged(
        self,
        reference: Window,
        production: Window,
        sample_fraction: float = 1.0,
        allow_empty: bool = False,
    ) -> DataFrame:
        """Rows of both windows with flags; only their partitions are read.

        An empty slice is an error unless ``allow_empty``; drift scores are null
        then.
        """
        rows = self.read()
        if not allow_empty:
            self._check(rows, (reference, production))
        both = prepare.tag_windows(rows, reference, production, self.date_column)
        return prepare.sample_rows(both, sample_fraction, self.key)

    def tagged_summary(
        self, reference: Window, production: Window, allow_empty: bool = False
    ) -> dist.Summary:
        """What ``tagged`` gives, from the stored value counts: no row of the table is read."""
        if not self.roles:
            raise ValueError("this monitor stores no value counts; give it roles")
        counts = tables.read(self.spark, self.summary_path)
        if not allow_empty:
            self._check(counts, (reference, production))
        both = prepare.tag_windows(counts, reference, production, self.date_column)
        return dist.Summary(both, self.roles.columns)

    def slices(
        self,
        reference: Window,
        production: Window,
        sample_fraction: float = 1.0,
        allow_empty: bool = False,
    ) -> tuple[DataFrame, DataFrame]:
        """The reference and the production rows as two frames."""
        rows = self.read()
        if not allow_empty:
            self._check(rows, (reference, production))
        first, second = (
            prepare.sample_rows(
                prepare.within(rows, window, self.date_column), sample_fraction, self.key
            )
            for window in (reference, production)
        )
        return first, second

    def _output(self, name: str) -> str:
        return f"{self.root}/{self.project}_monitoring/{self.model}_{name}"

    def save_dataset_drift(
        self, tagged: DataFrame | dist.Summary, roles: ColumnRoles, as_of: str | None = None, method: str = "test"
    ) -> str:
        rows = drift.dataset_drift(tagged, roles, self.project, self.model, as_of, method)
        tables.append(rows, self._output("dataset_drift"), schema=schemas.DATASET_DRIFT)
        return self._output("dataset_drift")

    def save_label_drift(
        self, tagged: DataFrame | dist.Summary, roles: ColumnRoles, as_of: str | None = None, method: str = "test"
    ) -> str:
        rows = drift.label_drift(tagged, roles, self.project, self.model, as_of, method)
        tables.append(rows, self._output("label_drift"), schema=schemas.LABEL_DRIFT)
        return self._output("label_drift")

    def save_quality(
        self, tagged: DataFrame | dist.Summary, roles: ColumnRoles, as_of: str | None = None
    ) -> str:
        rows = quality.quality_profile(tagged, roles)
        stamped = prepare.stamp(rows, self.project, self.model, as_of, "date")
        tables.append(stamped, self._output("dataset_quality"))
        return self._output("dataset_quality")

    def save_quality_table(
        self, tagged: DataFrame | dist.Summary, roles: ColumnRoles, table: str, as_of: str | None = None
    ) -> str:
        """Append the quality profile to a catalog table."""
        rows = quality.quality_profile(tagged, roles)
        tables.append_catalog(prepare.stamp(rows, self.project, self.model, as_of, "date"), table)
        return table
