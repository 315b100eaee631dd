"""Intermediate tables in the shared folder, so that a lost executor costs no lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from evenkeel.session import scratch_path

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def save(df: DataFrame, name: str, batch: int = 256) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Python functions in ``df`` get ``batch`` rows at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Shuffle files go as soon as the table is complete; texts reach Python in
    # batches of so few rows that long ones fit in memory.
    with settings(spark, {_CLEANUP: "true", _BATCH: str(batch)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``save`` returned."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
