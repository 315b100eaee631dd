"""New batches arriving as a stream of files, scored and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from evenkeel.plans.monitor import Monitor


def stream_new_data(
    monitor: Monitor,
    source: str,
    schema: T.StructType,
    as_of: str,
    checkpoint: str,
    name: str = "stream",
    fmt: str = "parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every file below ``source`` once, then stop.

    A micro-batch replaces the partition named after it, so a batch repeated
    after a failure leaves the same rows. ``as_of`` is fixed for the same reason.
    """
    reader = monitor.spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        monitor.add_new_data(batch, as_of=as_of, load_id=f"{name}-{batch_id:08d}")

    return (
        reader.load(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
