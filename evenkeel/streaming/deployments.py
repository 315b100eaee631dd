"""Deployment events arriving as files of JSON lines, kept once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from evenkeel import schemas
from evenkeel.sources import tables

BATCH = "batch"
LINE = "event_message"
Gate = Callable[[DataFrame], DataFrame]


def _lines(spark: SparkSession, source: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    event = F.from_json("value", schemas.DEPLOYMENT_EVENT)
    return reader.load(source).select(F.col("value").alias(LINE), event.alias("event"))


_NEEDED = ("event_id", "event_ts", "model_name")


def _lacking() -> Column:
    """The fields an event needs and a line lacks; all of them if it is no JSON."""
    return F.array_compact(F.array(*[F.when(F.col(f"event.{c}").isNull(), c) for c in _NEEDED]))


def stream_history(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    gate: Gate,
    watermark: str = "7 days",
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every event below ``source`` to the deployment history once, then stop.

    An event that comes again, by ``event_id`` and within ``watermark`` of its first
    coming, is dropped; the state holds the ids of that span only. An event that comes
    later than the watermark allows is dropped too. ``gate`` turns events (column
    ``event_message``) into history rows. A micro-batch replaces the partition named
    after it, so one that is repeated after a failure leaves the same rows.
    """
    events = (
        _lines(spark, source, max_files)
        .where(F.size(_lacking()) == 0)
        .select(LINE, "event.event_id", "event.event_ts")
        .withWatermark("event_ts", watermark)
        .dropDuplicatesWithinWatermark(["event_id"])
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        # The gate looks at the events more than once.
        held = batch.select(LINE).persist()
        try:
            tables.replace_partitions(gate(held).withColumn(BATCH, F.lit(batch_id)), path, [BATCH])
        finally:
            held.unpersist()

    return (
        events.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_quarantine(
    spark: SparkSession, source: str, path: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Keep the lines that are no event, with the reason, in a table of their own, then stop."""
    reason = F.concat(F.lit("lacks "), F.array_join(_lacking(), ", "))
    return (
        _lines(spark, source, max_files)
        .where(F.size(_lacking()) > 0)
        .select(LINE, reason.alias("reason"))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The deployment history that the stream has written so far."""
    return schemas.conform(tables.read(spark, path), schemas.DEPLOYMENT_HISTORY)
