"""Positions dropped from a text, as runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dropped_runs(gone: DataFrame) -> DataFrame:
    """``(doc, print, n_dropped, dropped)`` from distinct positions ``(doc, print, at)``.

    ``dropped`` holds the runs of neighbouring positions as ``(start, length)``.
    """
    stretch = F.col("at") - F.row_number().over(Window.partitionBy("doc", "print").orderBy("at"))
    return (
        gone.withColumn("stretch", stretch)
        .groupBy("doc", "print", "stretch")
        .agg(F.min("at").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))
        .groupBy("doc", "print")
        .agg(
            F.sum("length").cast("long").alias("n_dropped"),
            F.array_sort(F.collect_list(F.struct("start", "length"))).alias("dropped"),
        )
    )


def without(parts: Column, dropped: Column) -> Column:
    """The array ``parts`` without its dropped runs."""
    ends = F.transform(dropped, lambda run: run["start"] + run["length"])
    starts = F.concat(F.array(F.lit(0)), ends)
    stops = F.concat(F.transform(dropped, lambda run: run["start"]), F.array(F.size(parts)))
    return F.flatten(
        F.zip_with(starts, stops, lambda start, stop: F.slice(parts, start + 1, stop - start))
    )
