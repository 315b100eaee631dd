"""Line dedup with compressed keep bitmaps, in DataFrame functions only.

Lines become hashes with their document and position. The hashes are range
partitioned and sorted by document and position, and a running first value names
the document in which a line occurred first; all its lines elsewhere go. A hash
range that holds many rows is cut further by document, and the first documents
of its cuts are brought together, so a line that stands in very many documents
is no single task. The result per document is its keep bitmap as run lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.scratch import discard, save
from evenkeel.llm.spans import dropped_runs, without
from evenkeel.llm.text import WHITESPACE, lower_ascii

# Hash ranges whose rows are counted: at most so many, whatever the input.
_RANGE_BITS = 16


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITESPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, least: int = 10, range_rows: int = 20_000) -> DataFrame:
    """``(doc_id, print, n_dropped, dropped)`` of documents that lose lines.

    ``dropped`` is the keep bitmap in compressed form: its runs of zeros as
    ``(start, length)`` by start, positions from 0; all other lines stay. A line
    counts by its key (white space stripped at both ends, A-Z lower-cased) if that
    has ``least`` code points or more; it stays in the smallest ``doc_id`` that
    holds it, there each time. ``print`` is a hash of the text, to tell apart rows
    that repeat a ``doc_id``. A row without id counts as the largest id.
    docs: ``doc_id`` and ``text``.
    """
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    key = line_key(F.col("line"))
    lines = (
        docs.select(own.alias("doc"), F.xxhash64("text").alias("print"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
        .withColumn("key", key)
        .where(F.char_length("key") >= least)
        .select("doc", "print", "at", F.xxhash64("key").alias("high"), F.xxhash64(F.lit(1), "key").alias("low"))
    )
    lines = save(lines, "lines")
    lines = lines.withColumn("range", F.shiftright("high", 64 - _RANGE_BITS))

    # A range with more rows than one task should sort, and more than the usual
    # range, is cut by document.
    usual = max(range_rows, 2 * lines.count() >> _RANGE_BITS)
    cuts = (
        lines.groupBy("range").count()
        .select("range", F.ceil(F.col("count") / usual).alias("cuts"))
        .where("cuts > 1")
    )
    # At most 2**16 rows.
    cut = lines.join(F.broadcast(cuts), "range", "left").withColumn(
        "cut", F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("doc"), F.col("cuts"))).otherwise(0)
    )
    in_order = Window.partitionBy("high", "low", "cut").orderBy("doc", "at")
    ranged = cut.repartitionByRange("high", "low", "cut").withColumn(
        "first", F.first("doc").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    ranged = save(ranged.select("doc", "print", "at", "high", "low", "cuts", "first"), "ranged")
    discard(lines)
    settled = ranged.where("cuts is null and doc > first").select("doc", "print", "at")
    heavy = ranged.where("cuts is not null")
    firsts = (
        heavy.groupBy("high", "low").agg(F.min("first").alias("least"), F.max("doc").alias("most"))
        .where("least < most")
    )
    split = heavy.join(firsts, ["high", "low"]).where("doc > least").select("doc", "print", "at")

    return dropped_runs(settled.union(split).distinct()).withColumnRenamed("doc", "doc_id")


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines outside the dropped runs, joined; a null text is empty."""
    kept = F.array_join(without(_lines(text), dropped), "\n")
    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(kept)


def deduplicated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept)``, a row for each row of ``docs``.

    ``kept`` is the text without the dropped lines; see ``keep_bitmaps``. Null and
    empty texts have one empty line.
    """
    bitmaps = save(keep_bitmaps(docs, least), "bitmaps").withColumnRenamed("doc_id", "doc")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    texts = docs.select(F.col("doc_id").cast("long"), "text", own.alias("doc"), F.xxhash64("text").alias("print"))
    return texts.join(bitmaps.hint("shuffle_hash"), ["doc", "print"], "left").select(
        "doc_id",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(F.col("text"), F.col("dropped")).alias("kept"),
    )
