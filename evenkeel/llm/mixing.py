"""Mixing sources to target weights.

Each document gets a hash-random key. Within its source the documents are ordered
by key and taken until their words fill the source's budget exactly; a budget over
the source's size repeats the whole source first. The order is cut into key ranges:
range totals give the words before each range, so no source is ever ordered in one
task, and as keys are uniform all ranges have about the same number of rows. The
result does not depend on the number of ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.scratch import save
from evenkeel.llm.text import WORD, word_count

_KEY_BITS = 60


@dataclass(frozen=True)
class Mix:
    """Sources in order of their names, null last, weigh ``weights`` in turn.

    No source is asked for more than ``most`` times its size. ``range_rows`` is
    about how many documents one key range holds.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    range_rows: int = 8192


def targets(totals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` per source.

    Targets share the size of all sources by weight; what a source cannot give is
    shared anew among the others. With sources by rising size per weight, the ones
    at their limit come first, and the final words per unit of weight are the
    largest that any split point yields.
    """
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("rank") % len(mix.weights) + 1).cast("int")),
    )
    by_limit = Window.orderBy(F.col("source_size") * mix.most / F.col("weight"), "rank")
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    later = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unit = (
        F.sum("source_size").over(everything)
        - mix.most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    ) / F.sum("weight").over(later)
    return (
        ranked.withColumn("unit", unit)
        .withColumn("unit", F.max("unit").over(everything))
        .select(
            "source",
            "source_size",
            F.least(
                (F.col("source_size") * mix.most).cast("double"), F.col("unit") * F.col("weight")
            ).alias("target"),
        )
    )


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, a row for each row of ``docs``.

    ``taken`` counts the words that the mix takes from a document, repeats
    included; of the document in which the budget ends, only its first words.
    A null or blank text has size 0 and gives nothing; a null source is a source.
    Equal keys go by ``doc_id`` and size. docs: ``doc_id, text, source``.
    """
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, _KEY_BITS // 4)
    sized = save(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            word_count(F.col("text")).alias("size"),
            F.conv(digits, 16, 10).cast("long").alias("key"),
        ),
        "sized",
    )
    ranges = max(0, (sized.count() // mix.range_rows).bit_length())
    sized = sized.withColumn("range", F.shiftrightunsigned("key", _KEY_BITS - ranges))
    totals = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    previous = (
        Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        F.col("source").alias("of"),
        F.col("range").alias("at"),
        F.coalesce(F.sum("words").over(previous), F.lit(0)).alias("offset"),
    )
    shares = targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), mix
    ).withColumnRenamed("source", "named")
    within = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = (
        sized.withColumn("inside", F.sum("size").over(within) - F.col("size"))
        .join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
        .join(shares, F.col("source").eqNullSafe(F.col("named")))
    )
    before = F.col("offset") + F.col("inside")
    asked = F.floor("target").cast("long")
    rest = asked % F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return running.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("source_size") == 0, F.lit(0))
        .otherwise(F.col("size") * F.floor(asked / F.col("source_size")) + part)
        .cast("long")
        .alias("taken"),
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: documents with a column ``copy``, whole copies first.

    The copy in which a source's budget ends holds only the first words of its
    text. Documents that give nothing are absent. ``doc_id`` must tell documents
    apart; rows without one are left out.
    """
    # Names that documents are unlikely to have; a column ``copy`` is replaced.
    size, part = F.col("mix__size"), F.col("mix__taken")
    taken = (
        mixture(docs, mix)
        .where("taken > 0")
        .select("doc_id", F.col("size").alias("mix__size"), F.col("taken").alias("mix__taken"))
        .distinct()
    )
    copies = docs.join(taken, "doc_id").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.ceil(part / size).cast("int")))
    )
    words = (part - (F.col("copy") - 1) * size).cast("int")
    spaced = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.when(words >= size, F.col("text")).otherwise(
        F.array_join(F.slice(spaced, F.lit(1), words), "")
    )
    return copies.withColumn("text", cut).drop("mix__size", "mix__taken")
