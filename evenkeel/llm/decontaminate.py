"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of all test items go into a Bloom filter of fixed size. One pass over
the training texts keeps the passages around n-grams that pass it, with a margin as
long as the longest item, so no text is read again. Each n-gram's passages are then
counted over all texts, and n-grams that are common for their item are no seeds; only
seeds join passages to items. Every passage and item that share a seed are aligned word by word,
which also scores copies with words changed, left out or put in.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import bloom
from evenkeel.llm.scratch import discard, save
from evenkeel.llm.text import batched, rows, runs, word_hashes

# A-Z in lower case, punctuation and control characters to spaces.
_FOLD = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
# Seeds (two numbers each) and bytes of items that are broadcast; more are shuffled.
_FEW = 1 << 19
_SMALL = 1 << 24


@dataclass(frozen=True)
class Alignment:
    """Scores of a word pair and a word left out; ``share`` of a perfect score that counts.

    ``words`` is the length of a seed; ``common`` times the median frequency of an
    item's n-grams is the most a seed may have.
    """

    words: int = 5
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    share: float = 0.5
    common: int = 4


def _words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def align(x: np.ndarray, y: np.ndarray, a: Alignment) -> tuple[int, int, int]:
    """Best local alignment of word hashes x in y: score, first word and end in y."""
    score, end = _best(x, y, a)
    if not score:
        return 0, 0, 0
    _, back = _best(x[::-1], y[:end][::-1], a)
    return score, end - back, end


def _best(x: np.ndarray, y: np.ndarray, a: Alignment) -> tuple[int, int]:
    ramp = np.arange(len(y) + 1, dtype=np.int64) * -a.gap
    row = np.zeros(len(y) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in x:
        new = np.maximum(row + a.gap, 0)
        np.maximum(new[1:], row[:-1] + np.where(y == word, a.match, a.mismatch), out=new[1:])
        # A run of gaps along the row, from the best place before.
        row = np.maximum.accumulate(new + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def contaminated(docs: DataFrame, benchmark: DataFrame, alignment: Alignment = Alignment()) -> DataFrame:
    """``(doc_id, item_id, score, start, end)``: each document with each item it contains.

    ``score`` is the best alignment's share of a perfect one, at least
    ``alignment.share``; ``start`` and ``end`` count the document's words. A null or
    blank text or item contains and is found nowhere; items shorter than a seed are
    found by all their words. A passage with several items gives a row for each.
    Of equal scores in one document the first place counts, then the longest.
    Repeated rows count once; a very long text is cut into its passages. docs: ``doc_id, text``;
    benchmark: ``item_id, text``; other columns are not read.
    """
    spark = docs.sparkSession
    items = save(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary"))
        .distinct()
        .mapInArrow(_items(alignment), "item_id long, words binary, size int, grams array<long>")
        .withColumn("item", F.xxhash64("item_id", "words")),
        "items",
    )
    sizes, longest = items.agg(
        F.collect_set(F.least("size", F.lit(alignment.words))), F.max("size")
    ).first()
    grams = items.select("item", F.explode("grams").alias("gram")).distinct()
    held = spark.sparkContext.broadcast(bloom.build(grams, F.col("gram")))

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    passages = save(
        texts.mapInArrow(
            _passages(held, sorted(sizes or ()), longest or 0),
            "doc_id long, start long, words binary, grams array<long>",
        )
        .withColumn("passage", F.xxhash64("doc_id", "start", "words")),
        "passages",
    )
    # How many passages hold a gram is known before any passage meets an item.
    held_grams = passages.select("passage", F.explode("grams").alias("gram")).distinct()
    found = save(
        held_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("passages")).join(grams, "gram"), "found"
    )
    usual = found.groupBy("item").agg(F.percentile_approx("passages", 0.5).alias("usual"))
    seeds = save(
        found.join(usual, "item")
        .where(F.col("passages") <= F.col("usual") * alignment.common)
        .select("gram", "item"),
        "seeds",
    )
    few = seeds.limit(_FEW + 1).count() <= _FEW
    pairs = held_grams.join(F.broadcast(seeds) if few else seeds, "gram").select("passage", "item")
    wanted = items.select("item", "item_id", F.col("words").alias("wanted"))
    small = (items.agg(F.sum(F.octet_length("words") + 32)).first()[0] or 0) <= _SMALL
    sides = (
        pairs.distinct()
        .join(passages.select("passage", "doc_id", "start", "words"), "passage")
        .dropDuplicates(["passage", "item"])
        .join(F.broadcast(wanted) if small else wanted, "item")
        .select("doc_id", "start", "words", "item_id", "wanted")
    )
    aligned = save(
        sides.mapInArrow(
            _aligned(alignment), "doc_id long, item_id long, score double, start long, end long"
        ),
        "aligned",
    )
    for table in (items, passages, found, seeds):
        discard(table)
    held.destroy()
    best = F.max(F.struct("score", -F.col("start"), F.col("end")))
    return (
        aligned.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.score").alias("score"),
            (-F.col("best.col2")).alias("start"),
            F.col("best.end").alias("end"),
        )
    )


def _items(a: Alignment) -> Callable:
    schema = pa.schema(
        [("item_id", pa.int64()), ("words", pa.binary()), ("size", pa.int32()), ("grams", pa.list_(pa.int64()))]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for item_id, text in rows(batches):
            if words := _words(text):
                grams = np.unique(runs(word_hashes(words), a.words)).view(np.int64)
                yield item_id, b" ".join(words), len(words), grams

    return lambda batches: batched(found(batches), schema)


def _passages(held, sizes: list[int], margin: int) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("words", pa.binary()), ("grams", pa.list_(pa.int64()))]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in rows(batches):
            words = _words(text)
            hashes = word_hashes(words)
            places, grams = [], []
            for size in sizes:
                if len(words) >= size:
                    own = runs(hashes, size)
                    at = np.flatnonzero(bloom.might_hold(held.value, own))
                    places.append(at)
                    grams.append(own[at])
            if not places or not sum(map(len, places)):
                continue
            at, gram = np.concatenate(places), np.concatenate(grams)
            order = np.argsort(at, kind="stable")
            at, gram = at[order], gram[order]
            # Hits with no more than two margins between them share a passage.
            cuts = np.flatnonzero(np.diff(at) > 2 * margin) + 1
            for group, own in zip(np.split(at, cuts), np.split(gram, cuts)):
                start = max(0, int(group[0]) - margin)
                end = int(group[-1]) + max(sizes) + margin
                yield doc_id, start, b" ".join(words[start:end]), np.unique(own).view(np.int64)

    return lambda batches: batched(found(batches), schema)


def _aligned(a: Alignment) -> Callable:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("item_id", pa.int64()),
            ("score", pa.float64()),
            ("start", pa.int64()),
            ("end", pa.int64()),
        ]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, start, words, item_id, wanted in rows(batches):
            x, y = word_hashes(wanted.split()), word_hashes(words.split())
            score, first, end = align(x, y, a)
            share = score / (a.match * len(x))
            if share >= a.share:
                yield doc_id, item_id, share, start + first, start + end

    return lambda batches: batched(found(batches), schema)
