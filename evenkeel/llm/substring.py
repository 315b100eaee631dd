"""Substring dedup over sliding spans of sentences.

Every run of consecutive sentences that holds enough words is hashed. A task knows
which runs its documents repeat among themselves, so a run goes to the others once for
each batch of documents; ordered by hash and place they show each run's first place.
The sentences of every other place are covered, and covered stretches of enough words
are removed. A long sentence is cut behind words that their own
characters mark, so that a passage is found wherever foreign text is glued to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.scratch import save, settings
from evenkeel.llm.text import batched, folded_words, rows, word_hashes

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
_STEPS = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_MIX = np.uint64(0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Spans:
    """Which runs count.

    A sentence of more than ``longest`` words is cut behind each word whose characters'
    code points, A-Z lower-cased, add up to a multiple of ``cut_every``. A run closes
    with the sentence that brings it to ``run_words``; a covered stretch goes if it
    holds ``least_words``.
    """

    longest: int = 8
    cut_every: int = 4
    run_words: int = 20
    least_words: int = 30


@dataclass(frozen=True)
class Sentences:
    """Sentences of a text: ends as word numbers and as byte offsets, and word hashes."""

    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    @property
    def words(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def sentences(text: bytes, rule: Spans) -> Sentences:
    """A sentence ends behind a word that ends in ``.``, ``!`` or ``?``, and at a line end.

    White space behind a sentence belongs to it, that at the start to the first one.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    stops = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    if not len(starts):
        none = np.empty(0, dtype=np.int64)
        return Sentences(none, none, none.astype(np.uint64))
    nexts = np.append(starts[1:], len(raw))
    lines = np.cumsum(raw == ord("\n"))
    closes = _STOP[raw[stops - 1]] | (lines[nexts - 1] > lines[stops - 1])
    number = np.cumsum(closes) - closes
    long = np.bincount(number) > rule.longest
    points = np.frombuffer(text.lower().decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    # Offsets in characters: bytes that continue a character do not count.
    place = np.cumsum((raw & 0xC0) != 0x80) - 1
    running = np.append(0, np.cumsum(points))
    sums = running[place[stops - 1] + 1] - running[place[starts]]
    closes |= long[number] & (sums % rule.cut_every == 0)
    closes[-1] = True
    at = np.flatnonzero(closes)
    return Sentences(at + 1, nexts[at], word_hashes(folded_words(text)))


def _powers(step: int, count: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(count, step, dtype=np.uint64)), dtype=np.uint64)[: count + 1]


def _runs(found: Sentences, rule: Spans) -> tuple[np.ndarray, ...]:
    """First sentence, number of sentences and two hashes of each run."""
    before = found.ends - found.words
    last = np.searchsorted(found.ends, before + rule.run_words)
    at = np.flatnonzero(last < len(found.ends))
    start, stop = before[at], found.ends[last[at]]
    keys = []
    for step in _STEPS:
        # A polynomial of the words; dividing by the step's power moves a run to its start.
        mixed = found.hashes ^ (found.hashes >> np.uint64(31)) * np.uint64(step)
        total = np.append(np.uint64(0), np.cumsum(mixed * _powers(step, len(mixed))[:-1], dtype=np.uint64))
        key = (total[stop] - total[start]) * _powers(pow(step, -1, 1 << 64), len(mixed))[start]
        key ^= key >> np.uint64(32)
        keys.append(key * _MIX)
    # 96 bits tell runs apart.
    return at, last[at] - at + 1, keys[0].view(np.int64), (keys[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


_RUN = "high long, low int, doc long, print long, at int, length int"
_RUN_ARROW = pa.schema(
    [("high", pa.int64()), ("low", pa.int32()), ("doc", pa.int64()), ("print", pa.int64()),
     ("at", pa.int32()), ("length", pa.int32())]
)


def _listed(rule: Spans):
    """Runs of a batch of documents, each once: with its hash at the batch's first place.

    At its other places it cannot be the first of all. These are merged to covered
    stretches, with a negative length and a hash of their own.
    """

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = {(doc, mark): text for doc, mark, text in rows([batch])}
            parts: list[tuple] = []
            for number, key in enumerate(sorted(texts)):
                at, length, high, low = _runs(sentences(texts[key], rule), rule)
                doc, mark = (np.full(len(at), value) for value in key)
                parts.append((high, low, doc, mark, at, length, np.full(len(at), number)))
            if not parts:
                continue
            high, low, doc, mark, at, length, number = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((low, high))
            same = np.append(False, (np.diff(high[order]) == 0) & (np.diff(low[order]) == 0))[: len(order)]
            again = np.sort(order[same])
            # Runs of a document end in the order in which they begin.
            stop = at + length
            fresh = np.append(True, (np.diff(number[again]) != 0) | (at[again][1:] > stop[again][:-1]))[: len(again)]
            first = again[fresh]
            last = again[np.append(fresh[1:], True)[: len(again)]]
            own = (doc[first] ^ mark[first]) * np.int64(_STEPS[1] >> 1) + at[first]
            kept = order[~same]
            columns = [
                np.append(high[kept], own),
                np.append(low[kept], np.zeros(len(first), dtype=np.int32)),
                *(np.append(c[kept], c[first]) for c in (doc, mark, at)),
                np.append(length[kept], at[first] - stop[last]),
            ]
            arrays = [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, _RUN_ARROW)]
            yield from pa.Table.from_arrays(arrays, schema=_RUN_ARROW).to_batches(max_chunksize=1 << 15)

    return made


def _later(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All places of a run but its first, from rows ordered by hash and place, and covered stretches."""
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        length = batch.column(5).to_numpy()
        plain = length > 0
        columns = [c.to_numpy()[plain] for c in batch.columns[:5]]
        away = np.zeros(int(plain.sum()), dtype=bool)
        if len(away):
            if carried is not None:
                columns = [np.append(first, c) for first, c in zip(carried, columns)]
            same = (np.diff(columns[0]) == 0) & (np.diff(columns[1]) == 0)
            start = np.maximum.accumulate(np.where(np.append(False, same), 0, np.arange(len(columns[0]))))
            differs = np.zeros(len(start), dtype=bool)
            for column in columns[2:]:
                differs |= column != column[start]
            carried = [c[start[-1]] for c in columns]
            away = differs[-len(away) :]
        gone = ~plain
        gone[plain] = away
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(3), batch.column(4), pa.array(np.abs(length))],
            names=["doc", "print", "at", "length"],
        ).filter(pa.array(gone))


def _prepared(docs: DataFrame) -> DataFrame:
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return docs.select(
        F.col("doc_id").cast("long"), own.alias("doc"), F.xxhash64("text").alias("print"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def covered_sentences(docs: DataFrame, rule: Spans = Spans()) -> DataFrame:
    """``(doc, print, covered)``: stretches ``(at, length)`` of sentences in repeated runs.

    The first place of a run is that with the smallest ``doc_id``, then text hash, then
    position; runs compare by their words with A-Z lower-cased. A row without id
    counts as the largest id; ``print`` is a hash of the text, to tell apart rows that
    repeat an id; repeated rows of id and text are one document. Stretches are ordered
    and may overlap. docs: ``doc_id`` and ``text``.
    """
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 24)}):
        later = (
            _prepared(docs)
            .select("doc", "print", "text")
            .mapInArrow(_listed(rule), _RUN)
            .repartition("high")
            .sortWithinPartitions("high", "low", "doc", "print", "at")
            .mapInArrow(_later, "doc long, print long, at int, length int")
        )
        stretches = F.array_sort(F.collect_list(F.struct("at", "length")))
        return save(later.groupBy("doc", "print").agg(stretches.alias("covered")), "covered", batch=4096)


def _stretches(covered: Iterable[dict]) -> Iterator[tuple[int, int]]:
    """Ordered stretches merged where they touch or overlap, as first sentence and end."""
    first = stop = None
    for part in covered:
        if first is not None and part["at"] <= stop:
            stop = max(stop, part["at"] + part["length"])
            continue
        if first is not None:
            yield first, stop
        first, stop = part["at"], part["at"] + part["length"]
    if first is not None:
        yield first, stop


def _cut(rule: Spans):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.binary())]
    )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, covered in rows(batches):
            found = sentences(text, rule)
            starts = np.append(0, found.offsets)
            words = np.append(0, found.ends)
            kept, last, gone = [], 0, 0
            for first, stop in _stretches(covered or ()):
                if words[stop] - words[first] >= rule.least_words:
                    kept.append(text[last : starts[first]])
                    last = starts[stop]
                    gone += stop - first
            kept.append(text[last:])
            yield doc_id, len(found.ends), gone, b"".join(kept)

    return lambda batches: batched(made(batches), schema)


def deduplicated_spans(docs: DataFrame, rule: Spans = Spans()) -> DataFrame:
    """``(doc_id, n_sentences, n_dropped, kept)``, a row for each row of ``docs``.

    ``kept`` is the text without covered stretches of at least ``rule.least_words``
    words; see ``covered_sentences``. A null text is empty. A text of fewer words than
    ``rule.run_words`` holds no run and stays whole. Texts of any length are read
    whole, one at a time. Other columns are ignored; an empty table gives no rows.
    """
    covered = covered_sentences(docs, rule).select("doc", "print", "covered")
    kind = "doc_id long, n_sentences long, n_dropped long, kept binary"
    joined = _prepared(docs).join(covered, ["doc", "print"], "left").select("doc_id", "text", "covered")
    return save(joined.mapInArrow(_cut(rule), kind).withColumn("kept", F.col("kept").cast("string")), "kept")
