"""Words, shingles and normal forms of texts, for expressions and inside tasks."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of [\x20\x09-\x0D]. ``bytes.split()`` splits at the same ones.
WHITESPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20

# Odd multipliers that tell the places of a word in a shingle apart.
_PLACES = np.array(
    [
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x27D4EB2F165667C5,
        0x85EBCA77C2B2AE63,
        0xFF51AFD7ED558CCD,
        0xC4CEB9FE1A85EC53,
        0xA0761D6478BD642F,
    ],
    dtype=np.uint64,
)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def folded_words(text: bytes | None) -> list[bytes]:
    """The words of a text with A-Z in lower case."""
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; with fewer words, one for all of them."""
    if not 1 <= size <= len(_PLACES):
        raise ValueError(f"runs take 1 to {len(_PLACES)} words")
    if not len(hashes):
        return hashes
    length = min(size, len(hashes))
    last = len(hashes) - length + 1
    total = hashes[:last] * _PLACES[0]
    for place in range(1, length):
        total = total + hashes[place : place + last] * _PLACES[place]
    # A short text must not meet the runs of longer ones.
    total += np.uint64(length)
    total ^= total >> np.uint64(32)
    return total * _PLACES[0]


def text_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text, taken piece by piece so that a very long one fits."""
    found, start = [], 0
    text = text or b""
    while start < len(text):
        stop = len(text)
        if stop - start > _PIECE and (gap := _GAP.search(text, start + _PIECE)):
            stop = gap.start()
        found.append(word_hashes(folded_words(text[start:stop])))
        start = stop
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes."""
    return np.unique(runs(text_hashes(text), size))


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one at a time."""
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in columns)


def batched(
    records: Iterable[tuple], schema: pa.Schema, size: int = 2048, weight: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` records and about ``weight`` bytes."""
    kept: list[tuple] = []
    held = 0
    for record in records:
        kept.append(record)
        held += sum(len(v) for v in record if isinstance(v, (bytes, str)))
        held += sum(v.nbytes for v in record if isinstance(v, np.ndarray))
        if len(kept) >= size or held >= weight:
            yield _batch(kept, schema)
            kept, held = [], 0
    if kept:
        yield _batch(kept, schema)


def _batch(records: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*records)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
    )
