"""Exact dedup by composable polynomial fingerprints.

The fingerprint of a byte string is its value as a polynomial modulo two primes,
with its length. Pieces are hashed on their own; two neighbours combine as
``h(ab) = h(a) * base**len(b) + h(b)``, so the pieces of a huge text may be
hashed in any number of tasks and put together in any grouping. Texts above a
megabyte go that way, slice by slice. Texts with equal fingerprints are then compared
piece by piece with the group's leader.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import bloom
from evenkeel.llm.scratch import discard, save
from evenkeel.llm.text import batched, rows

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)
PIECE = 1 << 16
# Members of a group that share one copy of the leader's pieces.
_PER_COPY = 256
# Texts of more bytes are cut into slices of as many pieces, hashed in tasks of their own.
HUGE = 1 << 20
# A group with a larger part of all rows than one in this many is joined by a broadcast;
# there are no more such groups than this.
_SHARE = 4096

Print = tuple[int, int, int]  # length, value modulo either prime
EMPTY: Print = (0, 0, 0)


# Powers of the bases, highest first; filled in each process at the first use.
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for prime, base in zip(PRIMES, BASES):
            powers = [1]
            for _ in range(PIECE - 1):
                powers.append(powers[-1] * base % prime)
            _POWERS.append(np.array(powers[::-1], dtype=np.uint64))
    return _POWERS


def fingerprint(piece: bytes) -> Print:
    """The fingerprint of at most ``PIECE`` bytes."""
    values = np.frombuffer(piece, np.uint8).astype(np.uint64)
    # 2**16 products of 8 and 31 bits add up to less than 2**55.
    sums = (int(values @ p[PIECE - len(values) :]) % q for p, q in zip(_powers(), PRIMES))
    return (len(piece), *sums)


def combine(left: Print, right: Print) -> Print:
    """The fingerprint of two neighbours put together."""
    shifted = (
        (a * pow(base, right[0], prime) + b) % prime
        for a, b, base, prime in zip(left[1:], right[1:], BASES, PRIMES)
    )
    return (left[0] + right[0], *shifted)


def _squeezed(text: bytes | None) -> Iterator[bytes]:
    """The text without white space, in pieces of ``PIECE`` bytes; the last may be shorter."""
    held = b""
    for start in range(0, len(text or b""), PIECE):
        held += b"".join(text[start : start + PIECE].split())
        if len(held) >= PIECE:
            yield held[:PIECE]
            held = held[PIECE:]
    if held:
        yield held


def _whole(text: bytes | None) -> Print:
    """The fingerprint of a text of any length, without its white space."""
    total = EMPTY
    for piece in _squeezed(text):
        total = combine(total, fingerprint(piece))
    return total


_PRINT_FIELDS = [("length", pa.int64()), ("first", pa.int64()), ("second", pa.int64())]
_PRINT_TYPE = "length long, first long, second long"
_PRINT = ["length", "first", "second"]


def fingerprint_pieces(pieces: DataFrame) -> DataFrame:
    """``(text_id, length, first, second)`` of texts given as ``(text_id, piece_no, piece)``.

    The pieces (at most ``PIECE`` bytes each, in order of ``piece_no``) are hashed
    wherever they lie; only their fingerprints are brought together.
    """
    own = pa.schema([("text_id", pa.int64()), ("piece_no", pa.int64()), *_PRINT_FIELDS])
    joint = pa.schema([("text_id", pa.int64()), *_PRINT_FIELDS])

    def hashed(batches):
        return batched(((i, k, *fingerprint(p or b"")) for i, k, p in rows(batches)), own)

    def folded(batches):
        current, total = None, EMPTY
        for text_id, _, *found in rows(batches):
            if current is not None and current != text_id:
                yield current, *total
                total = EMPTY
            current, total = text_id, combine(total, tuple(found))
        if current is not None:
            yield current, *total

    prints = pieces.select("text_id", "piece_no", "piece").mapInArrow(
        hashed, f"text_id long, piece_no long, {_PRINT_TYPE}"
    )
    return (
        prints.repartition("text_id")
        .sortWithinPartitions("text_id", "piece_no")
        .mapInArrow(lambda b: batched(folded(b), joint), f"text_id long, {_PRINT_TYPE}")
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row for each row of ``docs``.

    Texts are equal when they are the same bytes after deleting white space; null
    is the empty text. Of equal texts the one with the most code points stays,
    then the smallest ``doc_id`` (one without id comes last). Rows that repeat id
    and text are one document: they are all kept or all dropped, and each counts
    in ``group_size``. docs: ``doc_id`` and ``text``; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    points = F.coalesce(F.length(docs["text"]), F.lit(0)).cast("long")
    sized = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), points.alias("points")
    )
    huge = F.coalesce(F.octet_length("text") > HUGE, F.lit(False))
    hashed = save(
        sized.mapInArrow(_prints, f"doc_id long, points long, {_PRINT_TYPE}, sha string, raw string"), "hashed"
    )
    sliced = save(_sliced(texts.where(huge)), "sliced")
    # One row for each distinct text above a megabyte of the input, not for each copy.
    joint = sliced.select(F.col("raw"), *(F.col(c).alias(f"own_{c}") for c in _PRINT))
    prints = save(
        hashed.where("raw is not null")
        .join(joint, "raw")
        .select("doc_id", "points", *(F.col(f"own_{c}").alias(c) for c in _PRINT), "sha")
        .unionByName(hashed.where("raw is null").drop("raw")),
        "prints",
    )
    for table in (hashed, sliced):
        discard(table)
    groups = save(_leaders(prints, _PRINT), "groups")
    same = _compared(texts, prints, groups)

    # A text that differs from its leader goes by its digest from here on.
    told = (
        prints.join(same, ["doc_id", *_PRINT], "left")
        .withColumn("other", F.when(~F.coalesce("same", F.lit(True)), F.col("sha")).otherwise(""))
        .select("doc_id", "points", "sha", *_PRINT, "other")
    )
    told = save(told, "told")
    key = [*_PRINT, "other"]
    final = save(_leaders(told, key), "groups")
    for table in (prints, groups, same):
        discard(table)
    return _with_group(told, final, key, told.count()).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _sliced(texts: DataFrame) -> DataFrame:
    """``(raw, length, first, second)`` of each distinct huge text by the SHA-256 of its bytes.

    Slices are dealt to tasks; their fingerprints without white space are put together.
    """
    slices = F.transform(
        F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / HUGE).cast("int")),
        lambda i: F.substring("text", i * HUGE + 1, F.lit(HUGE)),
    )
    dealt = (
        texts.select(F.sha2("text", 256).alias("raw"), F.posexplode(slices).alias("slice", "part"))
        .repartition("raw", "slice")
    )
    own = pa.schema([("raw", pa.string()), ("slice", pa.int32()), *_PRINT_FIELDS])
    joint = pa.schema([("raw", pa.string()), *_PRINT_FIELDS])

    def hashed(batches):
        return batched(((raw, i, *_whole(part)) for raw, i, part in rows(batches)), own)

    def folded(batches):
        current, total = None, EMPTY
        for raw, _, *found in rows(batches):
            if current is not None and current != raw:
                yield current, *total
                total = EMPTY
            current, total = raw, combine(total, tuple(found))
        if current is not None:
            yield current, *total

    prints = dealt.mapInArrow(hashed, f"raw string, slice int, {_PRINT_TYPE}")
    return (
        prints.dropDuplicates(["raw", "slice"])
        .repartition("raw")
        .sortWithinPartitions("raw", "slice")
        .mapInArrow(lambda b: batched(folded(b), joint), f"raw string, {_PRINT_TYPE}")
    )


def _leaders(prints: DataFrame, key: list[str]) -> DataFrame:
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("back")))
    return prints.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).select(
        *key, "group_size", (-F.col("best.back")).alias("keep_id")
    )


def _with_group(members: DataFrame, groups: DataFrame, key: list[str], total: int) -> DataFrame:
    """``members`` with what ``groups`` says of their key; those of large groups stay in their tasks.

    ``total`` is the sum of all groups' sizes.
    """
    heavy = groups.where(F.col("group_size") * _SHARE > total)
    light = groups.where(F.col("group_size") * _SHARE <= total)
    rest = members.join(F.broadcast(heavy.select(*key)), key, "left_anti")
    return members.join(F.broadcast(heavy), key).unionByName(rest.join(light, key))


def _prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("points", pa.int64()), *_PRINT_FIELDS, ("sha", pa.string()), ("raw", pa.string())])

    def found():
        for doc_id, text, points in rows(batches):
            digest, total = hashlib.sha256(), EMPTY
            huge = len(text or b"") > HUGE
            for piece in _squeezed(text):
                digest.update(piece)
                if not huge:
                    total = combine(total, fingerprint(piece))
            yield doc_id, points, *total, digest.hexdigest(), hashlib.sha256(text).hexdigest() if huge else None

    return batched(found(), schema)


def _compared(texts: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """``(doc_id, length, first, second, same)`` for members that were compared with their leader."""
    spark = texts.sparkSession
    shared = groups.where("group_size > 1 and length > 0 and keep_id is not null")
    members = _with_group(
        prints.select("doc_id", *_PRINT).distinct(), shared, _PRINT, prints.count()
    ).where("doc_id is not null")
    held = spark.sparkContext.broadcast(bloom.build(members, F.xxhash64("doc_id")))
    pieces = save(
        texts.withColumn("hashed", F.xxhash64("doc_id")).mapInArrow(
            _pieces(held), f"doc_id long, {_PRINT_TYPE}, piece_no long, piece binary"
        ),
        "pieces",
    )
    copies = F.ceil(F.col("group_size") / _PER_COPY)
    leading = (
        pieces.join(shared.withColumnRenamed("keep_id", "doc_id"), ["doc_id", *_PRINT])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
        .select(*_PRINT, "piece_no", "copy", F.col("piece").alias("expected"))
    )
    following = (
        pieces.join(members.where("doc_id <> keep_id"), ["doc_id", *_PRINT])
        .withColumn("copy", F.pmod(F.xxhash64("doc_id"), copies))
        .select("doc_id", *_PRINT, "piece_no", "copy", "piece")
    )
    verdict = (
        following.join(leading, [*_PRINT, "piece_no", "copy"])
        .groupBy("doc_id", *_PRINT)
        .agg(F.bool_and(F.col("piece") == F.col("expected")).alias("same"))
    )
    verdict = save(verdict, "verdict")
    discard(pieces)
    held.destroy()
    return verdict


def _pieces(held) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), *_PRINT_FIELDS, ("piece_no", pa.int64()), ("piece", pa.binary())]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            there = bloom.might_hold(held.value, batch.column(2).to_numpy().view(np.uint64))
            for doc_id, text, _ in rows([batch.filter(pa.array(there))]):
                total = _whole(text)
                for piece_no, piece in enumerate(_squeezed(text)):
                    yield doc_id, *total, piece_no, piece

    return lambda batches: batched(found(batches), schema)
