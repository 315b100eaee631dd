"""The trie of conversation prefixes, as a table of its nodes.

A node is a distinct sequence of first turns; it is named by a 128-bit digest, the
exclusive or of its turns' hashes, each mixed with its depth, so running digests come
from one window over a conversation. Spark counts members by digest. Sums over
subtrees are made in flat numpy arrays: a task holds whole subtrees, gives every node
a slot by a minimal perfect hash, and adds slots to their parents' slots from the
deepest level up. Subtrees with many rows are cut: their upper nodes, of which there
are few, form a trie of their own that is added up last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.perfect_hash import PerfectHash
from evenkeel.llm.scratch import save

# A subtree of more rows than this may be cut.
LEAST_ROWS = 4096
# At most so many nodes lie above all cuts.
CROWN = 1 << 20
# Nodes that a task gathers before it adds them up, besides the last subtree.
GATHERED = 1 << 18
# Bytes of listed ids in one row on their way to the hash of all.
_LISTED = 1 << 20

_TURN = ["first", "second", "third", "bytes"]
_DIGEST = ["high", "low"]
_PARENT = ["parent_high", "parent_low"]
_ABOVE = ["cut_high", "cut_low"]


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, first, second, third, bytes)``: hashes of each turn, numbered from 1.

    Ordered by ``turn``, null first; equal turn numbers by the hashes of role and
    text. A null role or text is empty. Rows without ``conv_id`` are in no
    conversation. One task streams through a conversation's hashes.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    read = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("first"),
        F.xxhash64(F.lit(2), text, role).alias("second"),
        F.xxhash64(F.lit(3), role, text).alias("third"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "first", "second", "third", "bytes"
    )
    return read.select("conv_id", F.row_number().over(order).alias("at"), "first", "second", "third", "bytes")


def _heads(numbered: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return numbered.where("at = 1").select(
        "conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), *(zero.alias(c) for c in _TURN)
    )


def plain(numbered: DataFrame) -> DataFrame:
    """The conversations as they are, with a head row each."""
    return _heads(numbered).unionByName(numbered.withColumn("part", F.lit(2)))


def spliced(numbered: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % ``every``.

    Its own turns after its first h follow; h is the unsigned crc32 of c as a decimal,
    modulo ``most`` + 1. A negative id has a remainder of its own sign. Turns for
    conversations that do not exist go when digests are made, as they have no head.
    """
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1))
    own = numbered.where(F.col("at") > taken).withColumn("part", F.lit(2))
    away = F.lit(every - 1)
    step = F.when(F.col("conv_id") > 0, F.sequence(F.lit(0), away)).when(
        F.col("conv_id") < 0, F.sequence(-away, F.lit(0))
    ).otherwise(F.sequence(-away, away))
    borrowed = (
        numbered.where((F.col("at") <= most) & (F.col("conv_id") % every == 0))
        .select(F.explode(step).alias("step"), "conv_id", "at", *_TURN)
        .withColumn("conv_id", F.col("conv_id") + F.col("step"))
        .where(F.col("at") <= taken)
        .select("conv_id", F.lit(1).alias("part"), "at", *_TURN)
    )
    return reduce(DataFrame.unionByName, [_heads(numbered), borrowed, own])


def steps(parts: DataFrame) -> DataFrame:
    """A row for each conversation and depth, with digests of the prefix and its parent.

    parts: ``plain`` or ``spliced`` turns.
    """
    whole = Window.partitionBy("conv_id")
    running = whole.orderBy("part", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def mixed(seed: int) -> Column:
        hashed = F.xxhash64(F.lit(seed), "depth", "first", "second")
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(hashed)

    return (
        parts.withColumn("head", F.first("part").over(running))
        .withColumn("depth", (F.row_number().over(whole.orderBy("part", "at")) - 1).cast("long"))
        .withColumn("length", F.count(F.lit(1)).over(whole) - 1)
        .where("head = 0")
        .withColumns({"own_high": mixed(4), "own_low": mixed(5)})
        .withColumns({"high": F.bit_xor("own_high").over(running), "low": F.bit_xor("own_low").over(running)})
        .select(
            "conv_id",
            "depth",
            "length",
            "high",
            "low",
            F.col("high").bitwiseXOR(F.col("own_high")).alias("parent_high"),
            F.col("low").bitwiseXOR(F.col("own_low")).alias("parent_low"),
            "third",
            "bytes",
        )
    )


def _crown(found: DataFrame) -> DataFrame:
    """Digests of nodes with more rows below them than a task should gather; at most ``CROWN``.

    The rows at and below all nodes of a depth are no more than all rows, so those of
    all nodes together are the sum over conversations of (n + 1)(n + 2) / 2.
    """
    heads = found.where("depth = 0").agg(F.sum(F.expr("(length + 1) * (length + 2) div 2")))
    limit = max(LEAST_ROWS, (heads.first()[0] or 0) // CROWN)
    return (
        found.groupBy(*_DIGEST)
        .agg(F.sum(F.col("length") - F.col("depth") + 1).alias("rows"))
        .where(F.col("rows") > limit)
        .select(*_DIGEST, F.lit(True).alias("crown"))
    )


def _nodes(found: DataFrame) -> DataFrame:
    """Distinct prefixes with their counts, and the top of the subtree that holds them."""
    running = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    digest = F.when(F.col("crown").isNull(), F.struct(*_DIGEST))
    cut = found.join(F.broadcast(_crown(found)), _DIGEST, "left").withColumn(
        "cut", F.first(digest, ignorenulls=True).over(running)
    )
    same = ["depth", *_PARENT, "third", "bytes"]
    counted = cut.groupBy(F.col("cut.high").alias("cut_high"), F.col("cut.low").alias("cut_low"), *_DIGEST).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum((F.col("depth") == F.col("length")).cast("long")).alias("n_ends"),
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"most_{c}") for c in same),
    )
    differ = reduce(Column.__or__, [F.col(c) != F.col(f"most_{c}") for c in same])
    verified = F.when(differ, F.raise_error(F.lit("two prefixes share a digest"))).otherwise(F.col("n_convs"))
    zero = F.lit(0).cast("long")
    return counted.select(
        *_ABOVE, *_DIGEST, *_PARENT, "conv_id", "depth", "bytes", verified.alias("n_convs"), "n_ends",
        zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"),
    )


_KIND = (
    "cut_high long, cut_low long, high long, low long, parent_high long, parent_low long, conv_id long, "
    "depth long, bytes long, n_convs long, n_ends long, n_children long, n_leaves long, saved_tokens long, "
    "parent_conv_id long, top boolean"
)
_NAMES = [part.split()[0] for part in _KIND.split(", ")]


def _summed(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Children, leaves and savings of whole subtrees, in slots of a perfect hash."""
    high, low = (columns[c].view(np.uint64) for c in _DIGEST)
    table = PerfectHash(high, low)
    slots = table.slots(high, low)
    parents = table.slots(*(columns[c].view(np.uint64) for c in _PARENT))
    parents[columns["depth"] == 0] = -1
    flat = {name: np.empty_like(values) for name, values in columns.items()}
    for name, values in columns.items():
        flat[name][slots] = values
    parent = np.empty_like(parents)
    parent[slots] = parents
    inner = parent >= 0
    if not (flat["depth"][inner] == flat["depth"][parent[inner]] + 1).all():
        raise ValueError("a parent is not one level above its child")
    np.add.at(flat["n_children"], parent[inner], 1)
    flat["n_leaves"] += flat["n_children"] == 0
    flat["saved_tokens"] += (flat["n_convs"] - 1) * flat["bytes"]
    order = np.argsort(-flat["depth"], kind="stable")
    ends = np.flatnonzero(np.diff(flat["depth"][order], append=-1)) + 1
    start = 0
    for stop in ends:
        level = order[start:stop]
        level = level[inner[level]]
        np.add.at(flat["n_leaves"], parent[level], flat["n_leaves"][level])
        np.add.at(flat["saved_tokens"], parent[level], flat["saved_tokens"][level])
        start = stop
    flat["parent_conv_id"] = np.where(inner, flat["conv_id"][parent], 0)
    flat["top"] = ~inner
    return flat


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up rows ordered by subtree, as many whole subtrees at a time as fit."""
    held: list[dict[str, np.ndarray]] = []
    rows = 0

    def flushed(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        flat = _summed(columns)
        arrays = [pa.array(flat[name], mask=flat["top"] if name == "parent_conv_id" else None) for name in _NAMES]
        yield from pa.Table.from_arrays(arrays, names=_NAMES).to_batches(max_chunksize=1 << 14)

    def joined() -> dict[str, np.ndarray]:
        return {name: np.concatenate([part[name] for part in held]) for name in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {
            name: batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).copy()
            for i, name in enumerate(batch.schema.names)
        }
        held.append(columns)
        rows += batch.num_rows
        if rows >= GATHERED:
            whole = joined()
            change = (np.diff(whole["cut_high"]) != 0) | (np.diff(whole["cut_low"]) != 0)
            stops = np.flatnonzero(change) + 1
            if len(stops):
                last = stops[-1]
                yield from flushed({name: values[:last] for name, values in whole.items()})
                whole = {name: values[last:] for name, values in whole.items()}
            held, rows = [whole], len(whole["depth"])
    if rows:
        yield from flushed(joined())


def _listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids ordered by node, joined to pieces of bounded length."""
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("start", pa.int64()), ("ids", pa.string())])
    node, start, ids, size = None, None, [], 0
    made: list[tuple] = []
    for batch in batches:
        for high, low, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if ids and ((high, low) != node or size >= _LISTED):
                made.append((*node, start, ",".join(ids)))
                ids, size = [], 0
            if not ids:
                node, start = (high, low), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*made), schema)], schema=schema)
            made = []
    if ids:
        last = [(*node, start, ",".join(ids))]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*last), schema)], schema=schema)


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One running SHA-256 over the ordered pieces of each node."""
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("ends_sha256", pa.string())])
    node, running = None, None
    for batch in batches:
        made = []
        for high, low, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (high, low) == node:
                running.update(b",")
            else:
                if node is not None:
                    made.append((*node, running.hexdigest()))
                node, running = (high, low), hashlib.sha256()
            running.update(ids.encode())
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*made), schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([node[0]]), pa.array([node[1]]), pa.array([running.hexdigest()])], schema=schema
        )


def ends(found: DataFrame) -> DataFrame:
    """``(high, low, ends_sha256)`` of nodes at which conversations end.

    Ids are sorted by ranges of (node, id), so a node with very many of them takes many
    tasks; only its pieces of about a megabyte then pass through one task, in order,
    since the hash of a sequence cannot be put together from parts.
    """
    ordered = (
        found.where("depth = length")
        .select(*_DIGEST, "conv_id")
        .repartitionByRange(*_DIGEST, "conv_id")
        .sortWithinPartitions(*_DIGEST, "conv_id")
    )
    pieces = ordered.mapInArrow(_listed, "high long, low long, start long, ids string")
    return (
        pieces.repartition(*_DIGEST)
        .sortWithinPartitions(*_DIGEST, "start")
        .drop("start")
        .mapInArrow(_hashed, "high long, low long, ends_sha256 string")
    )


def prefix_trie(parts: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``parts`` (``plain`` or ``spliced`` turns).

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``: the smallest member and the number of turns, which together name
    the node; the parent's smallest member (null for the root); members; children;
    childless nodes in its subtree; the sum over its subtree of (members - 1) times
    the UTF-8 bytes of the last text; the SHA-256 of the ascending, comma-joined ids
    of members that end here. A conversation without turns ends at the root. Without
    any conversation there is no node. Two different prefixes with one digest are an
    error, found by a third hash, the bytes, the depth and the parent's digest.
    """
    found = save(steps(parts), "steps")
    nodes = save(_nodes(found), "nodes")
    ordered = nodes.where("cut_high is not null").repartition(*_ABOVE).sortWithinPartitions(*_ABOVE)
    lower = save(ordered.mapInArrow(_batches, _KIND), "subtrees", batch=16384)
    added = (
        lower.where("top and depth > 0")
        .groupBy(*(F.col(p).alias(d) for p, d in zip(_PARENT, _DIGEST)))
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
        )
    )
    sums = ["n_children", "n_leaves", "saved_tokens"]
    # No more than CROWN nodes, so one task holds them.
    crown = nodes.where("cut_high is null").drop(*sums).join(added, _DIGEST, "left").fillna(0, subset=sums)
    upper = save(
        crown.select(*[c for c in _NAMES if c not in ("parent_conv_id", "top")])
        .repartition(1)
        .mapInArrow(_batches, _KIND),
        "crown",
        batch=16384,
    )
    above = upper.select(*(F.col(d).alias(p) for d, p in zip(_DIGEST, _PARENT)), F.col("conv_id").alias("above"))
    own = F.coalesce("parent_conv_id", F.when(F.col("depth") > 0, F.col("above")))
    linked = lower.join(F.broadcast(above), _PARENT, "left").withColumn("parent_conv_id", own).drop("above")
    none = hashlib.sha256().hexdigest()
    return (
        linked.unionByName(upper)
        .join(ends(found), _DIGEST, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", *sums,
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
