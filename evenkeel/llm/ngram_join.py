"""N-gram Jaccard join with adaptive multi-match prefixes over parts of the sets.

Two documents link when their sets of word shingles have a Jaccard similarity of
at least ``num / den``. A hash deals the shingles to m parts; m depends on a power of
two near the set's size, and a set that may link with sets beyond the next power is dealt
a second time, in their number of parts. If sets x and y link, they differ in at most
``d = (|x| + |y|) (den - num) / (den + num)`` shingles, hence in at most d of their m
parts. The parts, empty ones included, are ordered from rare to frequent. Then the first
d + l parts of x and those of y share at least l, for every l. A part is equal only if all
its shingles are: texts that have single shingles in common by chance, as the more do the
more texts there are, meet in no posting list.

Every document picks its own l: a longer prefix costs more rows, but demands l common
parts before a pair is verified, and from the estimated frequencies of its prefix follows
how many pairs that saves. A pair is held to the smaller l of the two, so no link is lost.

Frequencies come from one sketch over all documents, sized by the text they hold up to
a bound; they only order the parts, by their rarest shingle, and steer l. Documents with
equal sets are one node from the start. Parts of one document only are found by their
hashes alone; a Bloom filter over the others thins the rows that go on to posting lists.
In each posting list all nodes are paired with the list's two ends only; these pairs
are compared, close ones form clusters, and where a cluster is
not connected by then each node is compared with its pivot. Inside a cluster a second prefix filter works on what differs from the pivot,
so a large group of copies makes no quadratic number of pairs; across clusters the
posting lists decide. A long posting list is cut into lots that different tasks pair
with the list. Before whole sets are brought together, pairs pass a parity
bitmap of each set, made along with the prefix: the bits in which two bitmaps differ
are at most the shingles in which the sets differ, so only pairs that cannot link are
left out. Every link is verified on the whole sets, which are built once for all
comparisons of a round; those of a document in many pairs are copied, so that its
pairs spread over tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm import bloom
from evenkeel.llm.graph import components
from evenkeel.llm.scratch import discard, save, settings
from evenkeel.llm.text import batched, rows, shingle_set

# The sketch has a slot for each word of the corpus, within these bounds, in powers of two.
_FEWEST_BITS, _MOST_BITS = 16, 24
_BYTES_A_WORD = 6
_BLOCK_BITS = 16
# Counts below this are kept as they are, higher ones in eighths of a power of two.
_EXACT = 128
_LANES = 64
# Parts without shingles come last.
_EMPTY = 1 << 30
# Pairs that meet one copy of a set, and rows of a posting list in one lot.
_SHARE = 512
_LOT = 2048
# So many much paired documents are broadcast; more are joined by shuffle.
_SMALL = 100_000


@dataclass(frozen=True)
class Similarity:
    """``den * |x & y| >= num * |x | y|`` over shingles of ``words`` words.

    ``most`` is the largest l; ``row_cost`` and ``pair_cost`` weigh a prefix row
    and a verified pair against one hit in a posting list.
    """

    words: int = 5
    num: int = 80
    den: int = 100
    most: int = 16
    row_cost: float = 1.0
    pair_cost: float = 20.0

    def most_differing(self, size: int) -> int:
        """In so many shingles a set of this size may differ from one that links with it."""
        return size * (self.den - self.num) // self.num

    def links(self, x: int, y: int, common: int) -> bool:
        return self.den * common >= self.num * (x + y - common)


def jaccard_components(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs``.

    docs: ``doc_id`` and ``text``; other columns are not read. A null or blank
    text has no shingles and is its own component. Equal sets link. Rows that
    repeat a ``doc_id`` are one node under that id; a row without id takes the
    component of the texts it equals or links with, null if it has none.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    sketch = spark.sparkContext.broadcast(_frequencies(texts, similarity.words))
    prefixes = save(texts.mapInArrow(_prefixes(similarity, sketch), _PREFIX_TYPE), "prefixes")
    sketch.destroy()

    prints = save(prefixes.select("doc_id", "size", "print"), "prints")
    named = prefixes.where("size > 0").groupBy("print").agg(
        F.min("doc_id").alias("node"),
        F.first("size").alias("size"),
        F.first("matches").alias("matches"),
        F.first("prefix").alias("prefix"),
        F.first("bitmap").alias("bitmap"),
    )
    nodes = save(named.where("node is not null"), "nodes")
    discard(prefixes)
    links = _links(texts, nodes, similarity)
    labels = components(links)

    members = nodes.select("print", "node").join(labels, "node", "left").select(
        "print", F.coalesce("component", "node").alias("component")
    )
    told = save(
        prints.join(members, "print", "left").select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
        ),
        "components",
    )
    for table in (links, labels, nodes, prints):
        discard(table)
    return told


def _posted(nodes: DataFrame, similarity: Similarity) -> DataFrame:
    """``(node, size, matches, place, token)``: all parts that several nodes hold, and few others."""
    shared = save(
        nodes.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1"),
        "shared",
    )
    held = nodes.sparkSession.sparkContext.broadcast(bloom.build(shared, F.col("token")))
    posted = save(
        nodes.select("node", "size", "matches", "prefix").mapInArrow(
            _held_parts(similarity, held), "node long, size long, matches int, place int, token long"
        ),
        "posted",
    )
    held.destroy()
    discard(shared)
    return posted


def _links(texts: DataFrame, nodes: DataFrame, similarity: Similarity) -> DataFrame:
    """Verified links ``(a, b)`` that join the same nodes as all links do."""
    posted = _posted(nodes, similarity)
    who = F.struct("node", "size", "matches")
    shared = (
        posted.groupBy("token")
        .agg(F.min(who).alias("low"), F.max(who).alias("high"))
        .where("low.node < high.node")
    )
    hits = save(posted.join(shared, "token"), "hits")
    discard(posted)

    ends = hits.select(
        F.explode(F.array("low", "high")).alias("end"), "node", "size", "matches"
    ).where("end.node <> node")
    ends = ends.where(
        F.least("end.size", "size") * similarity.den >= F.greatest("end.size", "size") * similarity.num
    )
    # One common part is enough here: two pairs a row at most, and near copies find their cluster.
    first = save(
        ends.select(
            F.least("end.node", "node").alias("a"), F.greatest("end.node", "node").alias("b")
        ).distinct(),
        "first",
    )
    bitmaps = nodes.select("node", F.col("bitmap").alias("value"))
    likely = _plausible(bitmaps, first, similarity, close=0.5)
    sets = _sets_of(texts, likely, similarity)
    scored = save(
        _with_both(sets, likely).mapInArrow(
            _compared(similarity, close=0.5), "a long, b long, linked boolean"
        ),
        "scored",
    )
    near = scored.where("linked").select("a", "b")
    clusters = components(scored)
    joined = components(near)
    grouped = save(
        clusters.withColumnRenamed("component", "cluster")
        .join(joined, "node", "left")
        .select("node", "cluster", F.coalesce("component", "node").alias("component")),
        "grouped",
    )
    told = save(_deltas(sets, _pivots(scored, grouped), similarity), "told")
    for table in (sets, clusters, joined):
        discard(table)

    placed = save(
        hits.drop("low", "high")
        .join(grouped.select("node", "cluster"), "node", "left")
        .withColumn("cluster", F.coalesce("cluster", "node")),
        "placed",
    )
    discard(hits)
    ranked = _ranked(told, grouped, similarity)
    mixed = _mixed(placed)
    rest = save(
        _within(ranked, similarity)
        .union(_across(mixed, similarity))
        .join(first, ["a", "b"], "left_anti")
        .distinct(),
        "rest",
    )
    possible = _plausible(bitmaps, rest, similarity)
    sets = _sets_of(texts, possible, similarity)
    later = _with_both(sets, possible).mapInArrow(
        _compared(similarity), "a long, b long, linked boolean"
    )
    by_pivot = told.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    found = save(near.union(by_pivot).union(later.select("a", "b")).distinct(), "found")
    for table in (first, likely, scored, grouped, told, placed, ranked, mixed, rest, possible, sets):
        discard(table)
    return found


def _pivots(scored: DataFrame, grouped: DataFrame) -> DataFrame:
    """``(pivot, node)``: the node with most pairs in a cluster, and each other node of it.

    Only of clusters that hold more than one pair and are not connected yet.
    """
    degrees = (
        scored.select(F.explode(F.array("a", "b")).alias("node"))
        .groupBy("node")
        .count()
        .join(grouped, "node")
    )
    pivots = (
        degrees.groupBy("cluster")
        .agg(
            F.max(F.struct("count", (-F.col("node")).alias("back")))["back"].alias("back"),
            F.count(F.lit(1)).alias("nodes"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        .where("nodes > 2 and least <> most")
        .select("cluster", "back")
    )
    return (
        degrees.select("node", "cluster")
        .join(pivots, "cluster")
        .select((-F.col("back")).alias("pivot"), "node")
        .where("pivot <> node")
    )


def _deltas(sets: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """``(pivot, node, size, linked, delta)``: the shingles in just one of node and pivot."""
    pairs = pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return _with_both(sets, pairs).mapInArrow(
        _differing(similarity), "pivot long, node long, size int, linked boolean, delta array<long>"
    )


def _lots(rows_in_list: Column) -> Column:
    """Into how many lots the rows of a posting list are dealt."""
    return F.ceil(rows_in_list / _LOT).cast("int")


def _ranked(told: DataFrame, grouped: DataFrame, similarity: Similarity) -> DataFrame:
    """Shingles in which nodes differ from their pivot, rare ones first, with the length of their list."""
    tokens = (
        told.join(grouped.select("node", "component"), "node")
        .select(
            "pivot",
            "node",
            "size",
            "linked",
            "component",
            F.size("delta").alias("differs"),
            F.explode("delta").alias("token"),
        )
        .dropDuplicates(["pivot", "node", "token"])
    )
    shared = tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("seen"))
    ranked = tokens.join(shared, ["pivot", "token"]).withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy("seen", "token")) - 1
    )
    # The most places any partner can ask for: no more than d + 1, see above.
    widest = F.floor(F.col("size") * (similarity.den - similarity.num) / similarity.num)
    return save(ranked.where((F.col("seen") > 1) & (F.col("place") <= widest)), "ranked")


def _within(ranked: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs ``(a, b)`` of one cluster that may link and are not known to be connected.

    With pivot p, x and y differ in as many shingles as their deltas to p do. If x and
    y link and are not both linked to p, the deltas are too large to differ in so few
    shingles unless they share some: with s = |dx| + |dy| and at most d differing
    shingles in a link, at least (s - d) / 2. So the shingles of the pivot, which all
    copies share, no longer make pairs; only common edits do.
    """
    lots = _lots(F.col("seen"))
    x = (
        ranked.where("not linked")
        .withColumn("lot", F.pmod(F.xxhash64("node"), lots).cast("int"))
        .alias("x")
    )
    y = ranked.withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1))).alias("y")
    most = F.floor(
        (F.col("x.size") + F.col("y.size"))
        * (similarity.den - similarity.num)
        / (similarity.den + similarity.num)
    )
    need = F.ceil((F.col("x.differs") + F.col("y.differs") - most) / 2)
    return (
        x.join(
            y,
            (F.col("x.pivot") == F.col("y.pivot"))
            & (F.col("x.token") == F.col("y.token"))
            & (F.col("x.lot") == F.col("y.lot"))
            & (F.col("x.component") != F.col("y.component"))
            & (F.col("y.linked") | (F.col("x.node") < F.col("y.node")))
            & (F.least("x.size", "y.size") * similarity.den >= F.greatest("x.size", "y.size") * similarity.num)
            & (F.col("x.place") <= F.col("x.differs") - need)
            & (F.col("y.place") <= F.col("y.differs") - need),
        )
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def _mixed(placed: DataFrame) -> DataFrame:
    """Posting lists of more than one cluster, with their largest cluster and their length."""
    mixed = placed.join(
        placed.groupBy("token")
        .agg(F.min("cluster").alias("least"), F.max("cluster").alias("most"))
        .where("least <> most")
        .select("token"),
        "token",
    )
    # In a list, the rows outside its largest cluster meet all other clusters.
    largest = (
        mixed.groupBy("token", "cluster")
        .count()
        .groupBy("token")
        .agg(
            F.max(F.struct("count", "cluster"))["cluster"].alias("main"),
            F.sum("count").alias("listed"),
        )
    )
    return save(mixed.join(largest, "token"), "mixed")


def _across(mixed: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs ``(a, b)`` of different clusters that share as many parts as they must."""
    lots = _lots(F.col("listed"))
    x = (
        mixed.where("cluster <> main")
        .withColumn("lot", F.pmod(F.xxhash64("node"), lots).cast("int"))
        .alias("x")
    )
    y = mixed.withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1))).alias("y")
    demand = F.least("x.matches", "y.matches")
    differing = F.floor(
        (F.col("x.size") + F.col("y.size"))
        * (similarity.den - similarity.num)
        / (similarity.den + similarity.num)
    )

    met = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.lot") == F.col("y.lot"))
        & (F.col("x.cluster") != F.col("y.cluster"))
        & ((F.col("y.cluster") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
        & (F.least("x.size", "y.size") * similarity.den >= F.greatest("x.size", "y.size") * similarity.num)
        & (F.col("x.place") < differing + demand)
        & (F.col("y.place") < differing + demand),
    )
    return (
        met.groupBy(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        )
        .agg(F.count(F.lit(1)).alias("common"), F.min(demand).alias("demand"))
        .where(F.col("common") >= F.col("demand"))
        .select("a", "b")
    )


def _plausible(
    bitmaps: DataFrame, pairs: DataFrame, similarity: Similarity, close: float = 1.0
) -> DataFrame:
    """The pairs ``(a, b)`` whose bitmaps leave ``close`` times the similarity that links possible."""
    both = _with_both(bitmaps, pairs)
    return save(both.mapInArrow(_possible(similarity, close), "a long, b long").distinct(), "plausible")


def _sets_of(texts: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """``(node, value)``: the sets of all documents in a pair, and of some others."""
    context = texts.sparkSession.sparkContext
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    held = context.broadcast(bloom.build(ids, F.xxhash64("node")))
    sets = save(
        texts.withColumn("hashed", F.xxhash64("doc_id")).mapInArrow(
            _sets(similarity.words, held), "node long, value binary"
        ),
        "sets",
    )
    held.destroy()
    return sets


def _with_both(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b, x, y)``: pairs with what ``held(node, value)`` has for either.

    A node in many pairs has its value copied once for every ``_SHARE`` of them.
    """
    busy = save(
        pairs.select(F.explode(F.array("a", "b")).alias("node"))
        .groupBy("node")
        .agg(F.ceil(F.count(F.lit(1)) / _SHARE).cast("int").alias("copies"))
        .where("copies > 1"),
        "busy",
    )
    many = busy.count()
    busy = F.broadcast(busy) if many <= _SMALL else busy
    copies = F.coalesce("copies", F.lit(1))
    for side in ("a", "b") if many else ():
        pairs = pairs.join(busy.withColumnRenamed("node", side), side, "left").select(
            *pairs.columns, F.pmod(F.xxhash64("a", "b"), copies).cast("int").alias(f"copy_{side}")
        )
    if many:
        held = held.join(busy, "node", "left").select(
            "node", "value", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy")
        )
    for side, name in (("a", "x"), ("b", "y")):
        keys = [side, f"copy_{side}"] if many else [side]
        value = held.withColumnsRenamed({"node": side, "value": name, "copy": f"copy_{side}"})
        pairs = pairs.join(value, keys)
    return pairs.select("a", "b", "x", "y")


def _bitmap(shingles: np.ndarray) -> bytes:
    """The set's size in 8 bytes, then a power of two of bits, 4 or more a shingle.

    A bit tells whether an odd number of shingles falls on it.
    """
    width = 1 << max(6, (4 * len(shingles) - 1).bit_length())
    places = (shingles & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=width) & 1).astype(np.uint8)
    return len(shingles).to_bytes(8, "little") + np.packbits(odd).tobytes()


def _least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two bitmaps differ; the wider one is folded to the other's width."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    folded = np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)
    return int(np.bitwise_count(folded ^ small).sum())


def _possible(similarity: Similarity, close: float) -> Callable:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for a, b, x, y in rows(batches):
            total = int.from_bytes(x[:8], "little") + int.from_bytes(y[:8], "little")
            differ = _least_difference(np.frombuffer(x[8:], np.uint8), np.frombuffer(y[8:], np.uint8))
            if similarity.den * (total - differ) >= close * similarity.num * (total + differ):
                yield a, b

    return lambda batches: batched(found(batches), schema)


def _differing(similarity: Similarity) -> Callable:
    schema = pa.schema(
        [
            ("pivot", pa.int64()),
            ("node", pa.int64()),
            ("size", pa.int32()),
            ("linked", pa.bool_()),
            ("delta", pa.list_(pa.int64())),
        ]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for pivot, node, x, y in rows(batches):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            delta = np.setxor1d(x, y, assume_unique=True).view(np.int64)
            common = (len(x) + len(y) - len(delta)) // 2
            yield pivot, node, len(y), similarity.links(len(x), len(y), common), delta

    return lambda batches: batched(found(batches), schema)


def _compared(similarity: Similarity, close: float = 1.0) -> Callable:
    """Pairs with at least ``close`` times the similarity that links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for a, b, x, y in rows(batches):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            at = np.searchsorted(large, small)
            common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            linked = similarity.links(len(x), len(y), common)
            union = len(x) + len(y) - common
            if linked or similarity.den * common >= close * similarity.num * union and close < 1:
                yield a, b, linked

    return lambda batches: batched(found(batches), schema)


def _sets(words: int, held) -> Callable:
    schema = pa.schema([("node", pa.int64()), ("value", pa.binary())])

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            hashed = batch.column(2).to_numpy().view(np.uint64)
            for i in np.flatnonzero(bloom.might_hold(held.value, hashed)):
                doc_id, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if doc_id is not None and len(found := shingle_set(text, words)):
                    yield doc_id, found.tobytes()

    return lambda batches: batched(kept(batches), schema)


def _levels(size: int, similarity: Similarity) -> range:
    """The powers of two in which a set of this size is dealt: its own and those of larger partners."""
    return range(size.bit_length(), (size * similarity.den // similarity.num).bit_length() + 1)


def _parts(
    shingles: np.ndarray, seen: np.ndarray, similarity: Similarity, level: int
) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each part of a set, rare parts first, and how often its rarest shingle was seen.

    There are more parts than the shingles in which two sets below ``2 ** level`` that link
    differ. The order depends on the part alone, whatever set it is from.
    """
    differing = similarity.most_differing((1 << level) - 1)
    parts = differing + 1 + differing // 4
    at = ((shingles & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    filled, start, held = np.unique(at[order], return_index=True, return_counts=True)
    tokens = np.zeros(parts, dtype=np.uint64)
    tokens[filled] = np.add.reduceat(shingles[order], start)
    rarest = np.full(parts, _EMPTY, dtype=np.int64)
    rarest[filled] = np.minimum.reduceat(seen[order], start)
    number = np.zeros(parts, dtype=np.int64)
    number[filled] = held
    tokens = _mixed_bits(tokens + (np.arange(parts, dtype=np.uint64) << np.uint64(8)) + np.uint64(level))
    order = np.lexsort((tokens, -number, rarest))
    return tokens[order], rarest[order]


def _mixed_bits(hashes: np.ndarray) -> np.ndarray:
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(factor)
    return hashes ^ (hashes >> np.uint64(31))


def _held_parts(similarity: Similarity, held) -> Callable:
    schema = pa.schema(
        [
            ("node", pa.int64()),
            ("size", pa.int64()),
            ("matches", pa.int32()),
            ("place", pa.int32()),
            ("token", pa.int64()),
        ]
    )

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                node, size, matches = (batch.column(k)[i].as_py() for k in range(3))
                prefix = batch.column(3)[i].values.to_numpy()
                width = similarity.most_differing(size) + matches
                for place in np.flatnonzero(bloom.might_hold(held.value, prefix.view(np.uint64))):
                    yield node, size, matches, place % width, prefix[place]

    return lambda batches: batched(kept(batches), schema)


_PREFIX_TYPE = "doc_id long, size long, print binary, matches int, prefix array<long>, bitmap binary"


def _prefixes(similarity: Similarity, sketch) -> Callable:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("size", pa.int64()),
            ("print", pa.binary()),
            ("matches", pa.int32()),
            ("prefix", pa.list_(pa.int64())),
            ("bitmap", pa.binary()),
        ]
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        table, counts = sketch.value, _decoded()
        bits = len(table).bit_length() - 1
        noise = float(np.bincount(table, minlength=256) @ counts) / len(table)
        # A slot's count without the shingle that is asked for seldom exceeds this.
        usual = noise + 2 * noise**0.5
        for doc_id, text in rows(batches):
            shingles = shingle_set(text, similarity.words)
            size = len(shingles)
            if not size:
                yield doc_id, 0, None, None, None, None
                continue
            seen = counts[table[(shingles >> np.uint64(64 - bits)).astype(np.int64)]]
            seen = np.maximum(seen - 1 - usual, 0).astype(np.int64)
            dealt = [_parts(shingles, seen, similarity, level) for level in _levels(size, similarity)]
            differing = similarity.most_differing(size)
            longest = min(differing + similarity.most, *(len(tokens) for tokens, _ in dealt))
            hits = np.cumsum(dealt[0][1][:longest])[differing:]
            matches = np.arange(1, len(hits) + 1)
            # Of all partners, at most hits / l can share l parts.
            cost = similarity.row_cost * (differing + matches) + hits + similarity.pair_cost * hits / matches
            best = int(np.argmin(cost)) + 1
            prefix = np.concatenate([tokens[: differing + best] for tokens, _ in dealt]).view(np.int64)
            name = xxhash.xxh3_128_digest(shingles.tobytes())
            yield doc_id, size, name, best, prefix, _bitmap(shingles)

    return lambda batches: batched(found(batches), schema)


def _encoded(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte each, so that a larger count never has a smaller code."""
    high = _EXACT + 8 * np.log2(np.maximum(counts, _EXACT) / _EXACT)
    return np.where(counts < _EXACT, counts, np.minimum(high, 255)).astype(np.uint8)


def _decoded() -> np.ndarray:
    """The count that each of the 256 codes stands for."""
    codes = np.arange(256)
    return np.where(codes < _EXACT, codes, _EXACT * 2.0 ** ((codes - _EXACT) / 8)).astype(np.int64)


def _frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """Codes of how many documents hold a shingle of each slot, over all documents.

    Tasks send their counts in blocks; blocks are added in lanes and the lanes
    added again, each as a sorted stream. The table has at most 2**24 bytes.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    bits = min(max((size // _BYTES_A_WORD).bit_length(), _FEWEST_BITS), _MOST_BITS)
    kind = "block int, lane int, counts binary"
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        counted = texts.mapInArrow(_count_slots(words, bits), kind)
        for keys, last in ((("block", "lane"), False), (("block",), True)):
            dealt = counted.repartition(*keys).sortWithinPartitions(*keys)
            counted = dealt.mapInArrow(_add_blocks(keys, last), kind)
        blocks = counted.collect()
    table = np.zeros(1 << bits, dtype=np.uint8)
    for block, _, codes in blocks:
        start = block << _BLOCK_BITS
        table[start : start + (1 << _BLOCK_BITS)] = np.frombuffer(zlib.decompress(codes), np.uint8)
    return table


_BLOCKS = pa.schema([("block", pa.int32()), ("lane", pa.int32()), ("counts", pa.binary())])
_BLOCK_BYTES = 4 << _BLOCK_BITS


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), codec="lz4", asbytes=True)


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(counts, _BLOCK_BYTES, codec="lz4", asbytes=True), np.int32)


def _count_slots(words: int, bits: int) -> Callable:
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        table = np.zeros(1 << bits, dtype=np.int32)
        for _, text in rows(batches):
            shingles = shingle_set(text, words)
            np.add.at(table, (shingles >> np.uint64(64 - bits)).astype(np.int64), 1)
        lane = TaskContext.get().partitionId() % _LANES
        for block in range(1 << (bits - _BLOCK_BITS)):
            piece = table[block << _BLOCK_BITS : (block + 1) << _BLOCK_BITS]
            if piece.any():
                yield block, lane, _packed(piece)

    return lambda batches: batched(blocks(batches), _BLOCKS)


def _add_blocks(keys: tuple[str, ...], last: bool) -> Callable:
    """One block for all that follow each other with equal keys; at last in codes."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in groupby(rows(batches), key=lambda row: row[: len(keys)]):
            total = np.zeros(1 << _BLOCK_BITS, dtype=np.int64)
            for block, lane, counts in group:
                total += _unpacked(counts)
            total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
            yield block, lane, zlib.compress(_encoded(total).tobytes(), 1) if last else _packed(total)

    return lambda batches: batched(sums(batches), _BLOCKS)
