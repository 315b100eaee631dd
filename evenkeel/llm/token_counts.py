"""Token counts of documents without tokenizing any document.

A tokenizer first cuts a text into pre-tokens, and the pieces of a pre-token do not
depend on what stands around it. So one pass writes, for blocks of documents, the
distinct pre-tokens and how often each document holds them; pre-tokens meet by hash
and each distinct one is cut into pieces once; the numbers of pieces go back to their
blocks, where they are multiplied with the frequencies and summed by document. Token
ids never exist outside the count of one pre-token.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evenkeel.llm.scratch import save, settings

# Documents of a block, and bytes of text after which a block ends early.
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 24
# Ranges of hashes by which pre-tokens meet. A task holds the distinct pre-tokens of
# one range, and no more than KNOWN of them; beyond that some are cut again.
BUCKETS = 1024
KNOWN = 1 << 20
_ENCODED = 4096

_POSTINGS = "block long, bucket int, start int, doc_ids array<long>, sizes array<long>, body binary"
_POSTINGS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("start", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("body", pa.binary()),
    ]
)
_COUNTS = pa.schema([("block", pa.int64()), ("start", pa.int32()), ("body", pa.binary())])


def load(definition: str) -> Tokenizer:
    """A tokenizer from the text of its JSON file, without truncation and padding."""
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encoded_sizes(tokenizer: Tokenizer, texts: list[str]) -> list[int]:
    found = []
    for start in range(0, len(texts), _ENCODED):
        part = tokenizer.encode_batch_fast(texts[start : start + _ENCODED], add_special_tokens=False)
        found.extend(len(encoding) for encoding in part)
    return found


class Words:
    """Pre-tokens are the words between ASCII white space.

    Right for tokenizers that drop white space: no piece then reaches over it, and an
    added token's string, which holds none, lies within one word.
    """

    def __init__(self, definition: str):
        self._tokenizer = load(definition)
        sample = " Ab  don't 12\tc-d.\n\x0bé́ X\x0c\r\n"
        whole = self._tokenizer.encode(sample, add_special_tokens=False).ids
        apart = [i for word in sample.split() for i in self._tokenizer.encode(word, add_special_tokens=False).ids]
        added = json.loads(definition).get("added_tokens") or []
        flags = ("lstrip", "rstrip", "single_word", "normalized")
        wide = any(token.get(flag) for token in added for flag in flags)
        if whole != apart or wide or any(token["content"].split() != [token["content"]] for token in added):
            raise ValueError("this tokenizer keeps white space or looks across it")

    def occurrences(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """The place of the text of each pre-token, and the pre-tokens."""
        words = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(texts)), counts), words.flatten().dictionary_encode()

    def pieces(self, tokens: list[str]) -> list[int]:
        return _encoded_sizes(self._tokenizer, tokens)


class PreTokens:
    """Pre-tokens are those of the tokenizer's own pre-tokenizer, for any tokenizer.

    A text that holds the string of an added token is not cut. Keys begin with "t" for
    such a text and with "p" for a pre-token.
    """

    def __init__(self, definition: str):
        self._tokenizer = load(definition)
        self._added = [token["content"] for token in json.loads(definition).get("added_tokens") or []]

    def _cut(self, text: str) -> list[str]:
        normalizer, cutter = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        if any(token in text for token in self._added):
            return ["t" + text]
        if normalizer is not None:
            text = normalizer.normalize_str(text)
        if cutter is None:
            return ["p" + text]
        return ["p" + token for token, _ in cutter.pre_tokenize_str(text)]

    def occurrences(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        listed = [self._cut(text) if text else [] for text in texts.to_pylist()]
        counts = [len(tokens) for tokens in listed]
        flat = pa.array([token for tokens in listed for token in tokens], type=pa.string())
        return np.repeat(np.arange(len(texts)), counts), flat.dictionary_encode()

    def pieces(self, tokens: list[str]) -> list[int]:
        model = self._tokenizer.model
        return [
            len(model.tokenize(token[1:])) if token[0] == "p" else _encoded_sizes(self._tokenizer, [token[1:]])[0]
            for token in tokens
        ]


Cutter = Callable[[str], Words | PreTokens]


def _packed(values: np.ndarray) -> bytes:
    """An array of numbers from 0 up in as few bytes as its largest one needs, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    raw = values.astype(kind).tobytes()
    return kind.itemsize.to_bytes(1) + len(raw).to_bytes(8) + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed[9:], int.from_bytes(packed[1:9]), "zstd", asbytes=True)
    return np.frombuffer(raw, dtype=f"u{packed[0]}").astype(np.int64)


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(part).to_bytes(8) + part for part in parts)


def _parted(joined: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(joined):
        stop = start + 8 + int.from_bytes(joined[start : start + 8])
        yield joined[start + 8 : stop]
        start = stop


def _listed(tokens: list[bytes]) -> bytes:
    lengths = np.array([len(token) for token in tokens])
    body = b"".join(tokens)
    return _joined([_packed(lengths), len(body).to_bytes(8) + pa.compress(body, "zstd", asbytes=True)])


def _tokens(listed: bytes) -> list[str]:
    lengths, body = _parted(listed)
    text = pa.decompress(body[8:], int.from_bytes(body[:8]), "zstd", asbytes=True)
    ends = np.cumsum(_unpacked(lengths)).tolist()
    return [text[a:b].decode() for a, b in zip([0, *ends], ends)]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    ids, texts = batch.column(0), batch.column(1)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(ids):
        stop, held = start + 1, int(sizes[start])
        while stop < len(ids) and stop - start < BLOCK_ROWS and held + sizes[stop] <= BLOCK_BYTES:
            held += int(sizes[stop])
            stop += 1
        yield ids.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop


def _postings(definition: Broadcast, cutter: Cutter):
    def block_rows(number: int, ids: pa.Array, texts: pa.Array, cut: Words | PreTokens) -> Iterator[tuple]:
        place, words = cut.occurrences(pc.fill_null(texts, ""))
        tokens = words.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
        bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[words.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        pairs, times = np.unique(codes * len(ids) + place, return_counts=True)
        per_token = np.bincount(pairs // len(ids), minlength=len(tokens))
        body = _joined([_packed(per_token), _packed(pairs % len(ids)), _packed(times)])
        sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield number, -1, -1, ids.to_pylist(), sizes.to_pylist(), body
        if len(tokens):
            sorted_bucket = bucket[order]
            starts = np.flatnonzero(np.diff(sorted_bucket, prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(order)]):
                part = _listed([tokens[i] for i in order[start:stop]])
                yield number, int(sorted_bucket[start]), int(start), None, None, part

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut = cutter(definition.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, texts in _blocks(batch):
                columns = zip(*block_rows(number, ids, texts, cut))
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _POSTINGS_ARROW)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_POSTINGS_ARROW)
                number += 1

    return made


def _counted(definition: Broadcast, cutter: Cutter):
    """Numbers of pieces for lists of pre-tokens that come ordered by bucket."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = cutter(definition.value)
        known: dict[str, int] = {}
        current = None
        for batch in batches:
            bodies = []
            for bucket, body in zip(batch.column(1).to_pylist(), batch.column(3)):
                if bucket != current or len(known) >= KNOWN:
                    known, current = {}, bucket
                tokens = _tokens(body.as_py())
                if fresh := [token for token in tokens if token not in known]:
                    known.update(zip(fresh, cut.pieces(fresh)))
                bodies.append(_packed(np.array([known[token] for token in tokens])))
            arrays = [batch.column(0), batch.column(2), pa.array(bodies, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_COUNTS)

    return made


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens by document; a block's first row holds its documents, the next ones numbers of pieces."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    head, numbers = None, []

    def finished() -> pa.RecordBatch:
        ids, sizes, body = head
        per_token, place, times = map(_unpacked, _parted(body))
        each = np.concatenate(numbers) if numbers else np.empty(0, dtype=np.int64)
        if len(each) != len(per_token):
            raise ValueError("a block lacks counts of its pre-tokens")
        total = np.zeros(len(ids), dtype=np.int64)
        np.add.at(total, place, times * np.repeat(each, per_token))
        return pa.RecordBatch.from_arrays([ids, sizes, pa.array(total)], schema=schema)

    for batch in batches:
        starts = batch.column(1).to_pylist()
        for i, start in enumerate(starts):
            body = batch.column(4)[i].as_py()
            if start < 0:
                if head is not None:
                    yield finished()
                head, numbers = (batch.column(2)[i].values, batch.column(3)[i].values, body), []
            else:
                numbers.append(_unpacked(body))
    if head is not None:
        yield finished()


def token_counts(docs: DataFrame, definition: str, limit: int = 2048, cutter: Cutter = Words) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, a row for each row of ``docs``.

    definition: the text of a tokenizer's JSON file. The number of tokens is that of
    the tokenizer's own encoding without special tokens around it; strings of added
    tokens inside a text count as these tokens. ``over_limit`` tells whether there
    are more than ``limit``. A null or empty text has 0 bytes and 0 tokens. Rows that
    repeat an id, and rows without one, are counted each for itself; columns other
    than ``doc_id`` and ``text`` are ignored; an empty table gives no rows. Texts of
    any length are read whole, one block of at most 4096 documents or 16 MiB (or one
    longer text) at a time.

    ``Words`` needs a tokenizer that drops white space (else an error);
    ``PreTokens`` works for every one.
    """
    spark = docs.sparkSession
    cutter(definition)
    sent = spark.sparkContext.broadcast(definition)
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BLOCK_BYTES)}):
        postings = save(read.mapInArrow(_postings(sent, cutter), _POSTINGS), "postings", batch=BLOCK_ROWS)
    counts = (
        postings.where("bucket >= 0")
        .select("block", "bucket", "start", "body")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_counted(sent, cutter), "block long, start int, body binary")
    )
    none = F.lit(None).cast("array<long>")
    rows = (
        postings.where("bucket < 0")
        .select("block", "start", "doc_ids", "sizes", "body")
        .unionByName(counts.select("block", "start", none.alias("doc_ids"), none.alias("sizes"), "body"))
        .repartition("block")
        .sortWithinPartitions("block", "start")
    )
    return rows.mapInArrow(_summed, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
