"""WARC archives as a table of record chunks.

A payload longer than one chunk is written as a record and its continuation
records, so neither writer nor reader ever builds a whole oversized record; both
carry the digest along from chunk to chunk. Archives are gzip files of a bounded
number of chunks, written and listed by Spark, so any store that Spark reaches
will do. Equal payloads are stored once: the others are revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.scratch import discard, save, settings
from evenkeel.llm.text import batched, rows

CHUNK = 1 << 16
# Chunks in one archive; with CHUNK it bounds an archive's size before compression.
ARCHIVE_CHUNKS = 2048
REVISIT_BYTES = 1000
_END = b"\r\n\r\n"


def records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, payload, digest, record_type, refers_to)`` for each page.

    Of equal payloads of ``least`` bytes or more, the largest ``page_id`` is the
    response (with its repeated rows, if any) and the others revisit it; a page
    without id always revisits if another with an id is equal. A null html is an
    empty payload.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"), F.xxhash64("payload").alias("check")
    )
    key = ["digest", "bytes", "check"]
    repeated = (
        read.where(F.col("bytes") >= least)
        .groupBy(*key)
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1 and last is not null")
        .drop("pages")
    )
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return read.join(repeated, key, "left").select(
        "page_id",
        "url",
        F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("last")).alias("refers_to"),
    )


def write_archives(found: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``records`` as ``*.txt.gz`` WARC archives below ``path``."""
    blocks = found.select("page_id", "url", "payload", "digest", "record_type", "refers_to").mapInArrow(
        _blocks(date), "block binary"
    )
    with settings(found.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        (
            blocks.select(F.col("block").cast("string").alias("value"))
            .write.option("lineSep", _END.decode())
            .option("compression", "gzip")
            .option("maxRecordsPerFile", ARCHIVE_CHUNKS)
            .text(path)
        )


def _blocks(date: str):
    schema = pa.schema([("block", pa.binary())])

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        # Names records apart even where pages repeat an id.
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, (page_id, url, payload, digest, kind, refers_to) in enumerate(rows(batches)):
            page = "" if page_id is None else page_id
            name = f"<urn:page:{page}:{task}.{number}>"
            running = hashlib.sha1()
            starts = range(0, max(1, len(payload)), CHUNK)
            for chunk, start in enumerate(starts):
                piece = payload[start : start + CHUNK]
                running.update(piece)
                fields = [
                    ("WARC-Type", kind if chunk == 0 else "continuation"),
                    ("WARC-Record-ID", name if chunk == 0 else f"<urn:page:{page}:{task}.{number}.{chunk}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", "%20", url or "urn:none")),
                    ("WARC-Block-Digest", "sha1:" + hashlib.sha1(piece).hexdigest()),
                ]
                if chunk == 0:
                    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
                if refers_to is not None:
                    fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
                    fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
                if len(starts) > 1:
                    fields.append(("WARC-Segment-Number", str(chunk + 1)))
                    if chunk:
                        fields.append(("WARC-Segment-Origin-ID", name))
                    if chunk == len(starts) - 1:
                        if running.hexdigest() != digest:
                            raise ValueError(f"payload of {name} does not have its digest")
                        fields.append(("WARC-Segment-Total-Length", str(len(payload))))
                fields.append(("Content-Type", "text/html; charset=utf-8"))
                fields.append(("Content-Length", str(len(piece))))
                head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
                yield (head.encode() + piece,)

    return lambda batches: batched(made(batches), schema)


_CHUNK_TYPE = (
    "record_id string, page_id long, chunk_no int, segmented boolean, record_type string, "
    "refers_to long, declared string, bytes long, digest string, payload binary"
)
_CHUNKS = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("chunk_no", pa.int32()),
        ("segmented", pa.bool_()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("declared", pa.string()),
        ("bytes", pa.int64()),
        ("digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The chunk table of the archives below ``path``: a row per record and chunk number.

    ``record_id`` names the record a chunk belongs to, ``bytes`` and ``digest`` are
    the chunk's own. Without ``payloads`` the payload is left out where a chunk is
    the whole record. The archives are inflated and parsed as streams.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parsed(payloads), _CHUNK_TYPE)


_OWN_ID = re.compile(r"<urn:page:(-?\d+)(?:[:.][\d.]+)?>")


def _page(name: str | None) -> int | None:
    """The page id in a record id that this writer made; ids of others hold none."""
    own = _OWN_ID.fullmatch(name or "")
    return int(own[1]) if own else None


def _hex_digest(declared: str | None) -> str | None:
    """A declared SHA-1 as lower-case hex, also from base32; None for other algorithms."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _parsed(payloads: bool):
    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for (content,) in rows(batches):
            for fields, piece in _stream(content):
                name = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                segment = fields.get("warc-segment-number")
                if fields.get("content-type", "").startswith("application/http") and segment in (None, "1"):
                    # The payload follows the head of the HTTP message.
                    piece = piece.partition(_END)[2]
                yield (
                    name,
                    _page(name),
                    int(segment or 1) - 1,
                    segment is not None,
                    fields["warc-type"],
                    _page(fields.get("warc-refers-to")),
                    _hex_digest(fields.get("warc-payload-digest")),
                    len(piece),
                    hashlib.sha1(piece).hexdigest(),
                    piece if payloads or segment else None,
                )

    return lambda batches: batched(chunks(batches), _CHUNKS)


def _stream(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record; holds one chunk at a time.

    An archive may be one gzip member, one for each record, or anything between.
    """
    engine = zlib.decompressobj(31)
    held, fed, start = bytearray(), b"", 0

    def more() -> bool:
        nonlocal engine, fed, start
        if not fed:
            fed = content[start : start + (1 << 16)]
            start += 1 << 16
            if not fed:
                if content and not engine.eof:
                    raise ValueError("an archive ends inside a gzip member")
                return False
        if engine.eof:
            engine = zlib.decompressobj(31)
        held.extend(engine.decompress(fed, 1 << 18))
        fed = engine.unused_data if engine.eof else engine.unconsumed_tail
        return True

    while True:
        while (end := held.find(_END)) < 0 and more():
            pass
        if end < 0:
            if held.strip():
                raise ValueError("an archive ends inside a record header")
            return
        lines = held[:end].decode().split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields["content-length"])
        body = end + len(_END)
        while len(held) < body + length + len(_END) and more():
            pass
        if len(held) < body + length:
            raise ValueError("an archive ends inside a record")
        yield fields, bytes(held[body : body + length])
        del held[: body + length + len(_END)]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all responses and revisits.

    Digests are computed from the payloads read: chunks of a segmented record meet
    in order and one running digest goes over them. A revisit gets the length of
    the record it refers to. A payload whose digest differs from the declared one
    is an error; one without a declared SHA-1 is taken as it is. Records whose id
    another writer made have no ``page_id``; other kinds of records are passed over.
    """
    parsed = read_archives(spark, path, payloads=False)
    chunks = save(parsed, "chunks", batch=1)
    whole = chunks.where("not segmented").drop("chunk_no", "segmented", "payload")
    joined = (
        chunks.where("segmented")
        .repartition("record_id")
        .sortWithinPartitions("record_id", "chunk_no")
        .mapInArrow(_joined, _WHOLE_TYPE)
    )
    found = whole.unionByName(joined).where("record_type in ('response', 'revisit')")
    wrong = F.concat(F.lit("payload digest differs in "), F.col("record_id"))
    checked = found.withColumn(
        "digest",
        F.when(F.col("record_type") == "revisit", F.col("declared"))
        .when(F.col("declared").isNull() | (F.col("digest") == F.col("declared")), F.col("digest"))
        .otherwise(F.raise_error(wrong)),
    )
    responses = (
        checked.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "digest")
        .agg(F.max("bytes").alias("referred"))
    )
    return checked.join(responses, ["refers_to", "digest"], "left").select(
        "page_id",
        F.when(F.col("record_type") == "revisit", F.col("referred")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


_WHOLE_TYPE = (
    "record_id string, page_id long, record_type string, refers_to long, declared string, "
    "bytes long, digest string"
)


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([f for f in _CHUNKS if f.name not in ("chunk_no", "segmented", "payload")])

    def found():
        head, running, total = None, None, 0
        for name, page, chunk, _, kind, refers_to, declared, size, _, piece in rows(batches):
            if head is None or name != head[0]:
                if head is not None:
                    yield *head, total, running.hexdigest()
                head, running, total = (name, page, kind, refers_to, declared), hashlib.sha1(), 0
            running.update(piece)
            total += size
        if head is not None:
            yield *head, total, running.hexdigest()

    return batched(found(), schema)


def archived(pages: DataFrame, path: str) -> DataFrame:
    """Write all pages below ``path`` and read them back; see ``read_records``."""
    found = save(records(pages), "records")
    write_archives(found, path)
    discard(found)
    return read_records(pages.sparkSession, path)
