r"""WARC archives as a chunked record table.

A payload is a sequence of rows (record identifier, chunk number, bytes). Written, each row is one WARC/1.1 record: the
first holds the head, later ones are ``continuation`` segments, so that no reader or writer after the source ever holds
more than one chunk of a payload. Digests are carried from chunk to chunk. Chunks end between characters, and no
chunk holds the version line that starts a record, which the reader splits on: it is cut wherever a payload has it.

Archives are ordinary text files of Spark, record separator ``\r\n\r\n``, whole-file gzip by default. An
uncompressed archive is split between tasks when read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.storage import scratch_path

CHUNK_BYTES = 32 << 10
_BETWEEN = "\r\n\r\nWARC/1.1\r\n"
_WARC_DATE = "2024-01-01T00:00:00Z"  # records carry no time of their own
_BATCH_BYTES = 4 << 20
CHUNKS = "record_id string, page_id long, chunk_no int, record_type string, refers_to long, payload_bytes long, payload_digest string, closed boolean, data binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: 40 bits at a time."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` of every row.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the largest page id
    is the response, the others revisit it; rows that repeat that page id too are responses like it. A null
    id is smaller than any other; if all are null, all are responses. Null payloads are empty.

    Groups are reduced before they are shuffled, and only those with several rows are joined back.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": base32_sha1(F.col("payload"))})
    groups = (
        rows.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("target"), F.count("*").alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return rows.join(groups, "digest", "left").withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("refers_to")),
            "target": F.when(revisit, F.col("target")),
        }
    )


def chunks(payload: memoryview | bytes, size: int = CHUNK_BYTES) -> Iterator[memoryview]:
    """Views of a payload, at least one: cut between characters, and inside each version line of a record."""
    view = memoryview(payload)
    cuts = [m.start() + 2 for m in re.finditer(rb"WARC/1\.1\r\n", view)] + [len(view)]
    at = 0
    for cut in cuts:
        while cut - at > size:
            stop = at + size
            while stop > at + 1 and view[stop] & 0xC0 == 0x80:
                stop -= 1
            yield view[at:stop]
            at = stop
        if at < cut or cut == len(view):
            yield view[at:cut]
        at = cut


def _uri(text: str | None) -> str:
    return quote(text or "about:blank", safe="!#$%&'()*+,/:;=?@[]~")


def _segments(page_id, url, payload: memoryview, kind: str, refers_to, target, record_id: str, size: int, digest: str) -> Iterator[bytes]:
    """The records of one payload, each without the separator that follows it."""
    head = [
        f"WARC-Date: {_WARC_DATE}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        block = b"HTTP/1.1 200 OK\r\n\r\n"
        head += [
            "WARC-Type: revisit",
            f"WARC-Record-ID: <{record_id}>",
            f"WARC-Target-URI: {_uri(url)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Target-URI: {_uri(target)}",
            f"X-Refers-To-Page-Id: {refers_to}",
            "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}",
        ]
        yield "\r\n".join(head).encode() + b"\r\n\r\n" + block
        return
    running, seen = hashlib.sha1(), 0
    parts = chunks(payload, size)
    part = next(parts)
    number = 1
    while part is not None:
        following = next(parts, None)
        running.update(part)
        seen += len(part)
        lines = [*head, f"X-Chunk-Digest: sha1:{base64.b32encode(running.digest()).decode()}"]
        block = b""
        if number == 1:
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
            lines += ["WARC-Type: response", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {_uri(url)}", "Content-Type: application/http;msgtype=response"]
            if following is not None:
                lines.append("WARC-Segment-Number: 1")
        else:
            lines += ["WARC-Type: continuation", f"WARC-Record-ID: <{record_id}.{number}>", f"WARC-Segment-Origin-ID: <{record_id}>", f"WARC-Segment-Number: {number}"]
            if following is None:
                lines.append(f"WARC-Segment-Total-Length: {seen}")
        lines.append(f"Content-Length: {len(block) + len(part)}")
        yield b"".join(("\r\n".join(lines).encode(), b"\r\n\r\n", block, part))
        part, number = following, number + 1


def _records(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = row = 0
        for batch in batches:
            plain = {c: batch.column(c).to_pylist() for c in ("page_id", "url", "record_type", "refers_to", "target", "digest")}
            payloads = batch.column("payload")
            for i in range(batch.num_rows):
                row += 1
                fields = [plain[c][i] for c in ("record_type", "refers_to", "target")]
                record_id = f"urn:x-page:{plain['page_id'][i]}:{task}:{row}"
                for record in _segments(plain["page_id"][i], plain["url"][i], memoryview(payloads[i].as_buffer()), *fields, record_id, chunk_bytes, plain["digest"][i]):
                    held.append(b"WARC/1.1\r\n" + record)
                    size += len(record)
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary()).cast(pa.string())})
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary()).cast(pa.string())})

    return run


def write_archives(pages: DataFrame, path: str, *, chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> None:
    """Write every row of ``page_id, url, html`` as a WARC record, one archive per task."""
    records = plan_records(pages).mapInArrow(_records(chunk_bytes), "value string")
    records.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows of archive records. A record that is one chunk is digested at once and needs no data."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in CHUNK_NAMES}
        records = pc.cast(batch.column("value"), pa.large_binary())
        for i in range(len(records)):
            view = memoryview(records[i].as_buffer())
            raw = bytes(view[: 4 << 10]) if len(view) > 4 << 10 else bytes(view)
            end = raw.find(b"\r\n\r\n")
            if end < 0:
                raw = bytes(view)
                end = raw.find(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in raw[:end].decode().split("\r\n") if ": " in line)
            if "WARC-Type" not in fields:
                continue
            kind = fields["WARC-Type"]
            # The exact length decides: what follows it belongs to the separator.
            block = view[end + 4 : end + 4 + int(fields["Content-Length"])]
            if kind != "continuation":
                body = bytes(block[:512]).find(b"\r\n\r\n") + 4
                block = block[body:]
            number = int(fields.get("WARC-Segment-Number", 0))
            known = kind == "revisit"
            whole = number == 0 and not known
            page, target = fields["X-Page-Id"], fields.get("X-Refers-To-Page-Id")
            row = (
                (fields.get("WARC-Segment-Origin-ID") or fields["WARC-Record-ID"])[1:-1],
                int(page) if page else None,
                number,
                kind,
                int(target) if target else None,
                int(fields["X-Payload-Length"]) if known else len(block),
                fields["WARC-Payload-Digest"][5:] if known else base64.b32encode(hashlib.sha1(block).digest()).decode() if whole else fields["X-Chunk-Digest"][5:],
                known or whole,
                None if known or whole else bytes(block),
            )
            for c, value in zip(CHUNK_NAMES, row):
                out[c].append(value)
        yield pa.RecordBatch.from_pydict({c: pa.array(out[c], t) for c, t in zip(CHUNK_NAMES, _TYPES)})


CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]


def read_chunks(spark: SparkSession, path: str, *, segmented: bool | None = None) -> DataFrame:
    """The chunked record table of archives (columns ``CHUNKS``); only (un)segmented records if asked."""
    lines = spark.read.option("lineSep", _BETWEEN).text(path)
    if segmented is not None:
        is_segment = F.contains(F.substring_index("value", "\r\n\r\n", 1), F.lit("WARC-Segment-Number: "))
        lines = lines.filter(is_segment if segmented else ~is_segment)
    return lines.mapInArrow(_parse, CHUNKS)


def _join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and digest of records whose chunks arrive in order; state is one running digest."""
    current, running, size, first = None, None, 0, None

    def closed():
        return pa.RecordBatch.from_pydict(
            {
                "page_id": pa.array([first[0]], pa.int64()),
                "payload_bytes": pa.array([size], pa.int64()),
                "payload_digest": pa.array([base64.b32encode(running.digest()).decode()]),
                "record_type": pa.array([first[1]], pa.string()),
                "refers_to": pa.array([None], pa.int64()),
            }
        )

    for batch in batches:
        ids, pages, kinds = (batch.column(c).to_pylist() for c in ("record_id", "page_id", "record_type"))
        digests, data = batch.column("payload_digest").to_pylist(), batch.column("data")
        for i, record in enumerate(ids):
            if record != current:
                if current is not None:
                    yield closed()
                current, running, size, first = record, hashlib.sha1(), 0, (pages[i], kinds[i])
            running.update(memoryview(data[i].as_buffer()))
            size += len(data[i].as_buffer())
            if base64.b32encode(running.digest()).decode() != digests[i]:
                raise ValueError(f"chunk of {record} does not continue the chunks before it")
    if current is not None:
        yield closed()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record of archives.

    Records in one chunk are digested where they are read. Only the chunks of longer ones are shuffled,
    by record and in order, and digested as they pass; their carried digests are compared on the way.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    long = (
        read_chunks(spark, path, segmented=True)
        .repartition("record_id")
        .sortWithinPartitions("record_id", "chunk_no")
        .mapInArrow(_join_chunks, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    )
    return read_chunks(spark, path, segmented=False).select(*names).unionByName(long)


def roundtrip_report(pages: DataFrame, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder and report the records read back from them."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, chunk_bytes=chunk_bytes)
    return read_records(pages.sparkSession, path)
