"""WARC: write page records into monolithic gzip archives, normalise them to one member per record, index and read them.

An archive arrives as one gzip stream around all its records, which allows no random access. ``normalize`` inflates that
stream once, finds the records by their Content-Length and deflates each one as a gzip member of its own; the sidecar index
says where each member starts and how long it is, so ``read_members`` can inflate any record alone.

Archives travel as rows ``(archive, content binary)`` of bounded size, so Spark's own writers and commit protocol place them
in the shared folder and a lost executor only costs a task; ``export_files`` puts the same bytes into plain ``.warc.gz`` files.

Defined results: a null or empty html is an empty payload; a null url is written as an empty target; records of equal
payload of at least ``MIN_REVISIT`` bytes become one response (least page_id) and revisits of it; an empty table gives an
empty archive table; extra columns are ignored. Repeated page ids keep their own records, and copies under the least id are all
responses. A null page_id is written as an empty id, is always a response and answers for no other record.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, utf8

MIN_REVISIT = 100
#: Bytes of records after which an archive is closed.
ARCHIVE_BYTES = 4 << 20
CRLF = b"\r\n"


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, size, record_type, refers_to: which record answers for a payload, which revisit it."""
    rows = pages.select(
        F.col("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        utf8("html").alias("payload"),
    ).select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    # one row per payload that occurs more than once; partial aggregation keeps hot payloads cheap
    first = (
        rows.filter(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("digest", "first_id")
    )
    # as a written table its size is known to the planner: small ones are broadcast, large ones joined by a shuffle
    first = materialize(first, "warc_payloads")
    revisit = F.col("first_id").isNotNull() & (F.col("page_id") != F.col("first_id"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html;charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + CRLF * 2 + payload + CRLF * 2


def parse_record(raw: bytes | memoryview, at: int = 0) -> tuple[dict[str, str], int, int]:
    """Headers of the record at ``at``, start and end of its payload."""
    raw = bytes(raw) if isinstance(raw, memoryview) else raw
    end = raw.index(CRLF * 2, at)
    lines = raw[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return head, end + 4, end + 4 + int(head["Content-Length"])


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows (archive, content): monolithic gzip streams. A revisit carries its payload too, so every record can be read alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(number: int, packer, parts: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([b"".join(parts) + packer.flush()], pa.binary())], names=["archive", "content"])

        number, size, parts, packer = 0, 0, [], None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                if packer is None:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record_bytes(*(c[i].as_py() for c in columns))
                parts.append(packer.compress(raw))
                size += len(raw)
                if size >= archive_bytes:
                    yield close(number, packer, parts)
                    number, size, parts, packer = number + 1, 0, [], None
        if packer is not None:
            yield close(number, packer, parts)

    return records.mapInArrow(run, "archive int, content binary").select(
        F.format_string("part-%05d-%05d.warc.gz", F.spark_partition_id(), "archive").alias("archive"), "content"
    )


def normalize_stream(content: bytes, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Inflate a gzip stream once, piece by piece; yield (record start in the inflated stream, record as its own gzip member)."""
    inflater, held, start, pos = zlib.decompressobj(31), bytearray(), 0, 0
    while True:
        # concatenated members are one logical stream
        if inflater.eof:
            rest = inflater.unused_data
            if not rest and pos >= len(content):
                break
            inflater, piece = zlib.decompressobj(31), rest
            if not piece:
                piece, pos = content[pos : pos + chunk], pos + chunk
        elif pos >= len(content):
            break
        else:
            piece, pos = content[pos : pos + chunk], pos + chunk
        held += inflater.decompress(piece)
        while (at := held.find(CRLF * 2)) >= 0:
            _, begin, end = parse_record(bytes(held[: at + 4]))
            if len(held) < end + 4:
                break
            raw = bytes(held[: end + 4])
            yield start, gzip.compress(raw, 6, mtime=0)
            start += len(raw)
            del held[: len(raw)]
    if held or not inflater.eof:
        raise ValueError("truncated archive")


def normalize(archives: DataFrame) -> DataFrame:
    """Rows (archive, content, index): per-record gzip members and the sidecar index of their offsets.

    ``index`` is an array of (record, offset, length, stream_offset): place of the member in the new archive and of the
    record in the inflated stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist(), strict=True):
                members, index, offset = [], [], 0
                for n, (start, member) in enumerate(normalize_stream(content)):
                    members.append(member)
                    index.append({"record": n, "offset": offset, "length": len(member), "stream_offset": start})
                    offset += len(member)
                kind = pa.list_(pa.struct([("record", pa.int32()), ("offset", pa.int64()), ("length", pa.int32()), ("stream_offset", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(members)], pa.binary()), pa.array([index], kind)], names=["archive", "content", "index"])

    return archives.select("archive", "content").mapInArrow(run, "archive string, content binary, index array<struct<record:int,offset:bigint,length:int,stream_offset:bigint>>")


def read_members(normalized: DataFrame) -> DataFrame:
    """Every record of normalised archives, each inflated alone at its indexed place, payload included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "record", "page_id", "url", "record_type", "refers_to", "payload_digest", "payload"]
        for batch in batches:
            for name, content, index in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist(), batch.column("index").to_pylist(), strict=True):
                rows = []
                for x in index:
                    raw = gzip.decompress(content[x["offset"] : x["offset"] + x["length"]])
                    head, begin, end = parse_record(raw)
                    number = lambda field: int(n) if (n := head.get(field, "").rpartition(":")[2].rstrip(">")) else None  # noqa: B023, E731
                    rows.append((name, x["record"], number("WARC-Record-ID"), head["WARC-Target-URI"], head["WARC-Type"], number("WARC-Refers-To"), head["WARC-Payload-Digest"].partition(":")[2], raw[begin:end]))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return normalized.mapInArrow(run, "archive string, record int, page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload binary")


def export_files(normalized: DataFrame, uri: str) -> DataFrame:
    """Put archives and sidecar indexes as plain files below ``uri`` (a place all executors reach); rows (archive, bytes).

    A task writes under a name of its own and renames at the end, so a repeated task leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names, sizes = batch.column("archive").to_pylist(), []
            for name, content, index in zip(names, batch.column("content").to_pylist(), batch.column("index").to_pylist(), strict=True):
                side = "".join(json.dumps(x) + "\n" for x in index).encode()
                for file, data in ((name, content), (f"{name}.idx", side)):
                    with store.open_output_stream(temp := f"{root}/.{file}.{uuid.uuid4().hex}") as out:
                        out.write(data)
                    store.move(temp, f"{root}/{file}")
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["archive", "bytes"])

    return normalized.mapInArrow(run, "archive string, bytes bigint")


def warc_round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, normalise, read back: one row per record with its payload as read from its own member."""
    written = materialize(write_archives(plan_records(pages), archive_bytes), "warc")
    return read_members(materialize(normalize(written), "warc_members"))


def digests(records: DataFrame) -> DataFrame:
    return records.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", "refers_to",
    )


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> f THEN f END AS refers_to
FROM m
"""
