"""Media columns in Ogg: pages with checksums, packets laced over segments, multiplexed logical streams, granule times.

``mux`` stores a payload as one of the logical streams of an Ogg file (8-bit samples, one granule each), beside a small
text stream that describes it; ``demux`` walks the pages, verifies each checksum, sorts pages to logical streams, puts
packets together again from lacing values (also over page borders) and derives times from granule positions.

Defined results: a null text is an empty payload, padded to 64 zero bytes; equal texts give equal files; an empty table gives
an empty table; extra columns stay out. A damaged page raises ``ValueError`` in ``demux``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_batches, utf8

HEADER = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
SAMPLE_RATE = 8000
PACKET = 4096
PAGE_SEGMENTS = 255
AUDIO, NOTES = 1, 2
#: Bits of each byte in reverse order.
REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(page: bytes) -> int:
    """CRC-32 of Ogg (polynomial 04c11db7, no reflection, start 0), by way of zlib's reflected CRC over reversed bits."""
    return int(f"{zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def pages_of(packets: list[tuple[bytes, int]], serial: int) -> list[tuple[int, bytes]]:
    """(granule of the last packet that ends there or -1, page) of one logical stream; packets are (data, granule at the end)."""
    segments: list[tuple[bytes, int | None, bool]] = []  # data, granule where a packet ends, whether it goes on a packet
    for data, granule in packets:
        for i in range(0, len(data) + 1, 255):
            piece = data[i : i + 255]
            segments.append((piece, granule if len(piece) < 255 else None, i > 0))
    out = []
    for sequence, i in enumerate(range(0, len(segments), PAGE_SEGMENTS)):
        part = segments[i : i + PAGE_SEGMENTS]
        ended = [g for _, g, _ in part if g is not None]
        granule = ended[-1] if ended else -1
        flags = CONTINUED * part[0][2] | FIRST * (i == 0) | LAST * (i + PAGE_SEGMENTS >= len(segments))
        head = HEADER.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(part))
        page = head + bytes(len(s) for s, _, _ in part) + b"".join(s for s, _, _ in part)
        out.append((granule, page[:22] + struct.pack("<I", checksum(page)) + page[26:]))
    return out


def mux(payload: bytes, packet: int = PACKET, rate: int = SAMPLE_RATE) -> bytes:
    """An Ogg file of two logical streams, their pages interleaved; first pages lead, as the format asks."""
    audio = [(struct.pack("<8sIB", b"PCM8\0\0\0\0", rate, 1), 0)]
    audio += [(payload[i : i + packet], min(i + packet, len(payload))) for i in range(0, len(payload), packet)]
    notes = [(b"NOTES", 0), (f"samples={len(payload)}".encode(), len(payload))]
    a, b = pages_of(audio, AUDIO), pages_of(notes, NOTES)
    half = 1 + (len(a) - 1) // 2
    return b"".join(page for _, page in [a[0], *([] if len(b) < 1 else [b[0]]), *a[1:half], *b[1:], *a[half:]])


def demux(data: bytes) -> dict[int, dict]:
    """Per serial: packets [(data, granule or None)], pages, first and last granule, seconds."""
    streams: dict[int, dict] = {}
    at, size = 0, len(data)
    while at < size:
        if size - at < HEADER.size:
            raise ValueError("cut page header")
        mark, version, flags, granule, serial, sequence, crc, count = HEADER.unpack_from(data, at)
        if mark != b"OggS" or version:
            raise ValueError(f"no page at byte {at}")
        lacing = data[at + 27 : at + 27 + count]
        body = at + 27 + count
        end = body + sum(lacing)
        if end > size or len(lacing) < count:
            raise ValueError("cut page")
        page = data[at:end]
        if checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            raise ValueError(f"checksum of the page at byte {at}")
        s = streams.setdefault(serial, {"packets": [], "held": [], "pages": 0, "last": 0, "ended": False})
        if bool(flags & FIRST) != (s["pages"] == 0) or sequence != s["pages"] or bool(flags & CONTINUED) != bool(s["held"]):
            raise ValueError(f"page {sequence} of stream {serial} is out of order")
        s["pages"] += 1
        finished = []
        for n in lacing:
            s["held"].append(data[body : body + n])
            body += n
            if n < 255:
                finished.append(b"".join(s["held"]))
                s["held"] = []
        # a page's granule belongs to the last packet that ends on it
        s["packets"] += [(p, granule if i == len(finished) - 1 else None) for i, p in enumerate(finished)]
        if granule >= 0:
            s["last"] = granule
        s["ended"] = bool(flags & LAST)
        at = end
    for s in streams.values():
        if s.pop("held") or not s["ended"]:
            raise ValueError("a stream isn't complete")
    return streams


def padded(data: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of 64: none where the length is one already."""
    return data + bytes(-len(data) % 64 if data else 64)


def encode_media(docs: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_bytes, media): each text as an Ogg file."""

    def run(batch: pa.RecordBatch) -> list:
        texts = batch.column(1).to_pylist()
        return [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array((mux(padded(x)) for x in texts), pa.binary())]

    return map_batches(docs.select(key, utf8(column).alias("text")), run, f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes bigint, media binary")


def decode_media(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read media bytes back: payload, packets, pages, duration and level features of each file."""

    def run(batch: pa.RecordBatch) -> list:
        import numpy as np

        out = []
        for data in batch.column(2).to_pylist():
            streams = demux(data)
            audio = streams[AUDIO]
            rate = struct.unpack_from("<I", audio["packets"][0][0], 8)[0]
            payload = b"".join(p for p, _ in audio["packets"][1:])
            samples = np.frombuffer(payload, np.uint8).astype(np.int64)
            energy, steps = int(((samples - 128) ** 2).sum()), int(np.abs(np.diff(samples)).sum())
            feature = f"pages={audio['pages'] + streams[NOTES]['pages']};packets={len(audio['packets']) - 1};ms={audio['last'] * 1000 // rate};mean={int(samples.sum()) * 1000 // len(samples)};energy={energy // len(samples)};steps={steps // len(samples)}"
            out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]

    return map_batches(media.select(key, "n_bytes", "media"), run, f"{key} {media.schema[key].dataType.simpleString()}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
