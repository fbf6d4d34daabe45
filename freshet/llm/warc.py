"""WARC archives in seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch_dir
from .store import dealt, new_file, open_store, partition_id

#: Payloads of fewer bytes are stored as they are, even where they repeat.
LEAST_REVISIT = 100
#: Bytes of records in a frame, and of frames in a bundle.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 256 << 20
#: Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record with its blank lines; a revisit has the HTTP head of the full payload and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


_ID = re.compile(rb"<urn:page:(-?\d+|none)>")


def _page(value: bytes) -> int | None:
    found = _ID.fullmatch(value)
    return None if not found or found[1] == b"none" else int(found[1])


def read_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that begins at ``at``, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/1.1\r\n", at):
        raise ValueError(f"no record at {at}")
    head = dict(line.split(b": ", 1) for line in data[at:end].split(b"\r\n")[1:])
    body = end + 4
    after = body + int(head[b"Content-Length"])
    if data[after : after + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} has no end")
    split = data.index(b"\r\n\r\n", body) + 4
    length = int(re.search(rb"Content-Length: (\d+)", data[body:split])[1])
    url = head.get(b"WARC-Target-URI")
    out = {
        "page_id": _page(head[b"WARC-Record-ID"]),
        "url": None if url is None else url.decode(),
        "record_type": head[b"WARC-Type"].decode(),
        "refers_to": _page(head.get(b"WARC-Refers-To", b"")),
        "payload_bytes": length,
        "payload_digest": head[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"),
        "payload": data[split:after] if head[b"WARC-Type"] == b"response" else None,
    }
    if out["payload"] is not None and (len(out["payload"]) != length or hashlib.sha256(out["payload"]).hexdigest() != out["payload_digest"]):
        raise ValueError(f"the payload of record {out['page_id']} isn't what was written")
    return out, after + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: compressed and full size of each frame, their number, the magic."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


@dataclass
class Bundle:
    """Random access to the frames of a bundle by the seek table at its end."""

    uri: str

    def __post_init__(self) -> None:
        system, path = open_store(self.uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{self.uri} has no seek table")
        table = self.file.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for i in range(n):
            packed, full = struct.unpack_from("<II", table, 8 * i)
            self.frames.append((at, packed, full))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, full = self.frames[i]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=full)


def _writer(folder: str, date: str, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part, number = zstandard.ZstdCompressor(level=level), partition_id(), 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            name, written, frames, index = f"bundle-{part:06d}-{number:04d}.warc.zst", 0, [], []
            with new_file(folder, name) as out:
                frame: list[bytes] = []
                size = 0

                def end_frame() -> None:
                    nonlocal size, written
                    data = packer.compress(b"".join(frame))
                    out.write(data)  # noqa: B023
                    frames.append((len(data), size))  # noqa: B023
                    written += len(data)
                    frame.clear()  # noqa: B023
                    size = 0

                while row is not None and written < BUNDLE_BYTES:
                    page_id, url, html, digest, refers_to = row
                    data = record(page_id, url, html or b"", digest, refers_to, date)
                    index.append((page_id, f"{folder}/{name}", len(frames), size, len(data)))
                    frame.append(data)
                    size += len(data)
                    if size >= FRAME_BYTES:
                        end_frame()
                    row = next(rows, None)
                if frame:
                    end_frame()
                out.write(seek_table(frames))
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in index], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))], ["page_id", "bundle", "frame", "offset", "length"])

    return run


def plan(pages: DataFrame) -> DataFrame:
    """``page_id, url, html binary, digest, refers_to``: which record each page gets.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the one with the smallest page_id is the response. Null html
    is an empty payload; a page without id is always a response, and so is a repeated row of the response itself. Only
    ids and digests meet by digest; the html moves once, dealt out by page.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html")).withColumn("digest", F.sha2("html", 256))
    small = rows.where(F.length("html") >= LEAST_REVISIT).where("page_id is not null").select("page_id", "digest")
    first = materialise(small.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("digest", "refers_to"))
    revisits = small.join(first, "digest").where("page_id <> refers_to").distinct()
    return rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write the pages' records as bundles below ``folder``; returns the index ``page_id, bundle, frame, offset, length``.

    A task writes its records into frames of about ``FRAME_BYTES`` and goes on to another bundle after ``BUNDLE_BYTES``.
    Offsets are relative to the frame's content. An attempt that is lost leaves no bundle under its name; the next
    writes the same names again. No pages make no bundles.
    """
    return materialise(plan(pages).mapInArrow(_writer(folder, date, level), INDEX))


def _arrow(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))


def read(index: DataFrame) -> DataFrame:
    """Every record of the bundles that an index names, frame by frame; digests of payloads are checked.

    Bundles are dealt out to a task each, up to ``store.READERS`` tasks.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                bundle = Bundle(uri)
                for i in range(len(bundle.frames)):
                    data, at, rows = bundle.frame(i), 0, []
                    while at < len(data):
                        row, at = read_record(data, at)
                        rows.append(row)
                    yield _arrow(rows)

    return dealt(materialise(index.select("bundle").distinct()), "bundle").mapInArrow(run, RECORD)


def lookup(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records with the given ``page_id``s: each needed frame is read once, the others not at all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, data = None, b""
        bundles: dict[str, Bundle] = {}
        for batch in batches:
            rows = []
            for uri, frame, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (uri, frame) != last:
                    if uri not in bundles:
                        bundles = {uri: Bundle(uri)}
                    last, data = (uri, frame), bundles[uri].frame(frame)
                rows.append(read_record(data, offset)[0])
            yield _arrow(rows)

    wanted = index.join(ids.select("page_id").distinct(), "page_id", "left_semi").select("bundle", "frame", "offset")
    return wanted.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of all pages, from archives written and read."""
    index = write(pages, scratch_dir(pages.sparkSession))
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
