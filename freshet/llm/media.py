"""Media columns: ordered text and media references from HTML, payloads resolved by digest."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, select_id_text, text_slices, utf8
from .html_text import _TOKEN

#: Samples in a row of an image, which is also what payloads are padded to.
WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol table tr td th blockquote pre section article figure figcaption br hr header footer main aside nav body".split())
_SILENT = frozenset(("script", "style", "template", "noscript", "title"))

#: Elements without markup in them, and what ends them.
_UNPARSED = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
_ATTRIBUTE = re.compile(r"""([^\s/>="'][^\s/>=]*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")

SEQUENCE = "array<struct<pos:int,kind:string,text:string,ref:string,caption:string>>"


def payload_of(text: str) -> bytes:
    """The text's UTF-8 with bytes 0 up to a positive multiple of ``WIDTH``."""
    raw = utf8(text)
    return raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b"\0")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(payload: bytes, level: int = 6) -> bytes:
    """A PNG of 8-bit grey samples, ``WIDTH`` in a row, that holds the payload as it is."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)  # filter 0 before each row
    rows[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def from_image(media: bytes) -> bytes:
    """The payload of an image that :func:`to_image` made; checks each chunk."""
    if not media.startswith(_SIGNATURE):
        raise ValueError("no PNG")
    at, size, data = len(_SIGNATURE), (0, 0), []
    while at < len(media):
        n, kind = struct.unpack_from(">I4s", media, at)
        body = media[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", media, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk of the PNG is damaged")
        if kind == b"IHDR":
            size = struct.unpack_from(">II", body)
            if body[8:] != bytes((8, 0, 0, 0, 0)):
                raise ValueError("only 8-bit grey images hold payloads")
        elif kind == b"IDAT":
            data.append(body)
        at += n + 12
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(size[1], size[0] + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered rows hold payloads")
    return rows[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Size, mean, deviation, a histogram of 16 bins and an average hash of 8 x 8 cells."""
    samples = np.frombuffer(payload, np.uint8)
    histogram = np.bincount(samples >> 4, minlength=16)
    rows = samples.reshape(-1, 8, WIDTH // 8).sum(axis=2, dtype=np.int64)
    cells = np.add.reduceat(rows, np.arange(8) * len(rows) // 8, axis=0) if len(rows) >= 8 else np.resize(rows, (8, 8))
    sizes = np.diff(np.append(np.arange(8) * len(rows) // 8, len(rows)))[:, None] if len(rows) >= 8 else 1
    means = cells / sizes
    average = np.packbits(means > means.mean()).tobytes().hex()
    return f"{WIDTH}x{len(samples) // WIDTH};mean={samples.mean():.4f};std={samples.std():.4f};hist={','.join(map(str, histogram))};ahash={average}"


def _attributes(raw: str) -> dict[str, str]:
    """Names in lower case and decoded values; of a name that is there twice the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = next((x for x in m.groups()[1:] if x is not None), "")
        found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return found


class _Figure:
    """Media of an open figure that aren't in an inner one; the last caption goes to those before it."""

    __slots__ = ("caption", "captioned", "media")

    def __init__(self) -> None:
        self.media: list[dict] = []
        self.caption: str | None = None
        self.captioned = 0


class _Sequence:
    """Text and media of a page in order; the caption of a figure goes to the media in it, else the alternative text does.

    ``silent``: elements whose text is none. A caption ends with its figure, or the page. One pass over the page's tokens,
    linear in its length however its elements nest, and whichever of them never end.
    """

    def __init__(self, silent: frozenset[str]) -> None:
        self.items: list[dict] = []
        self.pieces: list[str] = []
        self.silent, self.quiet = silent, Counter()
        self.figures: list[_Figure] = []
        self.caption: list[str] | None = None

    def feed(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            start = html.find("<", at)
            m = _TOKEN.match(html, start) if start >= 0 else None
            if start < 0 or not m:
                end = n if start < 0 else start + 1
                self.handle_data(html[at:end])
                at = end
                continue
            if start > at:
                self.handle_data(html[at:start])
            at = m.end()
            if not m[2]:
                continue  # a comment or a declaration
            tag = m[2].lower()
            if m[1]:
                self.handle_endtag(tag)
                continue
            closed = m[3].rstrip().endswith("/")
            self.handle_starttag(tag, m[3])
            if closed:
                self.handle_endtag(tag)
            elif tag in _UNPARSED:
                end = _UNPARSED[tag].search(html, at)
                at = end.start() if end else n

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.items.append({"kind": "text", "text": text, "ref": None, "caption": None})

    def end_caption(self) -> None:
        if self.caption is not None:
            text = " ".join("".join(self.caption).split())
            if text and self.figures:
                self.figures[-1].caption, self.figures[-1].captioned = text, len(self.figures[-1].media)
            self.caption = None

    def end_figure(self) -> None:
        self.end_caption()
        self.flush()
        figure = self.figures.pop()
        for item in figure.media[: figure.captioned]:
            item["caption"] = figure.caption

    def handle_starttag(self, tag: str, attributes: str) -> None:
        if tag in self.silent:
            self.quiet[tag] += 1
        elif tag in ("img", "video", "audio", "source", "embed"):
            own = _attributes(attributes)
            if own.get("src"):
                if self.caption is None:
                    self.flush()
                self.items.append({"kind": "media", "text": None, "ref": own["src"], "caption": own.get("alt") or own.get("title")})
                if self.figures:
                    self.figures[-1].media.append(self.items[-1])
        elif tag in _BLOCKS:
            if self.caption is None:
                self.flush()
            else:
                self.caption.append(" ")
            if tag == "figure":
                self.end_caption()
                self.figures.append(_Figure())
            elif tag == "figcaption" and self.figures:
                self.end_caption()
                self.caption = []

    def handle_endtag(self, tag: str) -> None:
        if tag in self.silent:
            self.quiet[tag] = max(0, self.quiet[tag] - 1)
        elif tag == "figcaption":
            self.end_caption()
        elif tag in _BLOCKS:
            if tag == "figure" and self.figures:
                self.end_figure()
            elif self.caption is None:
                self.flush()
            else:
                self.caption.append(" ")

    def handle_data(self, data: str) -> None:
        if not any(self.quiet.values()):
            (self.pieces if self.caption is None else self.caption).append(unescape(data) if "&" in data else data)

    def close(self) -> None:
        while self.figures:
            self.end_figure()
        self.flush()


def sequence_of(html: str) -> list[dict]:
    """``pos, kind, text, ref, caption`` of a page's texts and media in order; empty for a page without either.

    Figures may stand in figures: a caption goes to the media of its own. An element without text of its own (``title``,
    ``noscript``, ``template``) that never ends is taken as if it weren't there.
    """
    silent = _SILENT
    while True:
        parser = _Sequence(silent)
        parser.feed(html)
        parser.close()
        unclosed = {tag for tag, n in parser.quiet.items() if n and tag not in ("script", "style")}
        if not unclosed:
            return [{"pos": i, **{k: item[k] for k in ("kind", "text", "ref", "caption")}} for i, item in enumerate(parser.items)]
        silent -= unclosed


def sequences(pages: DataFrame, id_col: str = "doc_id", html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``doc_id, sequence``: ordered structs of text and media references of every page; null html has none.

    Null ids and repeated rows stay; a long page is parsed as a whole. Unclosed and nested elements: :func:`sequence_of`.
    Columns named in ``carry`` (64-bit integers) stay beside them.
    """
    carry = carry or []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))
        for batch in batches:
            html = [x or "" for x in batch.column(1).to_pylist()]
            for rows, texts in text_slices(list(range(len(html))), html):
                part = batch.slice(rows[0], len(rows))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([sequence_of(t) for t in texts], kind), *part.columns[2:]], ["doc_id", "sequence", *carry])

    kinds = "".join(f", {c} long" for c in carry)
    rows = pages.select(F.col(id_col).cast("long").alias("doc_id"), F.col(html_col).cast("string").alias("html"), *(F.col(c).cast("long").alias(c) for c in carry))
    return rows.mapInArrow(run, f"doc_id long, sequence {SEQUENCE}{kinds}")


def resolve(found: DataFrame, media: DataFrame, columns: list[str]) -> DataFrame:
    """``doc_id, pos, caption, digest`` and the given columns of ``media`` for every media reference ``sha256:digest``.

    Columns that ``found`` carries stay, too.

    ``media`` has one row for each digest. References meet it by digest, with their positions and captions beside them;
    one without a row keeps nulls, and references of other kinds have a null digest. Both sides are shuffled, so that
    Spark splits the references of a digest that many pages share.
    """
    carry = [c for c in found.columns if c not in ("doc_id", "sequence")]
    refs = found.select("doc_id", *carry, F.explode("sequence").alias("item")).where("item.kind = 'media'")
    refs = refs.select("doc_id", *carry, "item.pos", "item.caption", F.nullif(F.regexp_extract("item.ref", "^sha256:([0-9a-f]{64})$", 1), F.lit("")).alias("digest"))
    return refs.join(media.select("digest", *columns), "digest", "left").select("doc_id", *carry, "pos", "caption", "digest", *columns)


def interleaved(found: DataFrame, media: DataFrame) -> DataFrame:
    """``doc_id, sequence`` with the payload of each media item beside its position and caption, in page order.

    Rows of found are told apart by a row number of their own, so that repeated ids stay apart; a page's items are put
    together again, which are as many as the page had.
    """
    rows = materialise(found.withColumn("row", F.monotonically_increasing_id()))
    payloads = resolve(rows.select(F.col("row").alias("doc_id"), "sequence"), media, ["media"])
    by_row = payloads.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "media"))).alias("payloads"))
    joined = rows.join(by_row.withColumnRenamed("doc_id", "row"), "row", "left")
    return joined.select("doc_id", F.expr("transform(sequence, x -> named_struct('pos', x.pos, 'kind', x.kind, 'text', x.text, 'ref', x.ref, 'caption', x.caption, 'media', payloads[x.pos])) as sequence"))


def as_pages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, html, digest, media``: every text as an image, and a page that shows it by its digest.

    Equal texts have equal images; a task stores each digest once, later rows have a null media.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored: set[bytes] = set()
        for ids, texts in id_and_text(batches):
            rows = []
            for key, text in zip(ids, texts, strict=True):
                payload = payload_of(text)
                digest = hashlib.sha256(payload)
                new = digest.digest() not in stored
                stored.add(digest.digest())
                name = escape(f"document {key}")
                html = f'<article><p>{name}</p><figure><img src="sha256:{digest.hexdigest()}" alt="text"><figcaption>{name}</figcaption></figure></article>'
                rows.append((key, len(utf8(text)), html, digest.hexdigest(), to_image(payload) if new else None))
            if len(stored) > 1_000_000:
                stored.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "n_bytes", "html", "digest", "media"])

    return select_id_text(docs).mapInArrow(run, "doc_id long, n_bytes long, html string, digest string, media binary")


def described(media: DataFrame) -> DataFrame:
    """One row for each digest of ``digest, media``: what the decoded payload and the stored form are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digest, stored in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                image = stored.as_py()
                payload = from_image(image)
                sha = hashlib.sha256(payload).hexdigest()
                if sha != digest:
                    raise ValueError(f"the payload stored as {digest} has the digest {sha}")
                rows.append((digest, len(payload), sha, zlib.crc32(payload[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature_of(payload)))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], COLUMNS)

    kept = media.where("media is not null").select("digest", "media")
    kind = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return kept.mapInArrow(run, kind).dropDuplicates(["digest"])


COLUMNS = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def round_trip(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, pos, caption`` of every text.

    The images are written to the shared folder once and read back; features are computed for each digest and meet the
    pages' references by digest, beside their positions and captions, so that a text with many copies is decoded a few
    times and moved as a row of numbers. :func:`interleaved` moves the payloads themselves.
    A null text is empty; null ids and repeated rows stay; other columns aren't read; no documents, no rows.
    """
    stored = materialise(as_pages(docs))
    features = materialise(described(stored.select("digest", "media")))
    resolved = resolve(sequences(stored.select("doc_id", "n_bytes", "html"), carry=["n_bytes"]), features, COLUMNS[1:])
    return resolved.select("doc_id", "n_bytes", *COLUMNS[1:], "pos", "caption")
