"""Token ids in files of compressed byte or bit planes with a chunk index."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import materialise, scratch_dir, select_id_text
from .bpe import CONTRACTIONS
from .pieces import PieceIds, byte_slices
from .store import dealt, new_file, open_store, partition_id

#: Ids of a chunk, and of a file before a task goes on to another.
CHUNK_IDS, FILE_IDS = 1 << 17, 1 << 26
#: Documents of a part of a file's list of documents.
PART_DOCS = 1 << 14
#: Pieces of words that a worker remembers.
CACHE = 600_000
MAGIC = b"PLN1"
_FOOTER = struct.Struct("<QQ4s")  # where the index begins, its bytes, the magic
_ODD = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]|<\|")
#: Pieces that the public splitter leaves as they are and whose bytes the merges know as characters.
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|(?:(?!<\|)[!-/:-@\[-`{-~])+")
#: What is fixed of the public tokenizer: how it normalises, how it splits.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_SPLITTER = [{"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "ByteLevel"]


def _kinds() -> np.ndarray:
    kind = np.full(256, 4, np.uint8)
    kind[33:127] = 3
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[48:58] = 2
    kind[[9, 10, 11, 12, 13, 32]] = 0
    return kind


#: Bytes: 0 white space, 1 letters, 2 digits, 3 other printable ASCII, 4 all else; and with A-Z lower-cased.
_KIND, _LOWER = _kinds(), np.frombuffer(bytes(range(256)).lower(), np.uint8)


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, word by word; words end at ASCII white space.

    The library's own normaliser, splitter and merges make the ids of each new word, many words in one call; what the
    words had is looked up after that. Words that may hold a special token, or characters that some call white space and
    others don't, go through the library's whole encoding. Where the tokenizer's normaliser and splitter are the public
    ones (``_NORMALIZER``, ``_SPLITTER``), words of ASCII characters are cut by bytes and only merged by the library.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        apart = [self.whole.encode(x, add_special_tokens=False).ids for x in ("one", "two;", " \t one\n\n two; ")]
        if apart[0] + apart[1] != apart[2] or self.whole.normalizer is None or self.whole.pre_tokenizer is None:
            raise ValueError(f"the tokenizer of {path} doesn't drop white space")
        self.normal, self.splitter, self.merge = self.whole.normalizer.normalize_str, self.whole.pre_tokenizer.pre_tokenize_str, self.whole.model.tokenize
        self.pieces: dict[str, bytes] = {}
        rules = json.loads(self.whole.to_str())
        self.public = [x["type"] for x in rules["normalizer"].get("normalizers", [])] == _NORMALIZER and [x.get("pattern", x["type"]) for x in rules["pre_tokenizer"].get("pretokenizers", [])] == _SPLITTER
        self.ids_of = PieceIds(self.make)

    def _piece(self, piece: str) -> bytes:
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        ids = self.pieces[piece] = b"".join([t.id.to_bytes(4, "little") for t in self.merge(piece)])
        return ids

    def make(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words or of pieces of ASCII words, one behind the other, how many each has)."""
        data = raw.tobytes()
        words = [data[a:b].decode() for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
        lists, rest = [b""] * len(words), range(len(words))
        if self.public:
            rest = []
            for i, word in enumerate(words):
                if _CUT.fullmatch(word):
                    lists[i] = b"".join([t.id.to_bytes(4, "little") for t in self.merge(word)])
                else:
                    rest.append(i)
        odd = [i for i in rest if _ODD.search(words[i])] if _ODD.search(" ".join([words[i] for i in rest])) else []
        for i, found in zip(odd, self.whole.encode_batch([words[i] for i in odd], add_special_tokens=False), strict=True):
            lists[i] = np.array(found.ids, "<i4").tobytes()
        if odd:
            rest = sorted(set(rest) - set(odd))
        if rest:
            plain = self.normal(" ".join([words[i] for i in rest]))
            spaces = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), "<u4") == 32)
            if len(spaces) != len(rest) - 1:
                raise ValueError("normalised words hold white space")
            pieces, known = self.splitter(plain), self.pieces
            parts = [known.get(p) or self._piece(p) for p, _ in pieces]
            owner = np.searchsorted(spaces, np.fromiter((at[0] for _, at in pieces), np.int64, len(pieces)))
            first = np.searchsorted(owner, np.arange(len(rest) + 1)).tolist()
            for i, a, b in zip(rest, first, first[1:], strict=False):
                lists[i] = parts[a] if b == a + 1 else b"".join(parts[a:b])
        return np.frombuffer(b"".join(lists), "<i4"), np.fromiter(map(len, lists), np.int64, len(lists)) >> 2

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 offsets of the texts' ids) of texts that lie one behind the other."""
        n, text = int(offsets[-1]), np.zeros(len(raw), bool)
        text[offsets] = True  # words end with their text
        kind = _KIND[raw]
        begins, ends = np.empty(n, bool), np.empty(n, bool)
        inside = kind[:n] != 0
        begins[:1], ends[-1:] = inside[:1], inside[-1:]
        begins[1:] = inside[1:] & (~inside[:-1] | text[1:n])
        ends[:-1] = inside[:-1] & (~inside[1:] | text[1:n])
        start = np.flatnonzero(begins)
        if self.public and len(start):
            raw = _LOWER[raw]
            tag = np.flatnonzero((raw[: n - 1] == 60) & (raw[1:n] == 124))
            kind[tag] = 4
            whole = np.logical_or.reduceat(kind[:n] == 4, start)  # such words aren't cut
            cut = np.zeros(n, bool)
            cut[1:] = (kind[1:n] != kind[: n - 1]) | (kind[1:n] == 2)
            cut &= inside & ~begins
            # an apostrophe alone takes the letters of a contraction
            alone = np.flatnonzero((raw[:n] == 39) & (begins | cut))
            alone = alone[(alone + 1 < n) & ~ends[alone]]
            alone = alone[kind[alone + 1] == 1]
            a, b, size = raw[alone + 1], raw[alone + 2], np.zeros(len(alone), np.int64)
            for x in CONTRACTIONS:
                fits = a == ord(x[0]) if len(x) == 1 else (a == ord(x[0])) & (b == ord(x[1])) & ~ends[alone + 1]
                size[fits & (size == 0)] = len(x)
            alone, size = alone[size > 0], size[size > 0]
            cut[alone + 1] = False
            go_on = ~ends[alone + size]
            cut[alone[go_on] + size[go_on] + 1] = True
            at = np.flatnonzero(cut)
            at = at[~whole[np.searchsorted(start, at, "right") - 1]]
            begins[at] = True
            ends[at - 1] = True
            start = np.flatnonzero(begins)
        ids, counts = self.ids_of(raw, start, np.flatnonzero(ends) + 1 - start)
        at = np.concatenate([[0], np.cumsum(counts)])
        return ids, at[np.searchsorted(start, offsets)]


_encoders: dict[str, WordEncoder] = {}


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The chunk's byte planes (least significant first), or its bit planes (most significant first)."""
    if not bits:
        return [p.tobytes() for p in np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)]
    cells = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return [np.packbits(p).tobytes() for p in np.ascontiguousarray(cells.T)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.ascontiguousarray(np.array([np.frombuffer(p, np.uint8) for p in planes]).T).view("<u4").ravel()
    cells = np.array([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes])
    return np.ascontiguousarray(np.packbits(cells.T, axis=1)).view(">u4").ravel().astype("<u4")


class PlaneWriter:
    """A file of chunks; the index at its end has each chunk's ids and planes, and the documents' ids and lengths."""

    def __init__(self, out, bits: bool = False, level: int = 3) -> None:
        self.out, self.bits, self.packer = out, bits, zstandard.ZstdCompressor(level=level)
        self.at = self.n_ids = self.waiting = self.n_docs = 0
        self.parts: list[np.ndarray] = []
        self.chunks: list[tuple[int, list[tuple[int, int]]]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.lists: list[tuple[int, int]] = []
        self._put(MAGIC + bytes([bits]))

    def _put(self, data: bytes) -> tuple[int, int]:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def _chunk(self, ids: np.ndarray) -> None:
        self.chunks.append((len(ids), [self._put(self.packer.compress(p)) for p in to_planes(ids, self.bits)]))

    def _list(self) -> None:
        docs, self.docs = self.docs[:PART_DOCS], self.docs[PART_DOCS:]
        keys = np.array([k or 0 for k, _ in docs], "<i8")
        sizes = np.array([n for _, n in docs], "<i8")
        none = np.packbits([k is None for k, _ in docs])
        self.lists.append(self._put(self.packer.compress(struct.pack("<Q", len(keys)) + keys.tobytes() + sizes.tobytes() + none.tobytes())))

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents with their ids, one behind the other, and how many each has."""
        self.docs += zip(doc_ids, sizes.tolist(), strict=True)
        self.n_docs += len(doc_ids)
        self.parts.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        while len(self.docs) >= PART_DOCS:
            self._list()
        if self.waiting >= CHUNK_IDS:
            held = np.concatenate(self.parts)
            full = len(held) // CHUNK_IDS * CHUNK_IDS
            for i in range(0, full, CHUNK_IDS):
                self._chunk(held[i : i + CHUNK_IDS])
            self.parts, self.waiting = [held[full:]], len(held) - full

    def close(self) -> None:
        if self.waiting:
            self._chunk(np.concatenate(self.parts))
        if self.docs:
            self._list()
        index = [struct.pack("<QQ", len(self.chunks), len(self.lists))]
        index += [struct.pack("<QQ", n, len(planes)) + b"".join(struct.pack("<QQ", *p) for p in planes) for n, planes in self.chunks]
        index += [struct.pack("<QQ", *x) for x in self.lists]
        at, size = self._put(b"".join(index))
        self._put(_FOOTER.pack(at, size, MAGIC))


class PlaneFile:
    """Reads what :class:`PlaneWriter` wrote, chunk by chunk."""

    def __init__(self, uri: str) -> None:
        system, path = open_store(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        at, length, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        head = self.file.read_at(5, 0)
        if magic != MAGIC or head[:4] != MAGIC:
            raise ValueError(f"{uri} isn't a file of planes")
        self.bits = bool(head[4])
        index = self.file.read_at(length, at)
        n_chunks, n_lists = struct.unpack_from("<QQ", index)
        self.chunks, self.lists, at = [], [], 16
        for _ in range(n_chunks):
            n, planes = struct.unpack_from("<QQ", index, at)
            self.chunks.append((n, [struct.unpack_from("<QQ", index, at + 16 + 16 * i) for i in range(planes)]))
            at += 16 + 16 * planes
        for i in range(n_lists):
            self.lists.append(struct.unpack_from("<QQ", index, at + 16 * i))

    def _get(self, place: tuple[int, int]) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(place[1], place[0]))

    def chunk(self, i: int) -> np.ndarray:
        n, planes = self.chunks[i]
        return from_planes([self._get(p) for p in planes], n, self.bits)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in the order of the file."""
        held, next_chunk = np.zeros(0, "<u4"), 0
        for place in self.lists:
            raw = self._get(place)
            n = struct.unpack_from("<Q", raw)[0]
            keys, sizes = np.frombuffer(raw, "<i8", n, 8).tolist(), np.frombuffer(raw, "<i8", n, 8 + 8 * n).tolist()
            none = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 + 16 * n), count=n).tolist()
            for key, size, void in zip(keys, sizes, none, strict=True):
                if len(held) < size:
                    parts, have = [held], len(held)
                    while have < size:
                        parts.append(self.chunk(next_chunk))
                        have += len(parts[-1])
                        next_chunk += 1
                    held = np.concatenate(parts)
                yield None if void else key, held[:size]
                held = held[size:]


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 2, bits: bool = False, level: int = 3) -> DataFrame:
    """Write the ids of all texts in ascending order of doc_id; returns ``file, n_docs, n_ids`` in that order by ``file``.

    Texts are dealt out in ranges of doc_id and encoded where they are written; a task begins another file after
    ``FILE_IDS`` ids. A null text is empty and has the end id alone; null ids come first; rows that repeat an id stay,
    in the order of their texts. No documents make no files. A lost attempt leaves no file under its name.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = WordEncoder(vocabulary)
        coder, part, number = _encoders[vocabulary], partition_id(), 0
        slices = byte_slices(batches)
        next_ = next(slices, None)
        while next_ is not None:
            name = f"ids-{part:06d}-{number:04d}.planes"
            with new_file(folder, name) as out:
                writer = PlaneWriter(out, bits, level)
                while next_ is not None and writer.n_ids < FILE_IDS:
                    keys, raw, offsets = next_
                    ids, ends = coder.encode(raw, offsets)
                    if end_id is not None:
                        ids, ends = np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))
                    writer.add(keys.to_pylist(), ids, np.diff(ends))
                    next_ = next(slices, None)
                writer.close()
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64())], ["file", "n_docs", "n_ids"])

    ordered = select_id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialise(ordered.mapInArrow(run, "file string, n_docs long, n_ids long"))


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document, from the files of a manifest.

    ``start`` counts the ids of all documents before; for it the manifest's rows, one for each file, are added up in
    order. The files are dealt out to a task each, up to ``store.READERS`` tasks.
    """
    bases = manifest.select("file", (F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))).alias("base"))
    placed = materialise(bases.select("file", F.coalesce("base", F.lit(0)).alias("base")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, at = [], base
                for key, ids in PlaneFile(uri).documents():
                    rows.append((key, at, len(ids), zlib.crc32(ids.tobytes()), ids.tolist() if with_ids else None))
                    at += len(ids)
                    if len(rows) == 2048:
                        yield _rows(rows, with_ids)
                        rows = []
                yield _rows(rows, with_ids)

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return dealt(placed, "file").mapInArrow(run, kind)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names, kinds = ["doc_id", "start", "n_tokens", "ids_crc32"], [pa.int64()] * 4
    if with_ids:
        names, kinds = [*names, "ids"], [*kinds, pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2, bits: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from files written and read back."""
    return read(write(docs, scratch_dir(docs.sparkSession), vocabulary, end_id, bits))
