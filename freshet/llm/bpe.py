"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices."""

from __future__ import annotations

import base64

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, select_id_text
from .pieces import PieceIds, byte_slices, spread

_NONE = np.int32(2**31 - 1)
#: Upper ends of the length buckets; a longer piece is a matrix of one row.
BUCKETS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
#: Rows of a matrix are limited so that rows x width stays below this.
CELLS = 1 << 20
#: Ids that are decoded at once.
DECODED = 1 << 20
#: White space as the pattern's ``\s`` has it (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What follows an apostrophe in the pattern's contractions.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """Rank of a pair of ids: open addressing in two arrays, looked up for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        bits = max(4, (2 * len(pairs)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        keys = np.array([(a + 1) << 32 | (b + 1) for a, b in pairs], np.uint64)
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):  # each free slot takes one of the keys that want it, the others step on
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            done = self.keys[slot] == keys
            self.ranks[slot[done]] = ranks[done]
            keys, ranks, slot = keys[~done], ranks[~done], (slot[~done] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape = left.shape
        keys = ((left.astype(np.int64) + 1) << 32 | (right.astype(np.int64) + 1)).astype(np.uint64).ravel()
        out = np.full(keys.shape, _NONE, np.int32)
        slot, at = self._slot(keys), np.arange(len(keys))
        while len(at):
            found = self.keys[slot]
            hit = found == keys
            out[at[hit]] = self.ranks[slot[hit]]
            go = ~hit & (found != 0)
            keys, at, slot = keys[go], at[go], (slot[go] + np.uint64(1)) & self.mask
        return out.reshape(shape)


class Splitter:
    """Matches of the public pattern in many texts at once.

    The pattern's matches are runs of letters, of numbers, of white space and of other characters, but that one space
    before a run joins it, other white space leaves its last character alone before a run, and an apostrophe alone takes
    the letters of a contraction.
    """

    def __init__(self) -> None:
        """Class of each character: 0 white space, 1 letter, 2 number, 3 other."""
        self.of = np.full(0x110000, 3, np.uint8)
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        every = points.astype("<u4").tobytes().decode("utf-32-le")
        for k, pattern in enumerate((f"[{WHITE}]", r"\p{L}", r"\p{N}")):
            for run in regex.finditer(f"{pattern}+", every):
                self.of[points[run.start() : run.end()]] = k
        self.ascii = np.append(self.of[:128], np.full(128, 3, np.uint8))

    def classes(self, raw: np.ndarray) -> np.ndarray:
        """Class of each byte's character."""
        kind = self.ascii[raw]
        lead = np.flatnonzero(raw >= 0xC0)
        if len(lead):
            first = raw[lead].astype(np.int32)
            point = (first & 0x1F) << 6 | raw[lead + 1] & 0x3F
            three, four = first >= 0xE0, first >= 0xF0
            at = lead[three]
            point[three] = (first[three] & 0x0F) << 12 | (raw[at + 1] & 0x3F).astype(np.int32) << 6 | raw[at + 2] & 0x3F
            at = lead[four]
            point[four] = (first[four] & 0x07) << 18 | (raw[at + 1] & 0x3F).astype(np.int32) << 12 | (raw[at + 2] & 0x3F).astype(np.int32) << 6 | raw[at + 3] & 0x3F
            found = self.of[point]
            kind[lead] = kind[lead + 1] = found
            kind[lead[three] + 2] = found[three]
            kind[lead[four] + 3] = found[four]
        return kind

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where each piece begins, its bytes) of texts that lie one behind the other, ``PAD`` zeros behind the last."""
        n = int(offsets[-1])
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = self.classes(raw)[:n]
        new_text = np.zeros(n + 1, bool)
        new_text[offsets] = True
        begins = new_text[:n].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        run = np.flatnonzero(begins)
        end = np.append(run[1:], n)
        kinds, cut = kind[run], begins  # cut: where pieces begin
        space = np.flatnonzero((kinds == 0) & ~new_text[end])  # white space before a run of the same text
        last = end[space] - 1
        joins = raw[last] == 32
        while (inner := (raw[last] & 0xC0) == 0x80).any():
            last = last - inner
        cut[last] = True
        cut[end[space[joins]]] = False
        alone = (kinds == 3) & (end - run == 1) & (raw[run] == 39) & cut[run] & ~new_text[end]
        alone[:-1] &= kinds[1:] == 1
        alone[-1:] = False
        letters = end[alone]
        a, b = raw[letters], raw[letters + 1]
        size = np.zeros(len(letters), np.int64)
        for x in CONTRACTIONS:
            fits = a == ord(x[0]) if len(x) == 1 else (a == ord(x[0])) & (b == ord(x[1]))
            size[fits & (size == 0)] = len(x)
        inside = letters[size > 0]
        cut[inside] = False
        after, until = inside + size[size > 0], end[np.flatnonzero(alone)[size > 0] + 1]
        cut[after[after < until]] = True
        start = np.flatnonzero(cut)
        return start, np.diff(np.append(start, n))


class BytePairEncoder:
    """Ids of texts by the ranks of byte strings; a merged pair's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if pattern != public_tokenizers.PATTERN:
            raise ValueError("only the public pattern's matches are made here")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.rank_of = PairTable(pairs)
        two = np.arange(65536)
        self.of_bytes = self.rank_of(self.byte_id[two >> 8], self.byte_id[two & 255])
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        self.token_size, self.token_at = size, np.cumsum(size) - size
        self.token_bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)
        # Pieces that are a token are that token, as far as their own merges don't say so anyway.
        self.whole: dict[bytes, int] = {}
        tokens = list(ranks)
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids, n = self.merge(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length)
        for i in np.flatnonzero((n > 1) | (ids[np.cumsum(n) - n] != np.fromiter(ranks.values(), np.int64, len(ranks)))):
            self.whole[tokens[i]] = ranks[tokens[i]]
        self.split, self.ids_of = Splitter(), PieceIds(self.merge)

    def merge(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces, one behind the other, how many each has), bucket by bucket."""
        bucket, count, found = np.searchsorted(BUCKETS, size), np.zeros(len(size), np.int64), []
        for k in np.unique(bucket):
            rows = np.flatnonzero(bucket == k)
            step = max(1, CELLS // BUCKETS[k]) if k < len(BUCKETS) else 1
            for i in range(0, len(rows), step):
                some = rows[i : i + step]
                ids, count[some] = self._merge(raw, start[some], size[some], BUCKETS[k]) if k < len(BUCKETS) else self._merge_one(raw[start[some[0]] :][: size[some[0]]])
                found.append((some, ids))
        first = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for rows, ids in found:
            out[spread(first[rows], count[rows])] = ids
        if self.whole:
            pieces = [raw[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist(), strict=True)]
            parts = [np.array([self.whole[p]], np.int32) if p in self.whole else out[a : a + n] for p, a, n in zip(pieces, first, count, strict=True)]
            out, count = np.concatenate([out[:0], *parts]), np.array([len(p) for p in parts], np.int64)
        return out, count

    def _merge(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces of at most ``width`` bytes: a matrix with a column for each piece, padded to ``width``."""
        n, size, row = len(start), size.copy(), np.arange(width)[:, None]
        data = raw[np.minimum(start + row, len(raw) - 1)]
        ids = self.byte_id[data]
        # ranks of neighbours, shifted so that a position goes below: the least is the leftmost of the smallest rank
        rank = np.where(row[1:] < size, self.of_bytes[data[:-1].astype(np.int32) << 8 | data[1:]], _NONE).astype(np.int64) << 8
        none = np.int64(_NONE) << 8
        out, count, column = np.zeros((width, n), np.int32), size.copy(), np.arange(n)
        while width > 1:
            best = rank[0].copy()
            for k in range(1, width - 1):
                np.minimum(best, rank[k] | k, out=best)
            open_ = best < none
            if (left := np.count_nonzero(open_)) < 0.75 * len(best) or not left:  # pieces that are ready leave
                over = ~open_
                out[:width, column[over]], count[column[over]] = ids[:, over], size[over]
                column, size, best, width = column[open_], size[open_], best[open_], int(size[open_].max()) if left else 0
                ids, rank, open_ = ids[:width, :][:, over == 0], rank[: max(width - 1, 0), :][:, over == 0], open_[open_]
                if not left:
                    break
            at = np.where(open_, best & 255, 512)
            # compaction: what stands right of the merged pair moves one place to the left
            for k in range(1, width):
                right = at < k
                if k < width - 1:
                    np.copyto(ids[k], ids[k + 1], where=right)
                    np.copyto(rank[k - 1], rank[k], where=at < k - 1)
                else:
                    rank[k - 1][at < k - 1] = none
            col = np.flatnonzero(open_)
            at = at[col]
            ids[at, col] = best[col] >> 8
            size[col] -= 1
            for near in (at - 1, at):  # only the pairs beside the merged one change
                ok = (near >= 0) & (near + 1 < size[col])
                c, p = col[ok], near[ok]
                rank[p, c] = self.rank_of(ids[p, c], ids[p + 1, c]).astype(np.int64) << 8
                ends = (near >= 0) & (near + 1 >= size[col]) & (near < width - 1)
                rank[near[ends], col[ends]] = none
            if (new := int(size.max())) < width:
                width = new
                ids, rank = ids[:width], rank[: max(width - 1, 0)]
        if len(column):
            out[:width, column], count[column] = ids, size
        return out.T[np.arange(len(out)) < count[:, None]], count

    def _merge_one(self, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of one long piece, a matrix of one row.

        A round merges all places of the smallest rank from left to right, where no merge makes a pair of a smaller
        rank: then the leftmost-first order is the same. Else it merges the leftmost one alone.
        """
        ids = self.byte_id[piece]
        rank = self.rank_of(ids[:-1], ids[1:])
        while len(rank) and (best := rank.min()) != _NONE:
            at = np.flatnonzero(rank == best)
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1]))  # of aaaa every second place only
            first = at[np.searchsorted(run, run)]
            at = at[(at - first) % 2 == 0]
            while True:
                kept = np.ones(len(ids), bool)
                kept[at + 1] = False
                new = ids.copy()
                new[at] = best
                right = at[at + 2 < len(ids)]
                least = self.rank_of(new[right], ids[right + 2]).min(initial=_NONE)
                new, place = new[kept], at - np.arange(len(at))
                left, right = place[place > 0], place[place + 1 < len(new)]
                before, after = self.rank_of(new[left - 1], new[left]), self.rank_of(new[right], new[right + 1])
                if len(at) == 1 or min(least, before.min(initial=_NONE), after.min(initial=_NONE)) > best:
                    break
                at = at[:1]
            ids, rank = new, np.append(rank, _NONE)[kept][:-1]
            rank[left - 1], rank[right] = before, after
        return ids, np.array([len(ids)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 offsets of the texts' ids) of texts that lie one behind the other."""
        start, size = self.split(raw, offsets)
        ids, n = self.ids_of(raw, start, size)
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids, ends[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, how many each id has)."""
        size = self.token_size[ids]
        if not size.all():
            raise ValueError("an id that the vocabulary lacks")
        return self.token_bytes[spread(self.token_at[ids], size)], size


def encoder(path: str, pattern: str) -> BytePairEncoder:
    """One encoder for a worker and vocabulary."""
    return kept((path, pattern), lambda: BytePairEncoder(read_ranks(path), pattern))


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text, by ranks in a file that each executor has at ``vocabulary``.

    No shuffle; a worker holds one slice of texts, a bounded table of pieces and matrices of bounded size. A null text
    is empty and has no ids, repeated rows and null ids pass through, other columns are not read. Only the public
    pattern is known; any other is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, pattern)
        for keys, raw, offsets in byte_slices(batches):
            ids, ends = coder.encode(raw, offsets)
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return select_id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded binary``: the bytes that the ids stand for. An id that the vocabulary lacks is an error.

    Null ids are none, and stand for no bytes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, pattern)
        for batch in batches:
            lists = batch.column(1)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            first = 0
            while first < len(lists):
                after = max(first + 1, int(np.searchsorted(ends, ends[first] + DECODED, "right")) - 1)
                ids = lists.slice(first, after - first).flatten().to_numpy()
                raw, size = coder.decode(ids)
                at = np.concatenate([[0], np.cumsum(size)])[ends[first : after + 1] - ends[first]].astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), after - first, [None, pa.py_buffer(at), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, after - first) for c in batch.columns), decoded], ["doc_id", "ids", "decoded"])
                first = after

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what :func:`decode` returns."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
