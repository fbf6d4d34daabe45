"""Ids of byte strings, made once and then looked up for whole arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one step of a Python worker handles together.
SLICE_BYTES = 2_000_000
#: Free bytes behind the text of a slice, so that every piece can be read 16 bytes at once.
PAD = 16
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def byte_slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, bytes with ``PAD`` zeros behind, n + 1 offsets of the texts) of (id, text) rows in slices of about ``most`` bytes.

    A null text is empty; one longer than ``most`` is a slice of its own.
    """
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            part = np.zeros(offsets[after] - offsets[first] + PAD, np.uint8)
            part[: len(part) - PAD] = raw[offsets[first] : offsets[after]]
            yield batch.column(0).slice(first, after - first), part, offsets[first : after + 1] - offsets[first]
            first = after


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., ``size[0]`` of them, then those of start[1] and so on."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_places(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each word begins, its bytes) of texts that lie one behind the other; words end at ASCII white space."""
    n, text = int(offsets[-1]), np.zeros(len(raw), bool)
    text[offsets] = True  # and with their text
    inside = ~_SPACE[raw[:n]]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | text[1:n]
    ends[:-1] &= ~inside[1:] | text[1:n]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1 - start


def low_and_high(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 bytes and the next 8 of each piece as integers, zeros behind the piece."""
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    high = np.zeros(len(start), np.uint64)
    over = np.flatnonzero(size > 8)
    high[over] = eights[start[over] + 8] & _MASK[np.minimum(size[over] - 8, 8)]
    return eights[start] & _MASK[np.minimum(size, 8)], high


class PieceIds:
    """Ids of pieces of bytes. Pieces of up to 16 bytes are remembered in a table with open addressing.

    A piece's key is the piece itself, as two integers and its length, so that no two pieces share one. ``make`` gets
    (bytes, starts, sizes) of pieces that aren't known and returns (their ids, one behind the other, how many each has);
    it is called for longer pieces each time. The table is emptied when it is full.
    """

    def __init__(self, make: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], bits: int = 21) -> None:
        self.make, self.bits = make, bits
        self.most, self.step = (1 << bits) * 7 // 10, 1 << min(18, bits - 2)
        self.clear()

    def clear(self) -> None:
        #: Rows of: first 8 bytes, next 8 bytes, length | number of ids << 8 | place in the pool << 16 (0: free).
        self.table = np.zeros((1 << self.bits, 3), np.uint64)
        self.pool, self.used, self.filled = np.zeros(1 << self.bits, np.int32), 0, 0

    def _append(self, ids: np.ndarray) -> int:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(ids), len(self.pool)), np.int32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def __call__(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, one behind the other, how many each piece has); ``raw`` has ``PAD`` bytes behind the pieces."""
        parts = [self._part(raw, start[i : i + self.step], size[i : i + self.step]) for i in range(0, len(start), self.step)]
        if len(parts) == 1:
            return parts[0]
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _part(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.filled + len(start) > self.most:
            self.clear()
        if not (short := size <= 16).all():
            rows = np.flatnonzero(~short)
            long_ids, long_n = self.make(raw, start[rows], size[rows])
            meta = np.zeros(len(start), np.int64)
            meta[short] = self._found(raw, start[short], size[short])
            at = self._append(long_ids)  # only until the ids are put together
            n = meta >> 8 & 0xFF
            n[rows], meta[rows] = long_n, (at + np.cumsum(long_n) - long_n) << 16
            out = self.pool[spread(meta >> 16, n)], n
            self.used = at
            return out
        meta = self._found(raw, start, size)
        n = meta >> 8 & 0xFF
        return self.pool[spread(meta >> 16, n)], n

    def _found(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        low, high = low_and_high(raw, start, size)
        mixed = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F)) ^ size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        slot = ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - self.bits)).astype(np.int64)
        table, last, keys, new = self.table, (1 << self.bits) - 1, size.astype(np.uint64), []
        at = np.arange(len(start))
        while len(at):
            row = table[slot[at]]
            free = at[row[:, 2] == 0]
            if len(free):  # a free slot takes one of the pieces that want it
                s = slot[free]
                table[s, 0], table[s, 1], table[s, 2] = low[free], high[free], keys[free] | start[free].astype(np.uint64) << np.uint64(16)
                new.append(s)
                row = table[slot[at]]
            other = (row[:, 0] != low[at]) | (row[:, 1] != high[at]) | (row[:, 2] & np.uint64(0xFF) != keys[at])
            at = at[other]
            slot[at] = slot[at] + 1 & last
        if new:
            slots = np.unique(np.concatenate(new))
            meta = table[slots, 2].astype(np.int64)
            ids, n = self.make(raw, meta >> 16, meta & 0xFF)
            first = self._append(ids)
            table[slots, 2] = meta & 0xFF | n << 8 | (first + np.cumsum(n) - n) << 16
            self.filled += len(slots)
        return table[slot, 2].astype(np.int64)
