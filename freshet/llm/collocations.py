"""Collocations by prefix-free parsing: overlapping chunks cut by their own content, n-grams counted once in each different chunk.

A piece of text is cut wherever the hash of two neighbouring words says so; both words end one chunk and begin the next.
Equal passages are cut alike, so the different chunks and how often each occurs (the dictionary and the parse's
frequencies) stand for the whole corpus. An n-gram of up to three words lies in the chunk in which its first word is not
among the two that the next chunk begins with: each occurrence is counted in one chunk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_CHARS, importable, materialise, utf8

#: Words that neighbouring chunks share; an n-gram has at most one more.
OVERLAP = 2
#: One in so many places begins a chunk.
MODULUS = 16
#: Different chunks that a task counts, and characters of chunks that it takes at once, before it passes them on.
COUNTED, CHARS = 200_000, 8_000_000
#: Least occurrences of a phrase; share of its occurrences, in percent, that makes a longer phrase its stand-in; rows of a language.
LEAST, COVERED, ROWS = 10, 50, 2000
#: Bits of a filter for each entry, and at most (32 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 28
#: Parts in which the first rows of a language are found.
SALTS = 64


def _pieces() -> bytes:
    table = bytearray(range(256))
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = 10
    table[9] = 32
    return bytes(table)


#: Bytes with what ends a piece as a line feed and what parts words as a space.
_PIECES = _pieces()
_RANDOM = np.random.default_rng(13).integers(1, 1 << 63, (64, 256), np.uint64)  # of a byte at a place; only cuts depend on it


def chunks(texts: list[str], modulus: int = MODULUS) -> Iterator[tuple[bytes, int]]:
    """(words joined by a space, of how many words it counts the n-grams that begin there) of every chunk of the texts."""
    raw = np.frombuffer((utf8("\n".join(texts)) + b"\n").lower().translate(_PIECES), np.uint8)
    letter = (raw != 10) & (raw != 32)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter])))
    start, end = edge[::2], edge[1::2]  # the last byte parts words, so that each word ends
    if not len(start):
        return
    piece = np.cumsum(raw == 10, dtype=np.int32)[start]
    size = end - start
    keep = letter.copy()
    keep[end] = True  # one separator behind each word
    compact = np.where(letter, raw, 32)[keep].astype(np.uint8)
    at = np.concatenate([[0], np.cumsum(size + 1)])
    place = np.arange(len(compact)) - np.repeat(at[:-1], size + 1)
    own = np.add.reduceat(_RANDOM[place & 63, compact], at[:-1])
    with np.errstate(over="ignore"):
        pair = own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]
        pair ^= pair >> np.uint64(32)
    first = np.concatenate([[True], piece[1:] != piece[:-1]])
    begins = first.copy()
    begins[1:-1] |= ~first[1:-1] & ~first[2:] & (pair[1:] % np.uint64(modulus) == 0)
    heads = np.flatnonzero(begins)
    nexts = np.append(heads[1:], len(start))
    cut = np.append(~first[heads[1:]], False)  # the next chunk begins in the same piece
    last = nexts + np.where(cut, OVERLAP, 0) - 1
    data = compact.tobytes()
    counts = (nexts - heads).tolist()
    for a, b, n in zip(at[heads].tolist(), (at[last] + size[last]).tolist(), counts, strict=True):
        yield data[a:b], n


def dictionary(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """``lang, chunk, own, n``: the different chunks of each language and how often they occur; a null lang is ``und``."""
    importable(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = [(lang, *key, n) for lang, of in counts.items() for key, n in of.items()]
            lang, chunk, own, n = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(chunk, pa.binary()).cast(pa.string()), pa.array(own, pa.int64()), pa.array(n, pa.int64())], ["lang", "chunk", "own", "n"])

        counts: dict[str, Counter] = {}
        for batch in batches:
            waiting: dict[str, list[str]] = {}
            chars = 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(text)
                chars += len(text)
                if chars > SLICE_CHARS:
                    for name, texts in waiting.items():
                        counts.setdefault(name, Counter()).update(chunks(texts, modulus))
                    waiting, chars = {}, 0
                    if sum(map(len, counts.values())) > COUNTED:
                        yield out()
                        counts.clear()
            for name, texts in waiting.items():
                counts.setdefault(name, Counter()).update(chunks(texts, modulus))
        yield out()

    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(run, "lang string, chunk string, own long, n long").groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


class Filter:
    """Bits at the hashes of entries: whatever was put in is there, few other things are."""

    def __init__(self, bits: int, raw: bytes) -> None:
        self.bits, self.raw = bits, raw

    @classmethod
    def of(cls, grams: DataFrame) -> Filter:
        """Of all rows' ``lang, phrase``; its size follows their number and ends at ``MOST_BITS``, beyond which it only lets more through."""
        bits = 1 << 15
        n = grams.count()
        while bits < min(FILTER_BITS * n, MOST_BITS):
            bits *= 2
        at = F.expr(f"(xxhash64(concat(lang, '\\0', phrase)) & {bits - 1}L) + 1")
        parts = grams.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
        raw = bytearray(bits // 8)
        for row in parts:
            raw[(row.part - 1) * 4096 : row.part * 4096] = row.bits
        return cls(bits, bytes(raw))

    def has(self, entries: list[bytes]) -> np.ndarray:
        """Entries are ``lang``, a zero byte and the phrase."""
        at = np.array([xxhash.xxh64_intdigest(x, 42) for x in entries], np.uint64).astype(np.int64) & (self.bits - 1)
        return np.frombuffer(self.raw, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights[order], first)


class _Words:
    """The words of some chunks as numbers."""

    def __init__(self, table: pa.Table) -> None:
        lists = pc.split_pattern(table.column("chunk").combine_chunks(), " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.values.dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        self.words, self.langs, self.code = coded.dictionary, langs.dictionary, coded.indices.to_numpy().astype(np.int64)
        size = np.diff(offsets)
        chunk = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(self.code)) - offsets[:-1][chunk]
        self.left = size[chunk] - place  # words from here to the chunk's end
        self.own = place < table.column("own").to_numpy()[chunk]
        self.n = table.column("n").to_numpy()[chunk]
        self.lang = langs.indices.to_numpy().astype(np.int64)[chunk]
        self.base = max(1, len(self.words))

    def _present(self, keep: np.ndarray, size: int) -> np.ndarray:
        """A number for language and one or two words from each place on."""
        key = self.lang[keep]
        for k in range(size):
            key = key * self.base + np.roll(self.code, -k)[keep]
        return key

    def text(self, key: np.ndarray, size: int) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) of numbers."""
        parts = []
        for _ in range(size):
            parts.append(self.words.take(pa.array(key % self.base)))
            key = key // self.base
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts[::-1], " ")
        return self.langs.take(pa.array(key)), phrase

    def known(self, keep: np.ndarray, size: int, filter_: Filter) -> np.ndarray:
        """Whether the filter has the phrase of ``size`` words at each place; False where ``keep`` is."""
        out = np.zeros(len(self.code), bool)
        at = np.flatnonzero(keep)
        if len(at):
            different, back = np.unique(self._present(at, size), return_inverse=True)
            lang, phrase = self.text(different, size)
            entries = pc.binary_join_element_wise(lang.cast(pa.binary()), phrase.cast(pa.binary()), b"\0").to_pylist()
            out[at] = filter_.has(entries)[back]
        return out

    def counted(self, size: int, words: Filter | None, pairs: Filter | None) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(language, phrase, occurrences) of the phrases of ``size`` words whose parts the filters have."""
        keep = self.own & (self.left >= size)
        if size == 1:
            key, n = _sums(self._present(keep, 1), self.n[keep])
            return *self.text(key, 1), pa.array(n)
        one = self.known(np.ones(len(self.code), bool), 1, words)
        both = one & np.roll(one, -1) & (self.left >= 2)
        if size == 2:
            keep &= both
            key, n = _sums(self._present(keep, 2), self.n[keep])
            return *self.text(key, 2), pa.array(n)
        both = self.known(both, 2, pairs)
        at = np.flatnonzero(keep & both & np.roll(both, -1))
        pair, whose = np.unique(self._present(at, 2), return_inverse=True)  # language and two words as one number, then the third
        key, n = _sums(whose.astype(np.int64) * self.base + self.code[at + 2] if len(at) else at, self.n[at])
        lang, two = self.text(pair[key // self.base], 2)
        return lang, pc.binary_join_element_wise(two, self.words.take(pa.array(key % self.base)), " "), pa.array(n)


def phrases(chunk_table: DataFrame, size: int, words: Filter | None = None, pairs: Filter | None = None) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``size`` (1 to 3) words. Those whose parts a filter lacks are left out; f is exact."""
    if not 1 <= size <= OVERLAP + 1:
        raise ValueError(f"chunks share {OVERLAP} words, so that phrases have 1 to {OVERLAP + 1}")
    shared = chunk_table.sparkSession.sparkContext.broadcast((words, pairs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = shared.value

        def out() -> pa.RecordBatch:
            lang, phrase, n = _Words(pa.Table.from_batches(held)).counted(size, words, pairs)
            return pa.RecordBatch.from_arrays([lang, phrase, n], ["lang", "phrase", "f"])

        held, chars = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                chars += batch.column(1).nbytes
            if chars > CHARS:
                yield out()
                held, chars = [], 0
        if held:
            yield out()

    columns = chunk_table.select("lang", "chunk", "own", "n")
    return columns.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def scored(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exact; it is at most 1000000."""
    wide = {x: f"cast({x} as decimal(15,0))" for x in (a, left, right)}
    return F.expr(f"cast((cast({wide[a]} * {wide[a]} as decimal(30,0)) * cast(1000000 as decimal(7,0))) div ({wide[left]} * {wide[right]}) as long)")


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, rows: int = ROWS, modulus: int = MODULUS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``rows`` phrases of two or three words.

    Counts are exact. A phrase with at least ``least`` occurrences has only parts with as many, so pairs are counted
    where both words are frequent, and triples where both pairs are; filters of a bounded size, made anew from all
    counts, tell so, and let a few more through. ``l`` and ``r`` are of the cut with the lowest score. A null text is
    empty, a null lang ``und``; repeated rows count again; columns but ``lang, text`` aren't read; no words, no rows.
    """
    chunk_table = materialise(dictionary(docs, modulus))
    total = chunk_table.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    one = materialise(phrases(chunk_table, 1).where(F.col("f") >= least))
    words = Filter.of(one)
    two = materialise(phrases(chunk_table, 2, words).where(F.col("f") >= least))
    three = materialise(phrases(chunk_table, 3, words, Filter.of(two)).where(F.col("f") >= least))

    def counted(table: DataFrame, name: str, count: str) -> DataFrame:
        return table.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))

    head, tail = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    pairs = two.select("lang", "phrase", F.col("f").alias("a"), head.alias("w1"), tail.alias("w2"))
    pairs = pairs.join(counted(one, "w1", "l"), ["lang", "w1"]).join(counted(one, "w2", "r"), ["lang", "w2"])
    triples = three.select("lang", "phrase", F.col("f").alias("a"), head.alias("w1"), rest.alias("w23"), F.substring_index("phrase", " ", 2).alias("w12"), tail.alias("w3"))
    longer = triples.select("lang", F.col("w12").alias("phrase"), "a").union(triples.select("lang", F.col("w23").alias("phrase"), "a")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    pairs = pairs.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("longer") >= covered * F.col("a"), F.lit(False)))
    triples = triples.join(counted(two, "w12", "f12"), ["lang", "w12"]).join(counted(two, "w23", "f23"), ["lang", "w23"])
    triples = triples.join(counted(one, "w1", "f1"), ["lang", "w1"]).join(counted(one, "w3", "f3"), ["lang", "w3"])
    cuts = triples.withColumns({"s1": scored("a", "f1", "f23"), "s2": scored("a", "f12", "f3")})
    at_first = F.col("s1") <= F.col("s2")
    found = pairs.select("lang", "phrase", "a", "l", "r", scored("a", "l", "r").alias("score")).union(
        cuts.select("lang", "phrase", "a", F.when(at_first, F.col("f1")).otherwise(F.col("f12")), F.when(at_first, F.col("f23")).otherwise(F.col("f3")), F.least("s1", "s2"))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= rows)
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= rows)
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
