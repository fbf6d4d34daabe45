"""Spelling variants: words one edit apart by pivotal bigrams, and the form that each rare word stands for.

Two disjoint bigrams of a word, its pivots, are taken from its prefix: the bigrams that are at most as frequent as its
third rarest. One edit spares one of two disjoint bigrams. So of two words that are one edit apart, the one whose prefix
ends at the rarer bigram (or either, if they end alike) has a pivot that stands in the other's prefix, at most one place
further left or right. Pivots meet prefixes by equality of the bigram, the lengths of both words, and the half of the
word that the edit has left alone; positions and a bounded edit distance decide.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, select_id_text

#: Code points and occurrences that a word has at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One in so many runs of a document, by checksum, loses a character.
MARK = 31
#: How many times as frequent a form is at least.
FACTOR = 10
#: Different words that a task counts before it passes them on.
COUNTED = 200_000
#: Pairs of rows of one key beyond which its rows meet by deletion variants.
CROWDED = 1 << 18

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _letters() -> bytes:
    table = bytearray(b" " * 256)
    for c in range(256):
        if 0x61 <= c <= 0x7A or c >= 0xC0:
            table[c] = c
        elif 0x41 <= c <= 0x5A:
            table[c] = c + 0x20
    return bytes(table)


#: Latin-1 bytes with A-Z lower-cased; what is neither A-Z, a-z nor U+00C0 to U+00FF is a space.
_LETTERS = _letters()


def runs(text: str) -> list[bytes]:
    """The maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased, in Latin-1, where each is a byte a character."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def marked(doc_id: object, run: bytes) -> bytes:
    """The run, without one character if the checksum of ``<doc_id>:<run>`` is a multiple of ``MARK``."""
    h = zlib.crc32(b"%s:%s" % (doc_id, run if run.isascii() else run.decode("latin-1").encode()))
    if h % MARK:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words with so many characters and occurrences over all documents.

    A null text has no words; a null doc_id counts as an empty one in the checksum; repeated rows count again.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        counts: Counter[bytes] = Counter()
        for ids, texts in id_and_text(batches):
            for doc_id, text in zip(ids, texts, strict=True):
                name = b"" if doc_id is None else b"%d" % doc_id
                for word, n in Counter([w for w in runs(text) if len(w) >= least_length]).items():
                    word = marked(name, word)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield out()
                    counts.clear()
        yield out()

    return select_id_text(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the list, matrix of characters) of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8).reshape(len(at), size)


def bigrams(chars: np.ndarray) -> np.ndarray:
    return chars[:, :-1].astype(np.int64) << 8 | chars[:, 1:]


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _BASE, np.uint64)]))[:n]


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit key of numbers."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for part in parts:
            h = (h ^ np.asarray(part).astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
            h = h ^ h >> np.uint64(29)
    return h


def prefix_of(weights: np.ndarray) -> np.ndarray:
    """Which bigrams of each word (a row of places in the order of rarity) are in its prefix: ties with the third are."""
    return weights <= np.partition(weights, 2, axis=1)[:, 2:3]


def pivots_of(weights: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of two disjoint bigrams of each word's prefix with the least sum of counts.

    Dynamic programming over positions: the best single one up to each position, then the best second one behind it.
    """
    far = np.iinfo(np.int64).max // 4
    cost = np.where(prefix_of(weights), counts, far)
    best = np.minimum.accumulate(cost, axis=1)
    both = best[:, :-2] + cost[:, 2:]  # the first ends before the second begins
    second = both.argmin(axis=1) + 2
    first = np.where(np.arange(cost.shape[1]) <= second[:, None] - 2, cost, far + 1).argmin(axis=1)
    return first, second


def _halves(size: int) -> list[tuple[int, int, int]]:
    """(side, characters, fits) of what an edit may leave alone: half of the shorter word of a pair.

    ``fits``: 1 where this word may be the shorter one (or both have its length), 2 where it may be the longer one, 3 both.
    """
    out: dict[tuple[int, int], int] = {}
    for fits, least in ((1, size), (2, size - 1)):
        for at in ((0, least // 2), (1, least - least // 2)):
            out[at] = out.get(at, 0) | fits
    return [(*at, fits) for at, fits in out.items()]


def _rows(words: np.ndarray, chars: np.ndarray, place: np.ndarray, count: np.ndarray, pivot: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, spot, word) of each word's pivots, or of the bigrams of its prefix; a spot has position, last of the prefix, fits.

    There is a row for each half that an edit may leave alone. A pivot inside of that half outlasts the edit; then the
    other one isn't needed there.
    """
    size = chars.shape[1]
    grams = bigrams(chars)
    order = place[grams]
    last = np.partition(order, 2, axis=1)[:, 2]
    values = chars.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        hashes = [np.cumsum(x * _powers(size), axis=1) for x in (values, values[:, ::-1])]
    if pivot:
        every = np.arange(len(chars))
        first, second = pivots_of(order, count[grams])
    else:
        rows, spots = np.nonzero(prefix_of(order))
    for side, half, fits in _halves(size):
        if pivot:
            inside = second >= size - half if side else first + 2 <= half
            rows = np.concatenate([every, every[~inside]])
            spots = np.concatenate([second, first[~inside]] if side else [first, second[~inside]])
        yield _mixed(grams[rows, spots], half * 2 + side, hashes[side][rows, half - 1]).view(np.int64), spots << 18 | last[rows] << 2 | fits, words[rows]


def gram_rows(words: DataFrame, order: dict[int, tuple[int, int]], pivot: bool) -> DataFrame:
    """``key, spot, word`` of all words' pivots, or of all bigrams in their prefixes."""
    place, count = np.full(1 << 16, 1 << 30, np.int64), np.zeros(1 << 16, np.int64)
    for gram, (rank, n) in order.items():
        place[gram], count[gram] = rank, n
    shared = words.sparkSession.sparkContext.broadcast((place, count))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, count = shared.value
        for batch in batches:
            column = batch.column(0)
            for at, chars in by_length([w.encode("latin-1") for w in column.to_pylist()]):
                for i in range(0, len(at), 1 << 14):
                    key, spot, word = (np.concatenate(x) for x in zip(*_rows(at[i : i + (1 << 14)], chars[i : i + (1 << 14)], place, count, pivot), strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(spot), column.take(pa.array(word))], ["key", "spot", "word"])

    return words.select("word").mapInArrow(run, "key long, spot long, word string")


def gram_order(words: DataFrame) -> dict[int, tuple[int, int]]:
    """Bigram: (place by rarity, count over the different words); at most 89 x 89, the letters being what they are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, chars in by_length([w.encode("latin-1") for w in batch.column(0).to_pylist()]):
                total += np.bincount(bigrams(chars).ravel(), minlength=1 << 16)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["gram", "n"])

    rows = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r.gram: (i, r.n) for i, r in enumerate(sorted(rows, key=lambda r: (r.n, r.gram)))}


def variants(rows: DataFrame) -> DataFrame:
    """``variant`` and the rows: each under the hash of its word and of the word without each of its characters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for at, chars in by_length(texts):
                size = chars.shape[1]
                step = max(1, (1 << 20) // size)
                for i in range(0, len(at), step):
                    values = chars[i : i + step].astype(np.uint64) + np.uint64(1)
                    with np.errstate(over="ignore"):
                        own = values * _powers(size)
                        upto = np.cumsum(own, axis=1)
                        whole = upto[:, -1:]
                        hashes = np.concatenate([whole, upto - own + (whole - upto) * np.uint64(_INVERSE)], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64).ravel()), *(c.take(pa.array(np.repeat(at[i : i + step], size + 1))) for c in batch.columns)], ["variant", *batch.schema.names])

    return rows.mapInArrow(run, "variant long, key long, spot long, word string").distinct()


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word, other``, both ways and each once, of all words (of three bigrams at least) that are one edit apart.

    Keys whose pivots and prefixes make more than ``crowded`` pairs are taken out of the join; their rows meet under the
    same key by the words without one character instead. A variant has few words, as many as there are letters and
    places, so that no key's work grows with the square of its rows.
    """
    order = gram_order(words)
    pivots, prefixes = materialise(gram_rows(words, order, pivot=True)), materialise(gram_rows(words, order, pivot=False))
    sizes = pivots.groupBy("key").agg(F.count("*").alias("a")).join(prefixes.groupBy("key").agg(F.count("*").alias("b")), "key")
    hot = materialise(sizes.where(F.col("a") * F.col("b") > crowded).select("key"))

    def verified(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
        """Of a pair, the half is that of the shorter word, and the prefix ends no earlier than the pivot's word's own."""
        a, b = left.alias("a"), right.alias("b")
        same = F.col("a.key") == F.col("b.key")
        for name in by:
            same &= F.col(f"a.{name}") == F.col(f"b.{name}")
        size, other = F.length("a.word"), F.length("b.word")
        at, last = (lambda x: F.shiftright(f"{x}.spot", 18)), (lambda x: F.shiftright(f"{x}.spot", 2).bitwiseAND(65535))
        apart, fits = F.abs(size - other), F.when(other >= size, 1).otherwise(2)
        close = (F.abs(at("a") - at("b")) <= apart) & (apart <= 1) & (last("a") <= last("b")) & (F.col("a.spot").bitwiseAND(fits) > 0)
        pairs = a.join(b, same & close & (F.levenshtein("a.word", "b.word", 1) == 1))
        return pairs.select(F.col("a.word").alias("word"), F.col("b.word").alias("other"))

    if hot.isEmpty():
        found = verified(pivots, prefixes, [])
    else:
        found = verified(pivots.join(hot, "key", "left_anti"), prefixes.join(hot, "key", "left_anti"), [])
        found = found.union(verified(variants(pivots.join(hot, "key", "left_semi")), variants(prefixes.join(hot, "key", "left_semi")), ["variant"]))
    return found.union(found.select(F.col("other").alias("word"), F.col("word").alias("other"))).distinct()


def forms(words: DataFrame, near: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word: the near word of largest n, first in order among equals, if that
    is ``factor`` times the word's own."""
    of = near.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = of.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = words.select("word", "n").join(best, "word", "left")
    frequent = -F.col("best.less") >= factor * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of ``word, form``; pointers are doubled until none moves. No cycles: a form is more frequent."""
    now = materialise(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialise(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def variant_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FACTOR, crowded: int = CROWDED) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents; columns other than ``doc_id, text`` aren't read.

    Of an empty table, or one without such words, there are no rows. ``least_length`` is 4 or more, so that every word
    has three bigrams, of which two are disjoint.
    """
    if least_length < 4:
        raise ValueError("words need three bigrams, that is four characters")
    words = materialise(word_counts(docs, least_length, least_count))
    found = materialise(forms(words, near_pairs(words, crowded), factor))
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
