"""Line dedup by an exact set-similarity join of all lines' words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, select_id_text, unused, utf8
from .pieces import byte_slices, low_and_high, spread, word_places

#: Jaccard similarity from which a later line goes.
SIMILARITY = Fraction(4, 5)
#: Words whose frequency decides their order; all others are rare and ordered by their hash.
FREQUENT = 1 << 18
#: Different words that a task counts before it sends them on.
COUNTED = 2_000_000
#: Bytes of a slice of texts; lines and postings that a task sends on together.
SLICE, LINES, POSTINGS = 1_000_000, 200_000, 500_000
#: Lines and postings travel in packets, one for each bucket; there is a bucket for about ``BUCKET`` of them, and
#: ``LEAST_BUCKETS`` at least.
BUCKET, LEAST_BUCKETS = 50_000, 2048
#: Lines of at most so many words have a sketch of 64 bits, longer ones of 128.
NARROW = 64
#: Earlier lines that a line and word keep at first where the closest one's sketch differs in less than a quarter of what
#: it may; up to a half these times as many, else these times as many again.
FIRST, MORE = 2, 4
#: Words to which a later round may be limited by broadcast; beyond, it takes all words.
LATER_WORDS = 1_000_000
#: Postings that are compared at once.
ROWS = 200_000
#: Postings of one word that a task holds; those of words with more are cut into parts of about ``PART``, and pairs of
#: parts are compared in tasks of their own.
HELD, PART = 65_536, 32_768
#: Bits of the filter of lines whose text is needed: what is broadcast is 2 MB at any size.
FILTER_BITS = 24
#: Longest run of lines that is compared by shifts of the whole batch; longer ones go block by block.
SHORT_RUN, BLOCK, ACROSS = 48, 256, 1024
#: Seed of the words' second hash, of which the second half of a set's signature is made.
SECOND = 0x9FB21C651E98DF25

REPRESENTATIVE = "n int, doc binary, line binary, size binary, s1 binary, s2 binary, tokens binary, gone_doc binary, gone_line binary"
POSTING = ("token", "prev", "pos", "size", "line", "doc", "s1", "s2")
CANDIDATE = "doc_id long, line int, other_id long, other_line int, far int, more boolean, word long"


def least_overlap(a, b, similarity: Fraction = SIMILARITY):
    """Words that sets of a and b words share at least if they are similar: ceil(t / (1 + t) * (a + b))."""
    num, den = similarity.numerator, similarity.numerator + similarity.denominator
    return -(-num * (a + b) // den)


def prefix_length(size, similarity: Fraction = SIMILARITY):
    """Rarest words of a set of which similar sets share one: size - ceil(t * size) + 1."""
    return size + (-similarity.numerator * size // similarity.denominator) + 1


def lines_of(text: str) -> list[list[bytes]]:
    """Words of each line, A-Z lower-cased; lines end at U+000A, words at other ASCII white space."""
    return [line.split() for line in utf8(text).lower().split(b"\n")]


def similar(a: set[bytes], b: set[bytes], similarity: Fraction = SIMILARITY) -> bool:
    both = len(a & b)
    return bool(both) and both * similarity.denominator >= similarity.numerator * (len(a) + len(b) - both)


_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def _mix(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words in bytes: a mix of the word itself for up to 16 bytes, XXH64 for longer ones.

    Another seed's hashes are independent: each of a word's eight bytes and its length is mixed by itself.
    """
    low, high = low_and_high(raw, start, size)
    keyed = _mix(low + np.uint64(seed), 0xFF51AFD7ED558CCD) + high
    out = _mix(_mix(keyed, 0xD6E8FEB86659FD93) + size.astype(np.uint64), 0xC4CEB9FE1A85EC53)
    for i in np.flatnonzero(size > 16).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : start[i] + size[i]].tobytes(), seed)
    return out


def _docs(docs: DataFrame) -> DataFrame:
    return select_id_text(docs).where("doc_id is not null")


def frequent_words(docs: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, int]:
    """(hashes of up to ``most`` of the most frequent words of all texts, rarest first; how many words all texts have).

    Words are taken by levels of frequency, most frequent ones first, as long as a whole level fits.

    A word that a slice of texts (about a million bytes) has only once isn't counted there. Order decides how many
    candidates there are, never the result: any order of words that all tasks share is right.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(words)).astype(np.int64)

        def out(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        total = 0
        for _, raw, offsets in byte_slices(batches, SLICE):
            raw = _LOWER[raw]
            words, counts = np.unique(word_hashes(raw, *word_places(raw, offsets)), return_counts=True)
            total += int(counts.sum())
            held.append((words[counts > 1], counts[counts > 1]))
            if sum(len(w) for w, _ in held) > COUNTED:
                held = [merged()]
                if len(held[0][0]) > COUNTED // 2:
                    yield out(*held[0])
                    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        yield out(*merged())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([total], pa.int64())], ["word", "n"])

    counts = materialise(_docs(docs).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(F.when(F.col("word").isNotNull(), level).alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total, least, words = 0, None, 0
    for level_, n_words, n in sorted(levels, key=lambda r: (r[0] is not None, -(r[0] or 0))):  # a few hundred
        if level_ is None:
            total = n
        elif words + n_words <= most:
            least, words = level_, words + n_words
        else:
            break
    top = counts.where("word is not null").where(level >= (2**30 if least is None else least)).toArrow()
    word, n = top["word"].to_numpy(), top["n"].to_numpy()
    return word[np.lexsort((word, n))].view(np.uint64), total


class WordOrder:
    """Place of each word in the shared order: rare words by their hash, then frequent ones, rarest first.

    Frequent words are looked up for whole arrays in a table with open addressing.
    """

    BITS = 20

    def __init__(self, frequent: np.ndarray) -> None:
        self.keys, self.ranks = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.uint64)
        hashes = frequent[frequent != 0]
        ranks = np.flatnonzero(frequent).astype(np.uint64) + np.uint64(1 << 63)
        slot = hashes >> np.uint64(64 - self.BITS)
        while len(hashes):  # each free slot takes one of the words that want it, the others step on
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[free]
            done = self.keys[slot] == hashes
            self.ranks[slot[done]] = ranks[done]
            hashes, ranks, slot = hashes[~done], ranks[~done], (slot[~done] + np.uint64(1)) & np.uint64((1 << self.BITS) - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        place, slot, at = hashes >> np.uint64(1), hashes >> np.uint64(64 - self.BITS), None
        keys = hashes
        while True:
            found = self.keys[slot]
            hit = found == keys
            go = ~hit & (found != 0)
            place[hit if at is None else at[hit]] = self.ranks[slot[hit]]
            at = np.flatnonzero(go) if at is None else at[go]
            if not len(at):
                return place
            keys, slot = keys[go], (slot[go] + np.uint64(1)) & np.uint64((1 << self.BITS) - 1)


def _token(places: np.ndarray) -> np.ndarray:
    """32 bits of a word's place, by which its postings meet."""
    return (_mix(places, 0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _by_line(owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The order of words by line and place. One sort of packed keys does it unless two places share their upper bits."""
    if len(owner) and owner[-1] >= 1 << 24:
        return np.lexsort((places, owner))
    frequent = places >> np.uint64(63) == 1
    upper = np.where(frequent, np.uint64(1 << 39) | (places & np.uint64((1 << 39) - 1)), places >> np.uint64(25))
    key = owner.astype(np.uint64) << np.uint64(40) | upper
    at = np.argsort(key)
    key, sorted_ = key[at], places[at]
    if ((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
        return np.lexsort((places, owner))
    return at


class Lines:
    """Sets of words of lines as arrays: place, size, signature, sketch, and the prefixes' tokens one behind the other."""

    NAMES = ("sig1", "sig2", "doc", "line", "size", "s1", "s2")

    def __init__(self, columns: dict[str, np.ndarray], tokens: np.ndarray, similarity: Fraction) -> None:
        self.columns, self.tokens, self.similarity = columns, tokens, similarity

    def __len__(self) -> int:
        return len(self.columns["doc"])

    @classmethod
    def of(cls, ids: np.ndarray, raw: np.ndarray, offsets: np.ndarray, order: WordOrder, similarity: Fraction) -> Lines:
        """The lines with words of texts that lie one behind the other."""
        raw = _LOWER[raw]
        start, bytes_ = word_places(raw, offsets)
        flat, again = order(word_hashes(raw, start, bytes_)), word_hashes(raw, start, bytes_, SECOND)
        ends = np.flatnonzero(raw == 10)
        ends = ends[ends < offsets[-1]]
        number, doc = np.searchsorted(ends, start), np.searchsorted(offsets, start, "right") - 1
        first = np.ones(len(start), bool)  # word of its line
        first[1:] = (number[1:] != number[:-1]) | (doc[1:] != doc[:-1])
        owner = np.cumsum(first) - 1
        doc, number = doc[first], number[first]
        line = number - np.searchsorted(ends, offsets[:-1])[doc]
        at = _by_line(owner, flat)
        flat, again, owner = flat[at], again[at], owner[at]
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        words, again, owner = flat[new], again[new], owner[new]
        size = np.bincount(owner, minlength=len(doc))
        start = np.cumsum(size) - size
        mixed = _mix(words, 0xBF58476D1CE4E5B9)
        # parity sketch of 128 bits: sets that differ in d words have sketches that differ in at most d bits
        bit = np.uint64(1) << (mixed & np.uint64(63))
        high = (mixed >> np.uint64(6)) & np.uint64(1) == 1
        none = np.zeros(0, np.uint64)
        s1 = np.bitwise_xor.reduceat(np.where(high, np.uint64(0), bit), start) if len(doc) else none
        s2 = np.bitwise_xor.reduceat(np.where(high, bit, np.uint64(0)), start) if len(doc) else none
        narrow = size <= NARROW  # their two halves are folded into one
        columns = {
            "sig1": _mix(np.add.reduceat(mixed, start), 0x9E3779B97F4A7C15) if len(doc) else none,
            "sig2": np.add.reduceat(_mix(again, 0x94D049BB133111EB), start) if len(doc) else none,
            "doc": ids[doc], "line": line, "size": size, "s1": np.where(narrow, s1 ^ s2, s1), "s2": np.where(narrow, np.uint64(0), s2),
        }
        return cls(columns, _token(words[spread(start, prefix_length(size, similarity))]), similarity)

    @classmethod
    def joined(cls, parts: list[Lines]) -> Lines:
        return cls({k: np.concatenate([p.columns[k] for p in parts]) for k in cls.NAMES}, np.concatenate([p.tokens for p in parts]), parts[0].similarity)

    def take(self, rows: np.ndarray) -> Lines:
        n = prefix_length(self.columns["size"].astype(np.int64), self.similarity)
        return Lines({k: c[rows] for k, c in self.columns.items()}, self.tokens[spread((np.cumsum(n) - n)[rows], n[rows])], self.similarity)

    def first_of_sets(self) -> tuple[Lines, np.ndarray, np.ndarray]:
        """(the earliest line of each different set, by signature; doc and line of all later ones)."""
        c = self.columns
        at = np.lexsort((c["line"], c["doc"], c["sig2"], c["sig1"]))
        new = np.ones(len(at), bool)
        new[1:] = (c["sig1"][at[1:]] != c["sig1"][at[:-1]]) | (c["sig2"][at[1:]] != c["sig2"][at[:-1]])
        first = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = at[(c["doc"][at] != c["doc"][first]) | (c["line"][at] != c["line"][first])]
        return self.take(at[new]), c["doc"][later], c["line"][later]


def _narrow(x: np.ndarray) -> np.ndarray:
    """The column in the fewest bytes for its values; one that has negative ones stays as it is."""
    least, most = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    return x if least < 0 or most >= 1 << 32 else x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def _packets(columns: list[np.ndarray], cut: np.ndarray) -> list[pa.Array]:
    """A binary column for each array, cut into rows at the given places."""
    return [pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * c.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(c))]) for c in columns]


def _column(packets: list[bytes | None], n: list[int], kind: str) -> np.ndarray:
    """One array of packets with n values each, ``kind`` u or i for those that fill eight bytes."""
    parts = [np.frombuffer(x, f"<{kind if len(x) == 8 * k else 'u'}{len(x) // k}") for x, k in zip(packets, n, strict=True) if k]
    return np.concatenate(parts).astype("<i8" if kind == "i" else "<u8") if parts else np.zeros(0, f"<{kind}8")


def _buckets(n: int) -> int:
    return max(LEAST_BUCKETS, n // BUCKET)


def _by_bucket(batches: Iterable[pa.RecordBatch], counts: int, rows: int) -> Iterator[tuple[list[list], bool]]:
    """Rows as lists of columns, several whole buckets together, or a part of one bucket if that is very large.

    ``counts``: the column that says how much a row holds; with each part, whether its last bucket goes on.
    """
    held: list[list] = []
    size, last = 0, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if size >= rows and row[0] != last:
                yield [list(c) for c in zip(*held, strict=True)], False
                held, size = [], 0
            elif size >= 8 * max(rows, HELD):
                yield [list(c) for c in zip(*held, strict=True)], True
                held, size = [], 0
            held.append(row)
            size += row[counts]
            last = row[0]
    if held:
        yield [list(c) for c in zip(*held, strict=True)], False


def representatives(docs: DataFrame, frequent: np.ndarray, n_words: int, similarity: Fraction = SIMILARITY) -> DataFrame:
    """The earliest line of each different set of words, packed: place, size, sketch, tokens of its prefix.

    Sets are equal by a signature of 128 bits, two sums over independent hashes of their words. All later lines of a set are in ``gone_doc`` and ``gone_line``. A task
    sends each set that it meets once; equal sets meet by their signature.
    """
    shared, buckets = docs.sparkSession.sparkContext.broadcast(frequent), _buckets(n_words // 8)
    names = ["bucket", "n", "g", *Lines.NAMES, "tokens", "gone_doc", "gone_line"]

    def send(lines: Lines) -> pa.RecordBatch:
        kept, doc, line = lines.first_of_sets()
        bucket = ((kept.columns["sig1"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, int)
        n = np.cumsum(prefix_length(kept.columns["size"].astype(np.int64), similarity))
        rows, gone = len(cut) - 1, np.linspace(0, len(doc), len(cut)).astype(np.int64)  # they are spread over the rows
        columns = [*_packets([_narrow(c) for c in kept.columns.values()], cut), *_packets([kept.tokens], np.append(0, n)[cut]), *_packets([_narrow(doc), _narrow(line)], gone)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:rows]].astype(np.int32)), pa.array(np.diff(cut).astype(np.int32)), pa.array(np.diff(gone).astype(np.int32)), *columns], names)

    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, held = WordOrder(shared.value), []
        for ids, raw, offsets in byte_slices(batches, SLICE):
            held.append(Lines.of(ids.to_numpy(), raw, offsets, order, similarity))
            if sum(map(len, held)) >= LINES:
                yield send(Lines.joined(held))
                held = []
        if held:
            yield send(Lines.joined(held))

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over: list[Lines] = []
        for columns, goes_on in _by_bucket(batches, 1, LINES):
            n, g = columns[1], columns[2]
            arrays = {k: _column(c, n, "i" if k == "doc" else "u") for k, c in zip(Lines.NAMES, columns[3:10], strict=True)}
            lines = Lines(arrays, np.frombuffer(b"".join(columns[10]), np.uint32), similarity)
            kept, doc, line = Lines.joined([*over, lines]).first_of_sets()
            over = [kept] if goes_on else []
            doc, line = np.append(doc, _column(columns[11], g, "i")), np.append(line, _column(columns[12], g, "u"))
            yield pack(kept.take(np.arange(0)) if goes_on else kept, doc, line)

    def pack(kept: Lines, doc: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        whole = [_narrow(kept.columns[k]) for k in ("doc", "line", "size", "s1", "s2")]
        packed = [_packets([c], np.array([0, len(c)]))[0] for c in (*whole, kept.tokens, doc.astype("<i8"), line.astype("<i4"))]
        return pa.RecordBatch.from_arrays([pa.array([len(kept)], pa.int32()), *packed], [c.split()[0] for c in REPRESENTATIVE.split(", ")])

    sent = _docs(docs).mapInArrow(cut_up, ", ".join(f"{c} {'int' if c in names[:3] else 'binary'}" for c in names))
    return materialise(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, REPRESENTATIVE))


def equal_lines(packed: DataFrame) -> DataFrame:
    """``doc_id, line`` of all lines whose set an earlier line has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(doc, "<i8")), pa.array(np.frombuffer(line, "<i4"))], ["doc_id", "line"])

    return packed.select("gone_doc", "gone_line").mapInArrow(run, "doc_id long, line int")


def _postings(packed: Iterable[pa.RecordBatch], similarity: Fraction, wanted: np.ndarray | None) -> Iterator[dict[str, np.ndarray]]:
    """A posting for each word in a line's prefix (of ``wanted`` words only): the word, the one before it, the position, the line."""
    for batch in packed:
        for n, doc, line, size, s1, s2, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not n:
                continue
            lines = {k: _column([x], [n], "i" if k == "doc" else "u") for k, x in (("size", size), ("line", line), ("doc", doc), ("s1", s1), ("s2", s2))}
            token = np.frombuffer(tokens, np.uint32)
            count = prefix_length(lines["size"].astype(np.int64), similarity)
            row = np.repeat(np.arange(n), count)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            out = {"token": token, "prev": np.append(token[:1], token[:-1]), "pos": pos}
            if wanted is not None:
                kept = np.isin(token, wanted)
                row, out = row[kept], {k: c[kept] for k, c in out.items()}
            yield out | {k: c[row] for k, c in lines.items()}


class _Run:
    """Postings of some words."""

    def __init__(self, columns: dict[str, np.ndarray], similarity: Fraction, open_: np.ndarray | None = None, second: np.ndarray | None = None) -> None:
        self.second = second  # the part of each posting, if only postings of different parts are compared
        self.open_ = open_  # a filter of the lines that are held against earlier ones, if these aren't all
        self.token, self.prev, self.pos, self.size = (columns[k].astype(np.int64) for k in ("token", "prev", "pos", "size"))
        self.line, self.doc, self.s1, self.s2, self.similarity = columns["line"].astype(np.int32), columns["doc"], columns["s1"], columns["s2"], similarity

    def passes(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(later, earlier, how far apart) of pairs of postings whose lines may be similar by length, position and sketch.

        How far: the bits in which the sketches differ, in 128ths of what similar sets may differ in. Lines that meet at
        the word before, too, aren't given again.
        """
        a, b = self.size[i], self.size[j]
        ok = np.minimum(a, b) * self.similarity.denominator >= np.maximum(a, b) * self.similarity.numerator
        i, j = i[ok], j[ok]
        a, b, p, q = self.size[i], self.size[j], self.pos[i], self.pos[j]
        shared = least_overlap(a, b, self.similarity)
        ok = (np.minimum(a - p, b - q) >= shared) & ((self.prev[i] != self.prev[j]) | (p == 0) | (q == 0))
        if self.second is not None:
            ok &= self.second[i] != self.second[j]
        i, j, a, b, shared = i[ok], j[ok], a[ok], b[ok], shared[ok]
        one, two = self.s1[i] ^ self.s1[j], self.s2[i] ^ self.s2[j]
        folded = np.minimum(a, b) <= NARROW  # a narrow sketch is held against the other's two halves folded into one
        one, two = np.where(folded, one ^ two, one), np.where(folded, np.uint64(0), two)
        differ = np.bitwise_count(one).astype(np.int64) + np.bitwise_count(two)
        may = a + b - 2 * shared
        ok = (differ <= may) & ((self.doc[i] != self.doc[j]) | (self.line[i] != self.line[j]))
        i, j, far = i[ok], j[ok], 128 * differ[ok] // (may[ok] + 1)
        after = (self.doc[i] > self.doc[j]) | (self.doc[i] == self.doc[j]) & (self.line[i] > self.line[j])
        i, j = np.where(after, i, j), np.where(after, j, i)
        if self.open_ is not None:
            ok = _in(self.open_, self.doc[i], self.line[i])
            i, j, far = i[ok], j[ok], far[ok]
        return i, j, far

    def best(self, i: np.ndarray, j: np.ndarray, far: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        """(i, j, far, whether there are more): for each i the closest j, ``most`` of them where one is close.

        Of equally close ones the latest, so that not all lines of a group are held against the same one.
        """
        at = np.lexsort((-self.line[j], -self.doc[j], far, i))
        i, j, far = i[at], j[at], far[at]
        first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, int)
        counts = np.diff(np.append(first, len(i)))
        nth = np.arange(len(i)) - np.repeat(first, counts)
        limit = most * np.array([1, MORE, MORE * MORE])[(far[first] >= 32).astype(int) + (far[first] >= 64)]
        kept = nth < np.repeat(limit, counts)
        return i[kept], j[kept], far[kept], np.repeat(counts > limit, counts)[kept]

    def candidates(self, most: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(line, earlier line, how far, whether there are more) of the closest earlier lines that pass.

        Parts of bounded size: all short runs, whose postings stand by size, then each block of a long run.
        """
        order = np.argsort(self.token << 32 | self.size)
        token, size = self.token[order], self.size[order]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, int)
        sizes = np.diff(np.append(starts, len(token)))
        begin = np.repeat(starts, sizes)
        none = np.zeros(0, int)
        found = [(none, none, none)]
        rows = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes))
        for d in range(1, SHORT_RUN):
            rows = rows[rows - d >= begin[rows]]
            rows = rows[size[rows - d] * self.similarity.denominator >= size[rows] * self.similarity.numerator]
            if not len(rows):
                break
            found.append(self.passes(order[rows], order[rows - d]))
        yield self.best(*(np.concatenate([f[k] for f in found]) for k in range(3)), most)
        for start, n in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
            run = order[start : start + n]
            yield from self.long_run(run[np.lexsort((self.line[run], self.doc[run]))], most)

    def long_run(self, run: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, ...]]:
        """The same of many postings of one word in order of place."""
        none, number = np.zeros(0, int), np.zeros(len(self.token), int)
        num, den = self.similarity.numerator, self.similarity.denominator
        for at in range(0, len(run), BLOCK):
            block = run[at : at + BLOCK]
            number[block] = np.arange(len(block))
            kept, open_, others = [none, none, none], np.ones(len(block), bool), np.zeros(len(block), bool)
            for other in range(0, at + len(block), ACROSS):
                # a posting with enough close lines needs no others; they are more, if it should come to that
                todo, earlier = block[open_], run[other : min(other + ACROSS, at + len(block))]
                if not len(todo):
                    break
                a, b = self.size[todo][:, None], self.size[earlier][None, :]
                fits = (a * den >= b * num) & (b * den >= a * num)
                if other + ACROSS > at:
                    fits &= np.arange(other, other + len(earlier))[None, :] < (at + np.flatnonzero(open_))[:, None]
                x, y = np.nonzero(fits)
                new = self.passes(todo[x], earlier[y])
                *kept, more = self.best(*(np.concatenate(c) for c in zip(kept, new, strict=True)), most)
                others[number[kept[0][more]]] = True
                close = np.bincount(number[kept[0][kept[2] < 32]], minlength=len(block)) >= most
                if other + ACROSS < at + len(block):
                    others |= open_ & close
                open_ &= ~close
            i, j, far, more = self.best(*kept, most)
            yield i, j, far, more | others[number[i]]


_CANDIDATE_NAMES = [c.split()[0] for c in CANDIDATE.split(", ")]


def _found(run: _Run, most: int) -> Iterator[pa.RecordBatch]:
    for i, j, far, more in run.candidates(most):
        if len(i):
            yield pa.RecordBatch.from_arrays([*map(pa.array, (run.doc[i], run.line[i], run.doc[j], run.line[j], far.astype(np.int32), more, run.token[i]))], _CANDIDATE_NAMES)


def _matcher(most: int, similarity: Fraction, held: int, rows: int, open_=None):
    def marks(words: np.ndarray) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([*(pa.nulls(len(words), k) for k in kinds), pa.array(words.astype(np.int64))], _CANDIDATE_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over: list[dict[str, np.ndarray]] = []
        hot = np.zeros(0, np.int64)
        for packets, goes_on in _by_bucket(batches, 1, rows):
            part = {k: _column(c, packets[1], "i" if k == "doc" else "u") for k, c in zip(POSTING, packets[2:], strict=True)}
            columns = {k: np.concatenate([*(o[k] for o in over), part[k]]) for k in POSTING}
            words, at, counts = np.unique(columns["token"], return_inverse=True, return_counts=True)
            new = np.setdiff1d(words[counts > held], hot)
            if len(new):  # their postings leave by themselves
                yield marks(new)
            hot = np.union1d(hot, new)
            if len(hot):
                few = ~np.isin(words, hot)[at]
                columns = {k: c[few] for k, c in columns.items()}
            over = [columns] if goes_on else []
            if not goes_on:
                yield from _found(_Run(columns, similarity, None if open_ is None else open_.value), most)
                hot = np.zeros(0, np.int64)

    return run


def _pair_matcher(most: int, similarity: Fraction, open_=None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            second = columns[3] if columns[1][0] != columns[2][0] else None
            arrays = {k: c.view(np.uint64) if k in ("s1", "s2") else c for k, c in zip(POSTING, columns[4:], strict=True)}
            yield from _found(_Run(arrays, similarity, None if open_ is None else open_.value, second), most)

        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new = np.zeros(batch.num_rows, bool)
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            if batch.num_rows and held:
                new[0] = any(held[-1][k][-1] != columns[k][0] for k in range(3))
            cuts = [0, *(x for x in np.flatnonzero(new).tolist() if x), batch.num_rows]
            for first, after in zip(cuts, cuts[1:], strict=False):
                if first == after:
                    continue
                if held and new[first]:
                    yield from out()
                    held = []
                held.append([c[first:after] for c in columns])
        if held:
            yield from out()

    return run


def candidates(packed: DataFrame, n_words: int, most: int, similarity: Fraction = SIMILARITY, only: np.ndarray | None = None, lines: DataFrame | None = None) -> DataFrame:
    """Each line's ``most`` closest possible earlier matches at every word (or ``only`` some), ``more`` where there are others.

    With ``lines`` (``doc_id, line``) only those of these lines, and perhaps of some others.

    Postings of a word meet by the word; the words' rarity keeps them few. A bounded number of rows for a line and word
    leaves, however many lines share it. Words with more than ``HELD`` postings are taken by pairs of parts.
    """
    sc = packed.sparkSession.sparkContext
    wanted, buckets = None if only is None else sc.broadcast(only), _buckets(n_words // 5)
    open_ = None if lines is None else sc.broadcast(_filter(lines))
    stored = packed.select("n", "doc", "line", "size", "s1", "s2", "tokens")

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in _postings(batches, similarity, None if wanted is None else wanted.value):
            held.append(part)
            n += len(part["token"])
            if n >= POSTINGS:
                yield packets(held)
                held, n = [], 0
        if n:
            yield packets(held)

    def packets(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        columns = {k: np.concatenate([h[k] for h in held]) for k in POSTING}
        at = np.argsort(columns["token"])
        bucket = columns["token"][at].astype(np.int64) * buckets >> 32
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(at))
        arrays = _packets([_narrow(columns[k][at]) for k in POSTING], cut)
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]].astype(np.int32)), pa.array(np.diff(cut).astype(np.int32)), *arrays], ["bucket", "n", *POSTING])

    sent = stored.mapInArrow(send, "bucket int, n int, " + ", ".join(f"{c} binary" for c in POSTING))
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    found = materialise(dealt.mapInArrow(_matcher(most, similarity, HELD, ROWS, open_), CANDIDATE))
    many = found.where("doc_id is null").select("word").distinct().toArrow()["word"].to_numpy()
    found = found.where("doc_id is not null")
    return found.unionByName(materialise(paired_candidates(stored, many.astype(np.uint32), most, similarity, open_))) if len(many) else found


def paired_candidates(lines: DataFrame, words: np.ndarray, most: int, similarity: Fraction = SIMILARITY, open_=None) -> DataFrame:
    """:func:`candidates` of words with very many postings.

    The postings of a word are dealt over parts by hash; each pair of parts is a group of bounded size of its own, in
    which those of the one are held against those of the other. A line's closest ones of all groups are then put together.
    """
    wanted = lines.sparkSession.sparkContext.broadcast(words)

    def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _postings(batches, similarity, wanted.value):
            yield pa.RecordBatch.from_arrays([pa.array(part[k].view(np.int64) if k in ("s1", "s2") else part[k].astype(np.int64)) for k in POSTING], list(POSTING))

    rows = materialise(lines.mapInArrow(rows_of, ", ".join(f"{c} long" for c in POSTING)))
    counts = rows.groupBy("token").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    counts = F.broadcast(counts) if len(words) <= LATER_WORDS else counts
    placed = rows.join(counts, "token").withColumn("part", F.pmod(F.xxhash64("doc", "line"), "parts").cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.col("token").alias("word"), F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), (F.col("part") > F.col("other")).alias("second"), *POSTING
    )
    found = pairs.repartition("word", "a", "b").sortWithinPartitions("word", "a", "b").mapInArrow(_pair_matcher(most, similarity, open_), CANDIDATE)
    line = Window.partitionBy("doc_id", "line", "word")
    order = line.orderBy("far", F.desc("other_id"), F.desc("other_line"))
    ranked = found.withColumns({"nth": F.row_number().over(order) - 1, "least": F.min("far").over(line), "others": F.max("more").over(line), "rows": F.count("*").over(line)})
    limit = F.when(F.col("least") < 32, most).when(F.col("least") < 64, most * MORE).otherwise(most * MORE * MORE)
    return ranked.where(F.col("nth") < limit).select("doc_id", "line", "other_id", "other_line", "far", (F.col("others") | (F.col("rows") > limit)).alias("more"), "word")


def _slot(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The bit of a line in the filter."""
    return (_mix(_mix(doc.astype(np.int64).view(np.uint64), 0x9E3779B97F4A7C15) + line.astype(np.uint64), 0xC2B2AE3D27D4EB4F) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(places: DataFrame) -> np.ndarray:
    """A bit filter of fixed size in which the bits of all the places ``doc_id, line`` are set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_slot(*(c.to_numpy() for c in batch.columns))] = True
        words = np.packbits(bits).view("<i8")
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at])], ["at", "bits"])

    sent = places.select("doc_id", "line").mapInArrow(run, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 6, "<i8")
    out[sent["at"].to_numpy()] = sent["bits"].to_numpy()
    return out.view(np.uint8)


def _in(bits: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Whether the lines' bits are set."""
    slot = _slot(doc, line)
    return bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1 == 1


def texts_of(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``doc_id, line, text binary`` of at least the lines at the given places; A-Z lower-cased.

    Texts don't move: each task looks its lines up in a filter of fixed size, which may let others pass but loses none.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_filter(places))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        for ids, raw, offsets in byte_slices(batches):
            n = int(offsets[-1])
            ends = np.flatnonzero(raw[:n] == 10)
            counts = np.searchsorted(ends, offsets[1:]) - np.searchsorted(ends, offsets[:-1]) + 1
            doc = np.repeat(np.arange(len(counts)), counts)
            line = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            start, end = np.sort(np.append(offsets[:-1], ends + 1)), np.sort(np.append(offsets[1:], ends))
            keys = ids.to_numpy()[doc]
            at = np.flatnonzero(_in(wanted, keys, line))
            size = (end - start)[at]
            text = _packets([_LOWER[raw[spread(start[at], size)]]], np.append(0, np.cumsum(size)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(line[at].astype(np.int32)), *text], ["doc_id", "line", "text"])

    return _docs(docs).mapInArrow(run, "doc_id long, line int, text binary")


def verified(pairs: DataFrame, texts: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """``doc_id, line`` of each later line of the pairs that is similar to one of its earlier lines, by the words themselves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            matched = pa.array([similar(set(x.split()), set(y.split()), similarity) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(matched) for i in (0, 1)], ["doc_id", "line"])

    early = texts.select(F.col("doc_id").alias("other_id"), F.col("line").alias("other_line"), F.col("text").alias("b"))
    both = pairs.join(early, ["other_id", "other_line"]).join(texts, ["doc_id", "line"])
    return both.select("doc_id", "line", "text", "b").mapInArrow(run, "doc_id long, line int").distinct()


def removed_lines(docs: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """``doc_id, line`` of every line whose set of words is similar to that of a line at an earlier place.

    Places are ordered by doc_id and line number; a match counts whether it goes itself or not. All lines with a word
    take part, whatever their length. Of lines with equal sets (by a signature of 128 bits) all but the first go at once,
    and only the first is held against others. Each line is verified, on the words themselves, against the closest of its
    possible matches; where that is none, against the next ones, and where there are still others, against eight times as
    many, until every line is settled: no pair is lost, and no group of alike lines is written out as pairs. Documents
    with null ids and blank lines take no part; rows that share a doc_id are one document, whose lines don't match
    themselves.
    """
    place, most, only = ["doc_id", "line"], FIRST, None
    frequent, n_words = frequent_words(docs)
    packed = representatives(docs, frequent, n_words, similarity)
    gone, open_ = equal_lines(packed), None
    while True:
        found = candidates(packed, n_words, most, similarity, only, open_)
        if open_ is not None:
            found = materialise(found.join(open_, [*place, "word"], "left_semi"))
        texts = materialise(texts_of(docs, found.select(*place).union(found.select("other_id", "other_line"))))
        closest = found.groupBy(*place).agg(F.min(F.struct("far", "other_id", "other_line")).alias("x")).select(*place, "x.other_id", "x.other_line")
        settled = materialise(verified(closest, texts, similarity))
        rest = found.join(settled, place, "left_anti").select(*place, "other_id", "other_line").distinct()
        late = materialise(verified(rest, texts, similarity))
        gone = gone.union(settled).union(late)
        open_ = materialise(found.where("more").select(*place, "word").distinct().join(settled, place, "left_anti").join(late, place, "left_anti"))
        words = open_.select("word").distinct().limit(LATER_WORDS + 1).toArrow()["word"].to_numpy()
        if not len(words):
            return materialise(gone.distinct())
        most *= 8
        only = words.astype(np.uint32) if len(words) <= LATER_WORDS else None


def summary(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed_lines`` of every document; a null text is one empty line."""
    lists = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    counted = select_id_text(docs).select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    own = F.coalesce(F.filter("lines", lambda x: x < F.col("n_lines")), F.array().cast("array<int>"))
    joined = counted.join(lists, "doc_id", "left").withColumn("own", own)
    return joined.select("doc_id", "n_lines", F.size("own").cast("long").alias("n_removed"), F.array_join(F.col("own").cast("array<string>"), ",").alias("removed_lines"))


def without_lines(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents without the given lines, ``n_chars`` (where there is such a column) counted again.

    Texts that lose nothing stay as they are, null too; one that loses all lines becomes empty. Other columns stay.
    """
    own, lost = unused(["id", "gone"], docs.columns)
    lists = gone.groupBy(F.col("doc_id").alias(own)).agg(F.collect_set("line").alias(lost))
    joined = docs.join(lists, docs["doc_id"].cast("long") == lists[own], "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(lost, i)), "\n")
    out = joined.withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(lost).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
