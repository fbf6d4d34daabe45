"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import char_spans, id_and_text, kept, materialise, select_id_text, words_of

#: Words of a window.
WINDOW = 10
#: Words of all windows that one automaton takes, about 200 bytes of memory for each; larger benchmarks are scanned in
#: several passes.
MAX_WORDS = 1_000_000


class Windows:
    """The automaton of the items' windows over words: each different word of the items is a sign of ``digits`` characters.

    Each digit of a sign has characters of its own, so that matches begin and end with words, and a state has few followers.
    """

    BASE = 128

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW) -> None:
        lists = [(item, words_of(text)) for item, text in items]
        words = sorted({w for _, own in lists for w in own})
        self.digits = 1
        while self.BASE**self.digits < len(words):
            self.digits += 1
        self.sign = {w: "".join(chr(1 + d * self.BASE + n // self.BASE**d % self.BASE) for d in range(self.digits)) for n, w in enumerate(words)}
        of: dict[str, tuple[int, set[str]]] = {}
        for item, own in lists:
            for i in range(max(1, len(own) - window + 1) if own else 0):
                part = own[i : i + window]
                of.setdefault("".join(map(self.sign.__getitem__, part)), (len(part), set()))[1].add(item)
        self.machine = None
        if of:
            self.machine = ahocorasick.Automaton()
            for key, value in of.items():
                self.machine.add_word(key, value)
            self.machine.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, set[str]]]]:
        """(words of the text, [(first word, word after the last, items)] of every window that occurs)."""
        words = words_of(text)
        if not self.machine:
            return len(words), []
        get, other, d = self.sign.get, "\0" * self.digits, self.digits  # no item has the word
        found = self.machine.iter("".join([get(w, other) for w in words]))
        return len(words), [((end + 1) // d - size, (end + 1) // d, items) for end, (size, items) in found]


def merged(hits: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open ranges of words, those that overlap or touch made one."""
    out: list[list[int]] = []
    for first, after in sorted(hits):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], after)
        else:
            out.append([first, after])
    return [(a, b) for a, b in out]


SCHEMA = "doc_id long, n_words long, ranges array<struct<first:long,after:long>>, spans array<struct<start:long,end:long>>, items array<string>"


def _scan_once(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = kept(key, lambda: Windows(shared.value, window))
        for ids, texts in id_and_text(batches):
            counts, ranges, spans, names = [], [], [], []
            for text in texts:
                n, hits = machine.scan(text)
                joined = merged((a, b) for a, b, _ in hits)
                counts.append(n)
                ranges.append([{"first": a, "after": b} for a, b in joined])
                spans.append([{"start": a, "end": b} for a, b in char_spans(text, joined)] if joined else [])
                names.append(sorted(set().union(*(x for _, _, x in hits))))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())])), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((ids, counts, ranges, spans, names), kinds, strict=True)], ["doc_id", "n_words", "ranges", "spans", "items"])

    return select_id_text(docs).mapInArrow(run, SCHEMA)


def _passes(benchmark: DataFrame, window: int, max_words: int) -> Iterator[list[tuple[str, str]]]:
    """The items in lists whose windows have about ``max_words`` words (or one item), each collected when its pass begins."""
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("item_id is not null and text is not null").distinct()
    n_words = F.size(F.regexp_extract_all("text", F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"), F.lit(0)))
    size = items.agg(F.sum(n_words * window)).first()[0] or 0
    n = -(-size // max_words)
    if n <= 1:
        yield sorted(map(tuple, items.collect()))
        return
    dealt = materialise(items.withColumn("pass", F.pmod(F.xxhash64("item_id"), F.lit(2 * n))))
    for i in range(2 * n):
        if rows := dealt.where(F.col("pass") == i).select("item_id", "text").collect():
            yield sorted(map(tuple, rows))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id, n_words, ranges, spans, items``: where windows of ``window`` words of the items occur in a document.

    ``ranges`` are words, ``spans`` characters of the original text, both merged; ``items`` is sorted. An item of fewer
    words than a window is one window. Items without id or words have no windows; a null text has no words; repeated
    rows stay. One pass over the texts without a shuffle; a benchmark whose windows have more than ``max_words`` words takes a
    pass for each part, and the passes' results of a row are then put together.
    """
    passes = _passes(benchmark, window, max_words)
    first, second = next(passes, []), next(passes, None)
    if second is None:
        return _scan_once(docs, first, window)
    rows = materialise(select_id_text(docs).withColumn("row", F.monotonically_increasing_id()))
    # each pass ends before the next one's items come to the driver
    parts = [materialise(_scan_once(rows.select(F.col("row").alias("doc_id"), "text"), items, window)) for items in chain([first, second], passes)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    flat = every.groupBy("doc_id", "n_words").agg(
        F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )

    def union(column: str, first: str, after: str) -> str:
        """Ranges sorted by their start, each joined to the one before if it touches it."""
        return (
            f"aggregate(array_sort({column}), cast(array() as array<struct<{first}:bigint,{after}:bigint>>), (out, x) -> "
            f"case when size(out) > 0 and x.{first} <= element_at(out, -1).{after} then concat(slice(out, 1, size(out) - 1), "
            f"array(named_struct('{first}', element_at(out, -1).{first}, '{after}', greatest(element_at(out, -1).{after}, x.{after})))) "
            f"else concat(out, array(x)) end) as {column}"
        )

    found = flat.selectExpr("doc_id as row", "n_words", union("ranges", "first", "after"), union("spans", "start", "end"), "items")
    return rows.select("row", "doc_id").join(found, "row").drop("row")


def summary(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of what :func:`scan` returns."""
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["after"] - r["first"])
    return scanned.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs; columns as they were. A row without doc_id stays."""
    gone = scan(docs, benchmark, window).where(F.size("items") > 0).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
