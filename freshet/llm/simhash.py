"""SimHash near-duplicates: fingerprints, one-wildcard segment index, verified links, components."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, select_id_text, utf8
from .graph import components, with_least

#: Bytes of a text whose shingles are hashed at once, and what ends a word.
PART, _SPACE = 1 << 18, re.compile(rb"[ \t-\r]")
#: Rows and columns of a block of distances.
BLOCK = 2048
#: A bucket of more fingerprints is cut again by the other half.
CUT = 16384
#: Parts in which the documents of a fingerprint get their component.
SALTS = 256


def _parts(raw: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes that end between words."""
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= PART else next((m.start() for m in [_SPACE.search(raw, at + PART)] if m), len(raw))
        yield raw[at:end]
        at = end


def _set_bits(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the highest first."""
    return np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles, repeats included, as a signed 64-bit integer; a text without words has 0.

    A-Z are lower-cased, words end at space and U+0009 to U+000D, and fewer words than a shingle are one shingle. A bit
    is 1 if more than half of the shingles' XXH64 have it.
    """
    raw = utf8(text).lower()
    ones, n, held = np.zeros(64, np.int64), 0, []
    for part in _parts(raw):
        words = held + part.split()
        if len(words) >= shingle:
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(size)
            starts, ends = (ends - size).tolist(), (ends - 1)[shingle - 1 :].tolist()
            joined, digest = b" ".join(words), xxhash.xxh64_intdigest
            hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends)]  # noqa: B905  the starts of the last words have no end
            n += len(hashes)
            ones += _set_bits(hashes)
        held = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not n:
        if not held:
            return 0
        n, ones = 1, _set_bits([xxhash.xxh64_intdigest(b" ".join(held), seed)])
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp long`` of every whole text; null texts count as empty, other columns aren't read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_and_text(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())], ["doc_id", "fp"])

    return select_id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def keys(fps: DataFrame) -> DataFrame:
    """``key, fp``: for both halves of a fingerprint the half itself, and the half with each of its bits left out.

    Of two fingerprints that differ in at most three bits, one half differs in at most one: they share the key of that
    half itself, or the one without the bit that differs.
    """
    half, bit = F.expr("n DIV 33"), F.expr("n % 33")
    value = F.when(half == 0, F.expr("shiftrightunsigned(fp, 32)")).otherwise(F.expr("fp & 4294967295"))
    masked = F.when(bit == 32, value).otherwise(value.bitwiseAND(F.expr("~shiftleft(1L, cast(n % 33 as int))")))
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("n")).select(
        (masked + F.col("n") * F.lit(1 << 32)).alias("key"), "fp"
    )


def _near(a: np.ndarray, b: np.ndarray, most: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a and b that differ in at most ``most`` bits, block by block; same: a is b, each pair once."""
    left, right = [], []
    for i in range(0, len(a), BLOCK):
        for j in range(i if same else 0, len(b), BLOCK):
            x, y = np.nonzero(np.bitwise_count(a[i : i + BLOCK, None] ^ b[None, j : j + BLOCK]) <= most)
            if same and i == j:
                x, y = x[x < y], y[x < y]
            left.append(x + i)
            right.append(y + j)
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def _links(fps: np.ndarray, other: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_near` of fps with itself. A large bucket is first cut by the 32 bits at ``other``, in two parts of 16.

    Of fingerprints in a bucket these bits differ in at most three, so that one part differs in at most one. Such a
    sub-bucket has fewer than 2 ** 18 different fingerprints, whatever the input.
    """
    if len(fps) <= CUT:
        return _near(fps, fps, most, same=True)
    left, right = [], []
    for at in (other, other + 16):
        part = (fps >> np.uint64(at)) & np.uint64(0xFFFF)
        for bit in range(17):
            key = part if bit == 16 else part & ~np.uint64(1 << bit)
            order = np.argsort(key, kind="stable")
            ends = np.flatnonzero(np.diff(key[order])) + 1
            for run in np.split(order, ends):
                if len(run) > 1:
                    if bit == 16:
                        x, y = _near(fps[run], fps[run], most, same=True)
                        left.append(run[x])
                        right.append(run[y])
                    else:
                        one = (part[run] >> np.uint64(bit)) & np.uint64(1) == 1
                        x, y = _near(fps[run[one]], fps[run[~one]], most, same=False)
                        left.append(run[one][x])
                        right.append(run[~one][y])
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def _spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position that each of n positions is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_edges(key: int, fps: np.ndarray, most: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the bucket's verified links connect: at most one for each fingerprint."""
    half, bit = divmod(int(key) >> 32, 33)
    if bit == 32:
        left, right = _links(fps, 0 if half == 0 else 32, most)
    else:  # fingerprints with the same half meet in its own bucket: here only the two sides of the bit left out
        one = (fps >> np.uint64(bit + (32 if half == 0 else 0))) & np.uint64(1) == 1
        a, b = np.flatnonzero(one), np.flatnonzero(~one)
        if not len(a) or not len(b):
            return fps[:0], fps[:0]
        if min(len(a), len(b)) > CUT:
            left, right = _links(fps, 0 if half == 0 else 32, most)
        else:
            x, y = _near(fps[a], fps[b], most, same=False)
            left, right = a[x], b[y]
    if not len(left):
        return fps[:0], fps[:0]
    root = _spanning(len(fps), left, right)
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def _verified(most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key_column: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], np.diff(key_column) != 0])) if len(key_column) else np.zeros(0, int)
            sizes = np.diff(np.append(starts, len(key_column)))
            u, v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for i in np.flatnonzero(sizes > 1):
                x, y = bucket_edges(key_column[starts[i]], fps[starts[i] : starts[i] + sizes[i]], most)
                u.append(x)
                v.append(y)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], ["u", "v"])

        rest_key, rest = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if cut or rest_key[-1].size and rest_key[-1][-1] != key[0]:
                yield out(np.concatenate([*rest_key, key[:cut]]), np.concatenate([*rest, fps[:cut]]))
                rest_key, rest = [], []
            rest_key.append(key[cut:])
            rest.append(fps[cut:])
        yield out(np.concatenate(rest_key), np.concatenate(rest))

    return run


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """``u, v``: edges that connect the different values of ``fp`` which differ in at most ``most`` (up to 3) bits.

    Buckets arrive sorted and are compared in numpy blocks; what leaves a bucket is a spanning forest of its links, so
    that rows grow with the fingerprints, never with the pairs of a bucket.
    """
    if not 0 <= most <= 3:
        raise ValueError("two halves find links of at most 3 bits")
    dealt = keys(fps.select("fp")).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_verified(most), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: the smallest doc_id reachable over links of at most ``most`` differing bits.

    Copies share a fingerprint and are one row of the index; so that a fingerprint of very many documents isn't one task's,
    its documents get their component in ``SALTS`` parts. Rows with null texts count as empty; a null doc_id is kept
    and never represents others (a component without any id has a null component_id); repeated rows stay; empty in,
    empty out.
    """
    prints = materialise(fingerprints(docs, shingle, 42, id_col, text_col)).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    parts = materialise(prints.groupBy("fp", "salt").agg(F.min("doc_id").alias("first_id")))
    classes = materialise(parts.groupBy("fp").agg(F.min("first_id").alias("first_id")))
    roots = materialise(components(links(classes, most)))
    linked = classes.join(roots, classes.fp == roots.node).select("fp", "first_id", "root")
    moved = with_least(linked, "root", "first_id", "fp").select("fp", F.col("least").alias("least_id"))
    labels = classes.join(moved, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"))
    salted = parts.select("fp", "salt").join(labels, "fp")
    return prints.join(salted, ["fp", "salt"]).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """The documents without near-duplicates of another with a smaller doc_id; columns as they were.

    Rows that repeat a doc_id are one document and one of them stays. A row with a null doc_id can't stand for a group
    and goes only if a document with an id is near it.
    """
    found = materialise(near_duplicates(docs, shingle, most))
    gone = found.where("doc_id > component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = materialise(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if not repeated.isEmpty():
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return kept.select(*docs.columns)
