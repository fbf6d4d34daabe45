"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise, scratch_dir  # noqa: F401

#: Characters of text that one step of a Python worker handles together.
SLICE_CHARS = 2_000_000


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, wherever they were started.

    On a cluster the package comes with ``--py-files`` or is installed, and this path is only one more entry.
    """
    root, path = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{path}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by this Python worker until it needs something else: a worker holds one large table at a time.

    A job's stages run in the same workers; what an earlier one made goes, and its memory goes back to the system.
    """
    if key not in _kept:
        _kept.clear()
        gc.unfreeze()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # where the C library can't, its memory is used again later
            ctypes.CDLL(None).malloc_trim(0)
        _kept[key] = make()
        gc.freeze()  # the table stays: collections needn't walk it again and again
    return _kept[key]


def unused(names: list[str], columns: Iterable[str]) -> list[str]:
    """The names, with as many underscores before them as it takes for the columns to lack them all."""
    taken = {c.lower() for c in columns}
    while taken & {n.lower() for n in names}:
        names = [f"_{n}" for n in names]
    return names


def text_slices(ids: list, texts: list, max_chars: int = SLICE_CHARS) -> Iterator[tuple[list, list]]:
    """Cut a batch so that a step holds about ``max_chars`` characters, or one text if that is longer."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > max_chars:
            yield ids[start:i], texts[start:i]
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield ids[start:], texts[start:]


def id_and_text(batches: Iterable[pa.RecordBatch], max_chars: int = SLICE_CHARS) -> Iterator[tuple[list, list]]:
    """(ids, texts) in slices of bounded size; a null text is empty."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = [x or "" for x in batch.column(1).to_pylist()]
        yield from text_slices(ids, texts, max_chars)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _normaliser() -> bytes:
    out = bytearray(b" " * 256)
    for c in range(256):
        if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80:
            out[c] = c
        elif 0x41 <= c <= 0x5A:
            out[c] = c + 0x20
    return bytes(out)


#: Byte table that lower-cases A-Z and blanks every other ASCII character that is neither letter nor digit.
WORD_BYTES = _normaliser()


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8.

    All bytes of a character outside ASCII are 0x80 or more, so that the byte table sees the same words as the pattern.
    """
    return utf8(text).translate(WORD_BYTES).split()


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open character ranges of the original text for ranges of words."""
    raw = utf8(text)
    places = [m.span() for m in _WORD.finditer(raw)]
    heads = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80  # first bytes of characters
    before = np.concatenate([[0], np.cumsum(heads)])
    return [(int(before[places[a][0]]), int(before[places[b - 1][1]])) for a, b in ranges]


def select_id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
