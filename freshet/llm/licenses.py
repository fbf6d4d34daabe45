"""Fuzzy search for short licence notices: exact seeds, then bounded-error matching with spans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import char_spans, id_and_text, select_id_text, words_of

#: Phrases that count wherever their words stand consecutively (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that are searched with errors, and their labels.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "creative commons attribution": "cc-by",
    "mit license": "mit",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "all-rights-reserved",
    "gnu free documentation license": "gfdl",
    "boost software license": "boost",
    "creative commons zero": "cc0",
    "microsoft public license": "ms-pl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def errors_of(notice: str) -> int:
    """Edits (characters inserted, deleted or replaced) that a notice may have: one for every ten characters, four at most."""
    return min(4, len(notice) // 10)


class NoticeSearch:
    """The automaton of the notices' seeds and their bounded-error patterns.

    A notice with at most k edits is cut into k + 1 seeds: the edits can't touch all of them, so that each occurrence
    holds a seed as it is. Around every seed that is found, a window wide enough for the notice and k insertions is
    matched by ``(?e)(?:notice){e<=k}``; that is the only place where errors are counted.
    """

    def __init__(self, notices: dict[str, str]) -> None:
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, (notice, label) in enumerate(sorted(notices.items())):
            k = errors_of(notice)
            cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(notice[a:b], []).append((n, a))
            # word borders belong to the match: a notice inside a longer word is none
            pattern = regex.compile(rf"(?e)(?<= )(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}(?= )")
            self.notices.append((notice, label, k, pattern))
        self.machine = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.machine.add_word(seed, (len(seed), uses))
        self.machine.make_automaton()

    def find(self, line: str) -> list[tuple[int, int, int, str]]:
        """(start, end, edits, label) of every match in a line of words with one space around each, in order.

        Matches of one notice don't overlap: where windows meet they are searched as one.
        """
        windows: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.machine.iter(line):
            for n, offset in uses:
                notice, _, k, _ = self.notices[n]
                start = max(0, end + 1 - size - offset - k - 1)
                stop = min(len(line), end + 1 - size - offset + len(notice) + k + 1)
                mine = windows.setdefault(n, [])
                if mine and start <= mine[-1][1]:
                    mine[-1][0] = min(mine[-1][0], start)
                    mine[-1][1] = max(mine[-1][1], stop)
                else:
                    mine.append([start, stop])
        found = []
        for n, mine in windows.items():
            _, label, _, pattern = self.notices[n]
            for start, stop in mine:
                for m in pattern.finditer(line, start, stop):
                    found.append((m.start(), m.end(), sum(m.fuzzy_counts), label))
        return sorted(found)


def base_places(line: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand consecutively."""
    places = []
    for phrase, label in phrases.items():
        key = f" {phrase} "
        at, counted, words = line.find(key), 0, 0
        while at >= 0:
            words += line.count(" ", counted, at)
            counted = at
            places.append((words, label))
            at = line.find(key, at + 1)
    return sorted(places)


def word_spans(line: str, found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """(first word, last word, edits, label) of matches in order of their start."""
    out, counted, words = [], 0, 0
    for a, b, edits, label in found:
        words += line.count(" ", counted, a)
        counted = a
        out.append((words - 1, words - 1 + line.count(" ", a, b), edits, label))
    return out


_SPAN = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("label", pa.string())])
SCHEMA = "doc_id long, n_words long, base array<struct<word:long,label:string>>, spans array<struct<first_word:long,last_word:long,start:long,end:long,edits:int,label:string>>"
_searches: dict[tuple, NoticeSearch] = {}


def scan(docs: DataFrame, notices: dict[str, str] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, base, spans`` of every whole text.

    ``base`` are the exact places of the base phrases, ``spans`` the words that bounded-error matches of the notices
    cover, the characters of the original text from ``start`` up to ``end``, and their edits. No shuffle. A null or empty text has no words and no places; repeated rows and null ids
    stay; other columns aren't read. Words that carry non-ASCII letters are compared byte by byte.
    """
    notices, base = dict(notices or NOTICES), dict(base or BASE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(sorted(notices.items()))
        search = _searches.get(key) or _searches.setdefault(key, NoticeSearch(notices))
        for ids, texts in id_and_text(batches):
            counts, places, spans = [], [], []
            for text in texts:
                words = words_of(text)
                line = (b" " + b" ".join(words) + b" ").decode("latin-1")
                counts.append(len(words))
                places.append([{"word": w, "label": x} for w, x in base_places(line, base)])
                mine = word_spans(line, search.find(line))
                chars = char_spans(text, [(a, b + 1) for a, b, _, _ in mine]) if mine else []
                spans.append([{"first_word": a, "last_word": b, "start": c, "end": d, "edits": e, "label": x} for (a, b, e, x), (c, d) in zip(mine, chars, strict=True)])
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])), pa.list_(_SPAN)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((ids, counts, places, spans), kinds, strict=True)], ["doc_id", "n_words", "base", "spans"])

    return select_id_text(docs).mapInArrow(run, SCHEMA)


def summary(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` of what :func:`scan` returns.

    ``spans`` are the fuzzy matches as ``label:start-end~edits`` in characters of the text, comma-joined.
    The score is 1 with a base phrase, else 1 less a tenth for each edit of the best notice, and 0 without any.
    """
    return scanned.selectExpr(
        "doc_id",
        "n_words",
        "cast(size(base) as bigint) as n_base",
        "array_min(base.word) as first_word",
        "array_max(base.word) as last_word",
        "array_join(array_sort(array_distinct(base.label)), ',') as base_labels",
        "array_join(array_sort(array_union(base.label, spans.label)), ',') as labels",
        "case when size(base) > 0 then 1.0D when size(spans) > 0 then 1.0D - array_min(spans.edits) * 0.1D else 0.0D end as score",
        "array_join(transform(spans, x -> concat(x.label, ':', x.start, '-', x.end, '~', x.edits)), ',') as spans",
    )
