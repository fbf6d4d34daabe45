"""Spelling variants, chat formatting and collocations against brute-force versions and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import chat, collocations, spelling

# --- spelling variants --------------------------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(rows: list[tuple], factor: int = 10) -> set[tuple]:
    counts: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= factor * n:
            form[w] = best

    def root(w: str) -> str:
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def misspelt(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    stems = ["interna", "tional", "nanana", "ÉcolÉÉ", "straße", "zu", "aaaaaaa", "ction", "ÿÿ", "×"]
    words = ["".join(rng.choices(stems, k=rng.randint(2, 4))) for _ in range(30)] + ["a" * 9, "a" * 10, "abababab", "babababa", "x" * 300, "x" * 299 + "y"]
    rows = []
    for i in range(400):
        out = []
        for _ in range(30):
            w = words[min(int(rng.expovariate(0.15)), len(words) - 1)]
            for _ in range(rng.choice([0] * 12 + [1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abÀz") + w[k:], w[:k] + rng.choice("anç") + w[k + 1 :]])
            out.append(w if rng.random() < 0.7 else w.upper())
        rows.append((i, rng.choice([" ", ", ", "1", "中"]).join(out)))
    chain = [(2000 + i, "chainedwords" if i < 300 else "chainedwordss" if i < 325 else "chainedwordsss") for i in range(328)]
    return rows + chain + [(None, "Internationalnanana " * 40), (3, rows[3][1]), (3, rows[3][1]), (900, None), (901, ""), (902, " 12 中 " * 50)]


@pytest.mark.parametrize("crowded", [spelling.CROWDED, 1])
def test_variant_groups(spark, crowded):
    rows = misspelt(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("word", "n", "key", "spot", "root", "form")}).repartition(3)
    got = spelling.variant_groups(docs, crowded=crowded).collect()
    want = variants_by_hand(rows)
    assert len(got) == len(want) > 200 and {tuple(r) for r in got} == want
    assert any(r.form and r.root != r.form for r in got) and any(r.n_near > 3 for r in got)


def test_variant_groups_of_little(spark):
    docs = spark.createDataFrame([(1, "short words only"), (2, None)], "doc_id long, text string")
    assert spelling.variant_groups(docs).collect() == [] == spelling.variant_groups(docs.limit(0)).collect()
    two = spark.createDataFrame([(i, "variant variant variamt") for i in range(40)], "doc_id long, text string")
    assert {tuple(r) for r in spelling.variant_groups(two).collect()} == variants_by_hand([(i, "variant variant variamt") for i in range(40)])
    with pytest.raises(ValueError):
        spelling.variant_groups(docs, least_length=3)


def test_pivots():
    """The two pivots are disjoint, of the prefix, and the cheapest pair there."""
    rng = np.random.default_rng(1)
    for size in (3, 4, 6, 20):
        weights, counts = rng.integers(0, 8, (200, size)), rng.integers(1, 50, (200, size))
        inside = spelling.prefix_of(weights)
        first, second = spelling.pivots_of(weights, counts)
        for w, c, row, a, b in zip(weights, counts, inside, first, second, strict=True):
            assert set(np.flatnonzero(row)) == {i for i in range(size) if w[i] <= sorted(w)[2]}
            pairs = [(c[i] + c[j]) for i in np.flatnonzero(row) for j in np.flatnonzero(row) if j >= i + 2]
            assert row[a] and row[b] and b >= a + 2 and c[a] + c[b] == min(pairs)


def test_deletion_hashes(spark):
    """Words one edit apart share a variant, whatever their length."""
    words = ["abcdefgh", "abcdefg", "abcXefgh", "abcdefghi", "z" * 500, "z" * 499]
    rows = spelling.variants(spark.createDataFrame([(i, 0, w) for i, w in enumerate(words)], "key long, spot long, word string")).collect()
    of = {w: {r.variant for r in rows if r.word == w} for w in words}
    assert all(bool(of[a] & of[b]) == (one_edit(a, b) or a[:-1] == b or any(a[:i] + a[i + 1 :] == b[:j] + b[j + 1 :] for i in range(len(a)) for j in range(len(b)))) for a in words[:4] for b in words[:4] if a != b)
    assert of["z" * 500] & of["z" * 499]


# --- chat formatting -----------------------------------------------------------------------------------------------

TALKS = [
    (1, 0, "system", "be [SYS] kind"), (1, 1, "user", "hi"), (1, 2, "user", "there\n"), (1, 3, "assistant", "</s>[INST] ok [/INST]"), (1, 4, "assistant", ""), (1, 5, "user", None),
    (2, 1, "assistant", "late"), (2, None, "assistant", "first"), (2, 1, "assistant", "late"), (2, 1, None, "[NEXT][\\NEXT][\\\\NEXT]"),
    (3, 0, "tool[TEXT]", "[ROLE]x[TEXT]y[/ROLE]"), (3, 1, "tool[TEXT]", "< s> <\\s> <<s>> [[INST]] </s"), (3, 2, "", " "),
    (None, 0, "user", "no id"), (None, 1, "assistant", "é中😀"), (4, 0, None, None), (5, 0, "assistant", "x" * 200_000 + "[/INST]"),
]


def soup(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[TEXT]", "[NEXT]", "\\", "[", "<", "/", "]", "s>", "INST]", "$1", " ", "\n", "a", "é", "NEXT]"]
    return [(100 + i // 5, i % 5, rng.choice(["user", "assistant", "system", "".join(rng.choices(bits, k=3))]), "".join(rng.choices(bits, k=rng.randint(0, 12)))) for i in range(600)]


def test_chats(spark):
    rows = TALKS + soup(7)
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("turns", "begins", "blocks", "segments", "formatted")}).repartition(3)
    out = chat.format_chats(said)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", "segments", chat.turns_of(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned")).collect()}
    summary = {r.conv_id: r for r in chat.summary(out).collect()}
    assert set(got) == {r[0] for r in rows} == set(summary)
    for conv, own in got.items():
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        said_by = [(role, text) for _, _, role, text in turns]
        assert [tuple(t) for t in own.turns] == said_by
        assert own.formatted == "".join(s.piece for s in own.segments)
        learned = "".join(text for role, text in said_by if role == "assistant")
        assert own.learned == learned and sum(s.loss for s in own.segments) == sum(role == "assistant" for role, _ in said_by)
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(said_by, said_by[1:], strict=False))
        assert len(own.segments) == 1 + 2 * blocks + len(said_by) + (len(said_by) - blocks)
        s = summary[conv]
        assert (s.n_turns, s.loss_chars, s.formatted_chars) == (len(said_by), len(learned), len(own.formatted))
        assert s.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said_by).encode()).hexdigest()
        assert s.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert got[1].formatted == "<s>[SYS] be [\\SYS] kind [/SYS][INST] hi[NEXT]there\n [/INST] <\\/s>[\\INST] ok [\\/INST][NEXT]</s>[INST]  [/INST]"
    assert chat.summary(chat.format_chats(said.limit(0))).collect() == []


def test_chats_need_no_python(spark):
    said = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string")
    plan = chat.summary(chat.format_chats(said))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- collocations ----------------------------------------------------------------------------------------------------


def phrases_by_hand(rows: list[tuple], least: int, top: int) -> list[tuple]:
    f: Counter = Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang, *words[i : i + k]] += 1
    out = []
    for lang in {k[0] for k in f}:
        n = sum(v for k, v in f.items() if k[0] == lang and len(k) == 2)
        mine = []
        for key, a in f.items():
            w = key[1:]
            if key[0] != lang or len(w) < 2 or a < least:
                continue
            if len(w) == 2 and any(100 * b >= 50 * a for k, b in f.items() if k[0] == lang and len(k) == 4 and b >= least and w in (k[1:3], k[2:])):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
            mine.append((-score, -a, " ".join(w).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(mine)[:top], 1)]
    return sorted(out)


def prose(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "É", "é", "a\x00b", "x y", "中文", "'s", "<", "—"]
    rows = [(rng.choice(["en", "de", None, "", "und"]), "".join(rng.choice(words) + rng.choice([" "] * 12 + ["  ", "\t", ". ", "\n", ", ", "\r\n", "!?", " \x0b"]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return rows + [("en", None), ("en", ""), (None, " .\t, "), ("de", "ha " * 5000), ("en", "New York City"), *[("fr", "un deux trois quatre")] * 30]


@pytest.mark.parametrize(("least", "top", "modulus"), [(10, 2000, 16), (2, 7, 2), (1, 50, 1)])
def test_collocations(spark, least, top, modulus):
    rows = prose(least)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("clash") for c in ("phrase", "n", "a", "chunk", "own", "rank")}).repartition(3)
    got = collocations.collocations(docs, least=least, rows=top, modulus=modulus).collect()
    assert sorted(map(tuple, got)) == phrases_by_hand(rows, least, top) and got
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_chunks_cover_each_place_once():
    """Chunks overlap by two words, equal passages have equal chunks, and each place is counted in one chunk."""
    rng = random.Random(3)
    words = [rng.choice("abcdefgh") for _ in range(3000)]
    parts = list(collocations.chunks([" ".join(words)], modulus=4))
    assert sum(n for _, n in parts) == len(words) and len(parts) > 300
    at = 0
    for chunk, n in parts:
        own = chunk.decode().split(" ")
        assert own == words[at : at + len(own)] and len(own) in (n, n + 2)
        at += n
    assert len(set(parts)) < len(parts)
    assert list(collocations.chunks(["", " . "])) == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.range(1).selectExpr(f"{big}L as a", f"{big + 1}L as l", f"{2 * big + 7}L as r").select(collocations.scored("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * big * big // ((big + 1) * (2 * big + 7))
