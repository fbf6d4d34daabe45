"""The pipeline: its stages, their columns, and their decisions against brute-force versions."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from freshet.llm import decontaminate, line_dedup, simhash
from freshet.llm.common import materialise

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = decontaminate.Windows(benchmark)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "token_ids"]
    for name, stage in pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, SF))
        assert out.columns == columns
        old, new = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert {labels[i] for i in set(old) - set(new) if i in labels} <= {0} and {labels[i] for i in new if i in labels} <= {1}
        elif name == "line_dedup":
            lines = sorted((d, i, set(w)) for d, t in old.items() for i, w in enumerate(line_dedup.lines_of(t)) if w)
            gone = {(d, i) for n, (d, i, s) in enumerate(lines) if any(line_dedup.similar(s, q) for _, _, q in lines[:n])}
            assert new == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in old.items()}
        elif name == "near_dedup":
            prints = {d: simhash.fingerprint(t) & (2**64 - 1) for d, t in old.items()}
            for d in set(old) - set(new):
                assert any((prints[d] ^ prints[k]).bit_count() <= 3 for k in old if k < d)
            left = sorted(new)
            assert not any((prints[a] ^ prints[b]).bit_count() <= 3 for n, a in enumerate(left) for b in left[:n])
        else:
            assert set(new) == {d for d, t in old.items() if not windows.scan(t)[1]}
        docs = out
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() <= before
    assert entry.queries()["pipeline"](spark, SF).count() == docs.count()


def test_registered():
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
