"""A training corpus from ``documents``: quality, line dedup, near-dedup, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import bpe, decontaminate, line_dedup, quality, simhash
from freshet.llm.common import materialise, table
from freshet.llm.queries import VOCABULARY
from public_tokenizers import PATTERN


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are similar to a line at an earlier place go; every document stays, if with fewer lines or none."""
    return line_dedup.without_lines(docs, line_dedup.removed_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a whole shorter one) go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text that is left."""
    return bpe.digests(bpe.decode(bpe.encode(docs, VOCABULARY, PATTERN), VOCABULARY, PATTERN))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("line_dedup", line_deduped),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("token_ids", token_ids),
]

#: SQL can't express the stages; the tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
