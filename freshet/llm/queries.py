"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, decontaminate, html_text, licenses, line_dedup, media, quality, simhash, spelling, token_files, warc
from .common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents")).drop("caption")  # equal texts have equal rows


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.format_string("%016x", "fp").alias("fingerprint"), "component_id")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.summary(docs, line_dedup.removed_lines(docs))


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(ids, VOCABULARY, public_tokenizers.PATTERN))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.summary(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and as conversation -1 two turns that say marks."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(False).alias("added"))
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"), F.lit(True).alias("added"))
    return chat.summary(chat.format_chats(said.unionByName(own), ["conv_id", "added"]))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_media_columns,
        op2_simhash_near_dedup,
        op3_html_extraction,
        op4_license_scans,
        op5_quality_classifier,
        op6_line_dedup,
        op7_byte_level_bpe,
        op8_benchmark_decontamination,
        op9_token_files,
        op10_warc,
        op11_spelling_variants,
        op12_chat_formatting,
        op13_collocations,
    )
}
#: DuckDB twins; the other queries can't be expressed in SQL and are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op8_benchmark_decontamination": r"""
        with words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), item_words as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark
        ), windows as (
            select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as gram
            from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from item_words where len(w) > 0)
        ), sizes as (
            select distinct n from windows
        ), grams as (
            select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as gram
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where len(w) >= n)
        ), found as (
            select doc_id, item_id, i, n from grams join windows using (n, gram)
        ), hit as (
            select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id
        ), items as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
            from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
        )
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from words left join hit using (doc_id) left join items using (doc_id)
    """,
    "op10_warc": """
        with p as (
            select page_id, encode(coalesce(html, '')) as payload from pages
        ), d as (
            select page_id, octet_length(payload) as payload_bytes, sha256(payload) as payload_digest from p
        ), f as (
            select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from d
        )
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
               case when page_id <> first_id then 'revisit' else 'response' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from f
    """,
    "op12_chat_formatting": r"""
        with said as (
            select conv_id, false as added, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-1, true, 0, 'user', '</s>[INST] ok [/INST]'), (-1, true, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), placed as (
            select *, row_number() over w as place, coalesce(lag(role) over w <> role, true) as begins
            from said window w as (partition by conv_id, added order by turn nulls first, role, text)
        ), sized as (
            select *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|TEXT\]|NEXT\])', '\1\2\\\3', 'g')) as chars,
                   length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|TEXT\]|NEXT\])', '\1\2\\\3', 'g')) as role_chars
            from placed
        )
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
               cast(3 + sum(chars + case when not begins then 6 when role = 'user' then 15 when role = 'system' then 13 when role = 'assistant' then 5 else 19 + role_chars end) as bigint) as formatted_chars
        from sized group by conv_id, added
    """,
    "op13_collocations": r"""
        with pieces as (
            select row_number() over () as piece, lang, regexp_extract_all(piece, '[^ \t]+') as w
            from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) as piece from documents)
        ), words as (
            select lang, word, lead(word) over v as second, lead(word, 2) over v as third
            from (select piece, lang, unnest(w) as word, generate_subscripts(w, 1) as i from pieces where len(w) > 0)
            window v as (partition by piece order by i)
        ), grams as (
            select lang, 1 as k, word as phrase, count(*) as f from words group by all
            union all select lang, 2, word || ' ' || second, count(*) from words where second is not null group by all
            union all select lang, 3, word || ' ' || second || ' ' || third, count(*) from words where third is not null group by all
        ), total as (
            select lang, cast(sum(f) as bigint) as n from grams where k = 1 group by lang
        ), candidates as (
            select *, string_split(phrase, ' ') as w from grams where k > 1 and f >= 10
        ), cuts as (
            select c.lang, c.k, c.phrase, c.f as a, cut, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
            from (select *, unnest(range(1, k)) as cut from candidates) c
            join grams l on l.lang = c.lang and l.k = cut and l.phrase = array_to_string(list_slice(c.w, 1, cut), ' ')
            join grams r on r.lang = c.lang and r.k = c.k - cut and r.phrase = array_to_string(list_slice(c.w, cut + 1, c.k), ' ')
        ), best as (
            select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
        ), longer as (
            select lang, part, max(f) as f
            from (select lang, f, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) as part from candidates where k = 3)
            group by all
        )
        select b.lang, row_number() over (partition by b.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
        from best b join total using (lang) left join longer g on g.lang = b.lang and g.part = b.phrase
        where not coalesce(100 * g.f >= 50 * a, false)
        qualify rank <= 2000
    """,
}
