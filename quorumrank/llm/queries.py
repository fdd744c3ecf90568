"""Driver queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import context_tree, embed_dedup, fingerprint, ngram_join, packing, piece_codec, pii, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised_documents(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op4_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scores(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_piece_round_trip": op4_piece_round_trip,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_context_tree_scores": op7_context_tree_scores,
    "op8_packing": op8_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_fingerprints": op10_fingerprints,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base 32 of a SHA-1: five hex digits are four of base 32.
_ARCHIVED = """
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (
    select page_id, payload, strlen(payload) as bytes, list_transform(split(sha1(payload), ''),
    lambda c: strpos('0123456789abcdef', c) - 1) as x,
        min(page_id) over (partition by payload) as first
    from p
),
v as (
    select *, list_transform(range(0, 8),
    lambda i: (((x[5 * i + 1] * 16 + x[5 * i + 2]) * 16 + x[5 * i + 3]) * 16 + x[5 * i + 4]) * 16 + x[5 * i + 5]) as parts from d
)
select page_id, bytes as payload_bytes,
    array_to_string(list_transform(flatten(list_transform(parts, lambda n: [n // 32768, n // 1024 % 32, n // 32 % 32, n % 32])),
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(k + 1 as bigint), 1)), '') as payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from v
"""

_JACCARD = f"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
    from documents
),
sets as (
    select doc_id, case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from w
),
items as (select doc_id, len(s) as n, unnest(s) as x from sets),
shared as (select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m, count(*) as i from items a join items b on a.x = b.x
and a.doc_id < b.doc_id group by all),
links as (select a, b from shared where 100 * i >= 80 * (n + m - i)),
ways as (select a, b from links union all select b, a from links),
reach as (select doc_id as node, doc_id as seen from documents union select r.node, w.b from reach r join ways w on r.seen = w.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.seen) as component_id
from sets s join reach r on r.node = s.doc_id group by s.doc_id, s.s
"""

_CLOSE = """
with recursive v as (
    select vec_id, label, cast(embedding as double[]) as e from embeddings
    where embedding is not null and label is not null and len(embedding) > 0
),
u as (
    select vec_id, label, e, sqrt(list_dot_product(e, e)) as norm from v
    where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_max(list_transform(e, lambda x: abs(x))) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
),
reach as (select vec_id as node, vec_id as seen from embeddings union select r.node, l.b from reach r
join links l on r.seen = l.a),
counts as (select a, count(*) as n from links group by a),
least as (select node, min(seen) as low from reach group by node)
select e.vec_id, coalesce(c.n, 0) as n_links, l.low as component_id, e.vec_id = l.low as kept
from embeddings e join least l on l.node = e.vec_id left join counts c on c.a = e.vec_id
"""

#: DuckDB SQL of the operators that SQL can express; the others are learned, tokenise, or hash in ways that it lacks.
ORACLES: dict[str, str] = {"op3_warc": _ARCHIVED, "op6_ngram_jaccard_join": _JACCARD, "op9_embedding_near_dedup": _CLOSE}
