"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spolia.llm import bpe_pieces, fingerprints, grid_join, lm_scoring, mixing, ngram_join, prefix_trie
from spolia.llm import quality_rules, secret_links, suffix_dedup, token_files, toxicity, whitening
from spolia.llm.common import shared_folder, table

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.scan(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "shards")
    token_files.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_files.read_documents(spark, path).withColumnRenamed("key", "doc_id")


def op8_embedding_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.links(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return bpe_pieces.digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_links, op2_suffix_dedup, op3_ngram_join, op4_mixing, op5_lm_scoring, op6_fingerprints, op7_token_files,
        op8_embedding_grid_join, op9_toxicity, op10_byte_bpe, op11_prefix_trie, op12_quality_rules, op13_whitening,
    )
}
ORACLE_SQL = {
    "op8_embedding_grid_join": """
        with recursive v as (
            select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), u as (select vec_id, e, sqrt(list_inner_product(e, e)) r from v where list_inner_product(e, e) > 0),
        links as materialized (
            select a.vec_id a, b.vec_id b from u a join u b
            on a.vec_id <> b.vec_id and list_inner_product(a.e, b.e) >= 0.95 * a.r * b.r
        ), reach(a, b) as (
            select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a
        ), low as (select a vec_id, min(b) component_id from reach group by a),
        n as (select a vec_id, count(*) n_links from links group by a)
        select vec_id, coalesce(n_links, 0) n_links, component_id, vec_id = component_id as kept
        from low left join n using (vec_id)
    """,
    "op11_prefix_trie": """
        with recursive t as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos,
                coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null
        ), sizes as (select conv_id, count(*) n from t group by conv_id), c as (
            -- crc32 of the decimal number: for each of its bytes one exclusive-or and eight shifts (-1)
            select conv_id, n, conv_id - conv_id % 100 as base, xor(4294967295, list_reduce(
                flatten(list_prepend([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: [ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end
            )) % 6 as h from sizes
        ), sized as (select c.*, least(h, coalesce(b.n, 0)) as taken from c left join sizes b on b.conv_id = c.base),
        turns as (
            select s.conv_id, taken + pos - h + 1 as d, role, text from t join sized s using (conv_id) where pos >= h
            union all select s.conv_id, pos + 1, role, text from t join sized s on t.conv_id = s.base where pos < h
        ), steps(conv_id, d, key, parent, chars) as (
            select conv_id, 0::bigint, md5(''), null::varchar, 0::bigint from sizes
            union all
            select s.conv_id, t.d, md5(concat(s.key, length(t.role), ':', t.role, t.text)), s.key, length(t.text)
            from steps s join turns t on t.conv_id = s.conv_id and t.d = s.d + 1
        ), prefixes as (select *, max(d) over (partition by conv_id) as last from steps),
        nodes as (select key, d, any_value(parent) parent, any_value(chars) chars, min(conv_id) conv_id, count(*) n from prefixes group by key, d),
        children as (select parent as key, d - 1 as d, count(*) n from nodes where d > 0 group by all),
        -- each node adds to all the prefixes of its smallest member that are no longer than itself
        sums as (
            select p.key, p.d, sum((k.key is null)::int) leaves, sum((x.n - 1) * x.chars) saved
            from nodes x left join children k on (x.key = k.key and x.d = k.d) join prefixes p on (p.conv_id = x.conv_id and p.d <= x.d) group by p.key, p.d
        ), ends as (select key, d, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) sha from prefixes where d = last group by key, d)
        select x.conv_id, x.d::bigint as depth, u.conv_id as parent_conv_id, x.n::bigint as n_convs, coalesce(k.n, 0)::bigint as n_children,
            leaves::bigint as n_leaves, saved::bigint as saved_tokens, coalesce(sha, sha256('')) as ends_sha256
        from nodes x join sums s on (s.key = x.key and s.d = x.d) left join children k on (k.key = x.key and k.d = x.d)
            left join nodes u on (u.key = x.parent and u.d = x.d - 1) left join ends e on (e.key = x.key and e.d = x.d)
    """,
}
