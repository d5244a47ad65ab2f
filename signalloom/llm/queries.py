"""The corpus queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalloom.llm import (
    dac,
    fingerprint,
    hard_negatives,
    minhash,
    packing,
    pii,
    positional_index,
    radix_dedup,
    rules,
    secret_scan,
    spelling,
    suffix_levels,
    word_table,
)
from signalloom.llm.common import read_table
from signalloom.sources.scratch import scratch_path


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    dac.write_shards(read_table(spark, sf_dir, "documents"), path)
    return dac.read_documents(spark, path)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(secret_scan.scan_secrets(read_table(spark, sf_dir, "documents")))


def op4_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_table.encode_digests(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = rules.train(docs, read_table(spark, sf_dir, "labels"))
    scored = rules.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", rules.is_held_out().alias("held_out"), "score", "predicted")


def op6_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_digests(read_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_minhash": op2_minhash,
    "op3_secret_scan": op3_secret_scan,
    "op4_word_table": op4_word_table,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_levels": op6_suffix_levels,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_positional_index": op11_positional_index,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}

#: Of the other results none can be written in SQL that DuckDB runs; tests compare them with brute force.
ORACLE: dict[str, str] = {
    "op7_exact_dedup": """with low as (select cast(doc_id as bigint) as doc_id, sha256(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents),
          grp as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from low group by text_sha256)
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
        from low join grp using (text_sha256)""",
    "op11_positional_index": r"""with
        split as (select doc_id, row_number() over () as r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
        item as (select coalesce(cast(item_id as varchar), '') as item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
        starts as (select item_id, w, least(len(w), 10) as k, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from item where len(w) > 0),
        windows as (select distinct item_id, k, array_to_string(w[s : s + k - 1], ' ') as phrase from starts),
        places as (select r, w, k, unnest(range(1, len(w) - k + 2)) as s from split, (select distinct k from windows) where len(w) >= k),
        hit as (select r, item_id, p.s, p.k from places p join windows v on p.k = v.k and array_to_string(p.w[p.s : p.s + p.k - 1], ' ') = v.phrase),
        words as (select r, count(distinct pos) as n_hit from (select r, unnest(range(s, s + k)) as pos from hit) group by r),
        ids as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hit group by r)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
          sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
        from split left join words using (r) left join ids using (r)""",
    "op12_hard_negatives": """with
        usable as (select cast(vec_id as bigint) as vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
          where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        pairs as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
            cast(list_inner_product(a.v, b.v) as bigint) as score
          from usable a join usable b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
        good as (select anchor_id, other_id as positive_id, score as positive_score from pairs where same
          qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
        select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank,
          other_id as negative_id, positive_score, score as negative_score
        from good join pairs using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify row_number() over (partition by anchor_id, positive_id order by score desc, other_id) <= 3""",
}
