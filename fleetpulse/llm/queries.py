"""The registered queries of this folder, and SQL where it can express them."""

from pyspark.sql import functions as F

from fleetpulse.llm import (chat, exact_dedup, extraction, filter_audit, hamming_search, mixing, near_dedup, packing, pii, quality,
                            resampling, sharding, substring_dedup)
from fleetpulse.llm.common import table


def op1_skip_chain_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_dom_tree_extraction(spark, sf_dir):
    return extraction.main_texts(table(spark, sf_dir, "pages"))


def op3_poisson_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key")


def op4_multi_index_search(spark, sf_dir):
    return hamming_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_induced_substring_dedup(spark, sf_dir):
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op6_golomb_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_bm25_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_factorisation_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_setsketch_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op10_best_fit_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op11_lehmer_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark, sf_dir):
    return resampling.resampling_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_typed_chat_format(spark, sf_dir):
    odd = "'</s>[INST] ok [/INST]'"
    added = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', {odd}), (-7L, 1L, 'assistant', {odd}) AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.chat_formatted(chat.text_messages(rows)))


QUERIES = {f.__name__: f for f in (
    op1_skip_chain_pii, op2_dom_tree_extraction, op3_poisson_mixing, op4_multi_index_search,
    op5_induced_substring_dedup, op6_golomb_exact_dedup, op7_bm25_packing, op8_factorisation_quality,
    op9_setsketch_near_dedup, op10_best_fit_sharding, op11_lehmer_filter_audit, op12_importance_resampling,
    op13_typed_chat_format)}

ORACLES = {
    "op3_poisson_mixing": mixing.ORACLE,
    "op4_multi_index_search": hamming_search.ORACLE,
    "op6_golomb_exact_dedup": """
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM plain WINDOW g AS (PARTITION BY t)""",
    "op11_lehmer_filter_audit": filter_audit.ORACLE,
    "op13_typed_chat_format": chat.ORACLE,
}
