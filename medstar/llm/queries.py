"""The queries of this package: ``QUERIES`` and ``ORACLE``, added to the
contract by ``__spark_entry__`` when the package is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from medstar.llm import (conversation_trie, decontaminate, kd_shards, language_centroids,
                         licence_digests, line_edit_join, line_frequency, mixing, order_minhash,
                         ranked_search, secret_scan, token_orc, toxicity_zstd)
from medstar.llm.common import table


def op1_pfair_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_kd_shards(spark, sf_dir):
    return kd_shards.shard_table(table(spark, sf_dir, "documents"), shards=16)


def op3_line_frequency(spark, sf_dir):
    return line_frequency.quality(table(spark, sf_dir, "documents"))


def op4_token_orc(spark, sf_dir):
    import public_tokenizers

    return token_orc.token_table(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("word_bpe_49k.json"))


def op5_line_edit_join(spark, sf_dir):
    return line_edit_join.line_dedup(table(spark, sf_dir, "documents"))


def op6_licence_digests(spark, sf_dir):
    return licence_digests.licence_hits(table(spark, sf_dir, "documents"))


def op7_language_centroids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_centroids.identify(docs, language_centroids.fit_languages(docs))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity_zstd.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity_zstd.score_toxicity(docs, model)


def op10_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "copies")


def op11_prefix_trie(spark, sf_dir):
    return conversation_trie.trie(table(spark, sf_dir, "conversations")).drop("bytes", "n_ends")


def op12_secret_scan(spark, sf_dir):
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search.ranked(table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "benchmark")).drop("bag_size")


QUERIES = {f.__name__: f for f in (
    op1_pfair_mix, op2_kd_shards, op3_line_frequency, op4_token_orc,
    op5_line_edit_join, op6_licence_digests, op7_language_centroids, op8_decontaminate, op9_toxicity, op10_order_minhash,
    op11_prefix_trie, op12_secret_scan, op13_ranked_search)}
ORACLE: dict[str, str] = {
    "op3_line_frequency": line_frequency.QUALITY_SQL,
    "op6_licence_digests": licence_digests.LICENCE_SQL,
    "op11_prefix_trie": conversation_trie.TRIE_SQL,
    "op13_ranked_search": ranked_search.SEARCH_SQL,
}
