"""The registered queries of the thirteen operators, with their production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm import (
    centroids, decontaminate, embedding_dup, html_extract, language, language_model, line_dedup, near_dup, packing,
    personal_data, prefix_trie, quality, url_filter,
)
from churnkit.llm.common import Scratch, read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text", *more)


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op2_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


def op4_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(documents(spark, sf_dir, "lang"))


def op5_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op6_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dup.near_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), cosine=0.95)


def op7_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_deletion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    out = line_dedup.dedup_lines(documents(spark, sf_dir), scratch, short=True)
    return scratch.result(out.select("doc_id", "n_lines", "dropped", F.crc32("clean_text").alias("clean_crc32")))


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block of documents is what a task reads: a split of a file, or a part of a large split."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "_metadata.file_path", "_metadata.file_block_start")
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, split // (8 << 20))))
    return language_model.score(docs, block=F.xxhash64("file_path", "file_block_start", part))


def op10_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages", "page_id", "url"))


def op11_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_fingerprint_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(documents(spark, sf_dir), personal_data.fit(personal_data.labelled_table(spark)))


QUERIES = {f.__name__: f for f in (
    op1_quality_knn, op2_vector_best_fit, op3_lsh_forest, op4_byte_cnn_language, op5_greedy_string_tiling,
    op6_sorted_projections, op7_tag_path_ratios, op8_deletion_lines, op9_pitman_yor, op10_url_vocabulary, op11_ns_bounds,
    op12_fingerprint_trie, op13_crf_personal_data)}

ORACLE_SQL = {"op10_url_vocabulary": url_filter.sql(), "op11_ns_bounds": centroids.sql(),
              "op12_fingerprint_trie": prefix_trie.sql()}
