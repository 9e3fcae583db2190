"""The registered query of each operator, with production parameters, over
the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.llm import (
    alignment,
    byte_bpe,
    jaccard_join,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    token_output,
    topk,
    url_filters,
    warc,
    whitening,
)
from aevia.llm.common import read_table, saved, use_package, vocabulary_path
from aevia.sources.storage import scratch_path


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    path = scratch_path(spark, "op1-packed")
    token_output.write_packed(read_table(spark, sf_dir, "documents"), path, vocabulary_path("byte_bpe_50k.json"),
                              end_id=2, vocabulary=50_257)
    return token_output.with_starts(saved(token_output.read_packed(spark, path), "op1-read"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"), size=50)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return packing.best_fit_packing(read_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"),
                                    end_id=1, capacity=4096)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, quality_rules.fit_log_ratios(docs, trusted))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    use_package(spark)
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(vocabulary_path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), bpe)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(read_table(spark, sf_dir, "pages")).drop("bad_bound")


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    vectors = topk.whole_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    raw, own = scratch_path(spark, "op11-raw"), scratch_path(spark, "op11-own")
    warc.write_responses(read_table(spark, sf_dir, "pages"), raw)
    warc.deduplicate(spark, raw, own, min_bytes=0)
    return warc.resolved(spark, own).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"), components=32)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_package(spark)
    return alignment.align(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"),
                           vocabulary_path("piece_bpe_32k.model"))[0]


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_counts": op7_token_counts,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_url_filters": op9_url_filters,
    "op10_exact_topk": op10_exact_topk,
    "op11_warc": op11_warc,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}
