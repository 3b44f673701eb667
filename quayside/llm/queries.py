"""One query per operator over its whole table, with production parameters; columns as their contracts say."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import byte_bpe, filter_audit, lexical_search, line_dedup, line_rules, near_dedup, packing, private_data
from quayside.llm import quality_model, sharding, suffix_dedup, token_files, vector_dedup
from quayside.llm.common import table
from quayside.session import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID, SEPARATOR_ID = 1, 0
SEQUENCE = 2048
#: Score from which a document counts as good.
GOOD = 0.7


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), near_dedup.MinHash(shingle=4))


def op2_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(documents(spark, sf_dir), WORD_BPE, END_ID)
    keys = token_files.written_keys(spark, files)
    found = token_files.checksums_by_key(spark, files, keys)
    return found.select("doc_id", "start", F.col("n").alias("n_tokens"), "ids_crc32")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.all_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*private_data.BASE_KINDS))
    counts = [_count(kind).alias(f"n_{kind}") for kind in private_data.BASE_KINDS]
    digest = F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _joined(F.col("spans")).alias("spans"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_BPE, SEQUENCE, SEPARATOR_ID)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(quality_model.document_statistics(documents(spark, sf_dir)), "statistics")
    model = quality_model.train(stats, table(spark, sf_dir, "labels"))
    scored = quality_model.score_statistics(stats, model)
    return scored.select(
        "doc_id", quality_model.held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op9_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(documents(spark, sf_dir)).drop("text", "cleaned_text")


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_rendezvous_sharding, op3_line_dedup, op4_byte_bpe, op5_token_files, op6_private_data,
        op7_best_fit_packing, op8_quality_classifier, op9_vector_near_dedup, op10_quality_rules, op11_filter_interaction_audit,
        op12_ranked_lexical_search, op13_suffix_array_dedup,
    )
}
ORACLES: dict[str, str] = {
    "op11_filter_interaction_audit": filter_audit.SQL, "op12_ranked_lexical_search": lexical_search.SQL,
    "op13_suffix_array_dedup": suffix_dedup.SQL,
}
