"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehouse.llm import (
    bloom_cascade, byte_bpe, language, order_minhash, prefix_trie, quality, secrets, spotsigs, substrings, tiling, warc, wavelet, whitening)
from tablehouse.llm.common import fit, prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_class")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_cascade.judge(_table(spark, sf_dir, "pages"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.predict(fit(docs, doc_id="long", text="string"), model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.secrets(docs, secrets.train(secrets.labelled_findings(spark, docs)))


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return spotsigs.neighbours(docs, spotsigs.common_words(docs))


def op10_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("tiles")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_wavelet, op2_order_minhash, op3_warc, op4_bloom_cascade, op5_byte_bpe, op6_language, op7_substrings, op8_secrets, op9_spotsigs, op10_tiling,
           op11_whitening, op12_quality, op13_prefix_trie)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def llm_sql() -> dict[str, str]:
    return {"op3_warc": warc.SQL, "op4_bloom_cascade": bloom_cascade.SQL, "op7_substrings": substrings.SQL, "op13_prefix_trie": prefix_trie.SQL}
