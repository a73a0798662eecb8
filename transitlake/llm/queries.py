"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, pack, pii, quality, spotsigs, substrings, tokens, urls, warc
from .shared import spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(_table(spark, sf_dir, "documents"), end_id=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_documents(_table(spark, sf_dir, "documents"), pack.Limits(2048, 2048, 2048), end_id=1)


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing operator's form for instruction data, where tokens, segments and loss-bearing tokens are three limits."""
    return pack.pack_conversations(_table(spark, sf_dir, "conversations"), pack.Limits(2048, 16, 1024), end_id=1)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(_table(spark, sf_dir, "documents"), whole=True)


def spotsigs_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints' search: documents whose id is divisible by 100 against the sets of all."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spotsigs.search(docs, docs.where("doc_id % 100 = 0"), whole=True, expand=False)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build(warc.responses(_table(spark, sf_dir, "pages"))).drop("warc")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_token_id_output,
        op3_packing,
        op4_document_fingerprints,
        op5_quality_classifier,
        op6_pii,
        op7_substring_dedup,
        op8_ngram_jaccard_join,
        op9_warc_derivatives,
        op10_url_filter,
        pack_conversations,
        spotsigs_search,
    )
}
