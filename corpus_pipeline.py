"""From raw documents to packed training sequences, in five stages that each work on all the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from transitlake.llm import decontaminate, jaccard, pack, pii, quality
from transitlake.llm.shared import drop, scratch, shared_dir, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled ones among ``docs``.

    Null and empty texts are scored like others; repeated rows stay or go together; without labels of both kinds the share of the one kind decides for all.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each class of near duplicates; of equal ids the one with the least row key.

    Texts without words, null ones too, stay, but a row that repeats stays once.
    """
    return jaccard.drop_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark; null and empty texts, which have no words, stay, repeated rows stay or go together."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each piece of personal data; null stays null, empty stays empty, repeated rows stay."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids and their places in sequences; a null or empty text is its end id alone, repeated rows are packed as often."""
    return pack.pack_documents(docs, pack.Limits(2048, 2048, 2048), end_id=1, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_class),
    ("decontamination", uncontaminated),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: SQL has no tokenizer and fits no model; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder before the next one begins, and then what it came from goes."""
    docs, folder, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = staged(stage(spark, docs, sf_dir), folder, name)
        if before:
            drop(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
