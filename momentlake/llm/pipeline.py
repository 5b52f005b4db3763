"""From raw documents to packed token windows, in five stages.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet in the shared folder
and read again as the next one's ``docs``.  All but the last keep the columns of ``documents``.
Rows are judged by text, id and source; null and empty texts, repeated rows and empty tables are
handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from momentlake.llm import exact_dedup, jaccard_join, mixing, packing, quality
from momentlake.llm.common import boxed, documents, shared_table

#: Near duplicates: five words, similarity 0.8 or more.
NEAR = jaccard_join.Rule(gram=5, least=80, of=100)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts.  An empty or blank text is rejected or kept by the bias alone."""
    scored = quality.classify(boxed(docs, "doc_id", "text"), documents(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select("box.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, white space aside."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_per_component(docs, rule=NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mixed_rows(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

#: The classifier and the tokenizer have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), compact=False)
    return docs
