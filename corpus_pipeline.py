"""A training corpus from documents: language ID, near duplicates, repeated passages, benchmarks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.llm.contamination import find_passages
from sonalyze.llm.jaccard import similar_groups
from sonalyze.llm.langid import document_rows, identify, train
from sonalyze.llm.packing import pack
from sonalyze.llm.queries import BYTE_BPE, MIXTURE_ALPHA
from sonalyze.llm.shared import discard, ship, stored
from sonalyze.llm.substrings import dedup_substrings

#: No SQL expresses the stages; tests hold them against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go. A row without doc_id stays."""
    ship(spark)
    found = identify(document_rows(docs), train(docs))
    return docs.join(found.where("rejected").select(F.col("id").alias("doc_id")), "doc_id", "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group stays. A row without doc_id stays."""
    ship(spark)
    found = similar_groups(docs)
    return docs.join(found.where("doc_id <> component_id OR component_id IS NULL").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more stay where they are first; a text that loses none stays as it is."""
    ship(spark)
    kept = dedup_substrings(docs, rejoin=False)
    return kept.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go. A row without doc_id stays."""
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens, the sources in proportion to the 0.7th power of their
    tokens. A null text is its end alone, a null source a source of its own; repeated rows are packed each."""
    ship(spark)
    return pack(docs, BYTE_BPE, alpha=MIXTURE_ALPHA)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again; what a stage has read is removed. Rows
    without doc_id are judged by their text where a stage can, and else stay; rows that repeat a doc_id stay or go
    together; columns beyond those of documents are passed on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
