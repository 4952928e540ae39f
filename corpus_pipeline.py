"""The corpus pipeline: stages over the documents table, each on all its predecessor kept.

All stages take nulls in any column, repeated rows and doc_ids, columns of any name beside those of documents, and an
empty table, of which an empty one comes; what they do with each is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipwright.llm.exact_dedup import drop_exact_copies
from clipwright.llm.langid import keep_identified
from clipwright.llm.mixing import mixed_documents
from clipwright.llm.packing import pack
from clipwright.llm.shared import materialize
from clipwright.llm.simhash import drop_near_copies


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null texts, texts without letters and those foreign to every learned language go,
    as do all if no document has both a language and a text to learn from. Rows alike are judged alike."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id; null counts as the empty text, a null
    doc_id ranks last, and of rows alike in both one stays, chosen by a hash of all columns."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id (nulls last): five-word shingles,
    a Jaccard similarity of 0.8 or more, sought by SimHash. Texts without words are alike; rows are compared each by
    itself, also where they share a doc_id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the target weights take of each document, a row per pass over it; null and wordless texts, of which nothing
    can be taken, go. A null source is a source of its own; rows that repeat a doc_id are documents of their own."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 1024 tokens; a null text is empty, and rows are packed one by one."""
    return pack(docs)


STAGES = [("language id", identify_language), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mix sources", mix_sources), ("pack", pack_sequences)]

#: SQL can express neither the learned filters nor the packing; tests/llm/test_pipeline.py checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{k}")
    return docs
