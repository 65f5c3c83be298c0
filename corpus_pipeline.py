"""From raw documents to packed sequences: each stage's table is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadmill.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from threadmill.llm.frames import read_table, written


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on this stage's labelled documents, doesn't reject."""
    return toxicity.keep_civil(docs, read_table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the document with the smallest id."""
    return exact_dedup.mark_copies(docs).where("kept").select(*[f"`{c}`" for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return near_dedup.near_classes(docs).where("kept").select(*[f"`{c}`" for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at target weights: a row per copy of a document, the last one cut where its block ends."""
    return mixing.take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences. A repeated document's pieces come once a copy."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", civil),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: The classifier, the signatures and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
