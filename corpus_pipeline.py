"""The corpus pipeline: quality, near copies, contamination, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last adds each document's place in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquay.llm.decontaminate import clean_documents
from starquay.llm.jaccard_join import one_per_component
from starquay.llm.line_quality import score_quality
from starquay.llm.pfair_mix import mix_sources
from starquay.llm.secret_scan import mask_secrets
from starquay.files import delete
from starquay.staging import new_path, released

# Near copies: five-word shingles, Jaccard similarity of at least 0.8.
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    scored = score_quality(docs, _table(spark, sf_dir, "labels"), keep=True)
    return scored.where(F.col("predicted") == 1).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return one_per_component(docs, SHINGLE_WORDS, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their text."""
    return mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture of sources, with their place in it."""
    return mix_sources(docs).orderBy("mix_slot", "mix_place")


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixture", mixture),
]

# Trained models and similarity joins have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what each returns is written as Parquet and read again.

    Each stage works on the rows that its predecessor kept, with nulls, repeated rows and extra
    columns as they are; without documents all stages return none. What a stage staged,
    and the documents it read, are removed once its own are written, so at most two copies
    of the documents are held. The last one stays until ``staging.discard``.
    """
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = new_path(spark, f"pipeline_{name}")
        with released(spark):
            kept = step(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
