"""A corpus pipeline of the operators in quillspark.llm: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, knn_quality, packing, secrets, simhash
from quillspark.llm.common import fresh, scored, table, written
from quillspark.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.3) go.

    Null and blank texts score the labelled sample's share of good ones; repeated rows score alike; an empty table stays empty.
    """
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_quality")[0]
    return scored(docs, score, model).where(F.col(score) >= 0.3).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest doc_id, of repeated rows one.

    Null and blank texts are one group; a null doc_id comes after all others; an empty table stays empty.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go; null and blank texts stay, repeated rows are judged alike."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every row stays, null texts as they are."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into training sequences: a row a piece, null and empty texts as the end id alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: Fingerprints, trained classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
