"""Corpus clean-up: raw documents to packed training sequences.

Stages take (spark, docs, sf_dir) and return a DataFrame. Each is written as Parquet and
read again as the next one's ``docs``; all but the last keep the columns of documents.

* toxicity: a document that the classifier rejects goes (labels of the folds it may learn from).
* near_duplicates: of each group of linked documents the one with the smallest id stays.
* decontamination: a document that holds a window of a benchmark item goes.
* personal_data: spans of personal data are replaced by their kind.
* packing: what is left becomes pieces of fixed-length sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blogscope.llm import decontaminate, jaccard, packing, pii, toxicity
from blogscope.llm.common import fold, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels, fold(3) == 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit_tagger(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# Models and packing are not expressible in SQL; tests/llm hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
