"""Corpus pipeline: five stages over the documents table.

Each stage works on all rows that its predecessor kept and its decisions
take effect; all but the last return the columns of documents.  Stages are
written as Parquet and read again, so each starts with a short lineage.

1. quality: rows that the quality classifier rejects go;
2. near_duplicates: of each group of linked documents the row with the
   smallest doc_id stays (rows without words link with nothing and all stay);
3. decontaminate: rows that hold a benchmark item go;
4. pii: entities and disclosing terms are replaced in the texts;
5. mix: every row gets its source's weight and its draws in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, jaccard, mixing, pii, quality
from tidemark.llm.common import materialise, read

ORACLE_SQL = None  # learned models and real-valued weights: tested against brute force instead


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.sanitise(docs)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
