"""Training-corpus pipeline: quality, near-duplicates, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. A stage works on all rows that the
one before it kept:

1. quality rules and boosted trees; rejected documents go;
2. ProbMinHash near-duplicates; one document of each group stays;
3. personal data is masked in the texts;
4. sources are mixed to their target weights; a document taken twice is there twice;
5. the documents' token ids are packed into sequences (one row per piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import minhash, mixing, packing, pii, quality
from shoplens.llm.common import save, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the trees, signatures or tokens; tests/llm/test_llm_pipeline.py
#: holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
