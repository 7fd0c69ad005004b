"""A training corpus from raw documents, one operator per stage.

language ID (rejected documents go) -> near duplicates (one row of each group
stays) -> benchmark decontamination (rows that hold a test item go) -> secret scan
(secrets are replaced) -> packing.  Near duplicates and leaks are decided by row,
not by doc_id.  Each stage is written as Parquet to the shared folder and read
again, so that a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm.common import read, stored
from tallycast.llm.decontaminate import rows_without_items
from tallycast.llm.jaccard_join import one_of_each_group
from tallycast.llm.lang_id import without_rejected
from tallycast.llm.packing import pack
from tallycast.llm.secret_scan import redacted


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rows_without_items(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Language models and tokenizers have no SQL form; tests/llm compares near duplicates with plain Python, the other stages with their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the packed pieces."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
