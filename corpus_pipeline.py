"""Pipeline from raw documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm.common import importable, table
from panelwright.llm.jaccard import keep_one
from panelwright.llm.mixing import repeat_documents
from panelwright.llm.packing import pack_documents
from panelwright.llm.pii import redact
from panelwright.llm.repetition import keep_good
from panelwright.llm.tokens import default_vocabulary
from panelwright.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    importable(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    importable(spark)
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return repeat_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix holds, cut and packed into sequences of 4096 ids; one row per piece."""
    importable(spark)
    return pack_documents(docs, default_vocabulary(), capacity=4096, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mixed),
    ("packing", packed),
]

#: The stages use learned models, hashes and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; every stage's result is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
