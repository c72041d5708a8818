"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import mixing, packing, pii, quality, simhash
from orderloom.llm.common import free_name, staged, table
from orderloom.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from their labels, doesn't reject."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "score_")
    return quality.scored(docs, model, name).where(F.col(name) >= quality.CUTOFF).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Marks in place of personal data."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in packed sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact),
    ("mixing", mix),
    ("packing", pack),
]

# No SQL has the tokenizer or the learnt scores; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
