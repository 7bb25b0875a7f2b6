"""From raw documents to packed training sequences: filter, dedup, mix, pack.

Each stage is written as Parquet and read again as the next one's documents.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tillroll.llm.common import stage, table

#: Documents scored at or above it go.
TOXIC = 0.7
#: Target weight of a source: its number of documents to this power (1 keeps the corpus's shares, 0 makes all equal).
MIX_POWER = 0.7
SEQUENCE, END_ID = 1024, 2


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the n-gram classifier rejects; NULL texts count as empty and stay."""
    return toxicity.keep_rows(docs, table(spark, sf_dir, "labels"), TOXIC)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest doc_id."""
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each class at 0.8 on five-word shingles."""
    return near_dedup.keep_rows(docs, words=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; once a source has run out, the others go on by their weights."""
    return mixing.mixed_rows(docs, power=MIX_POWER, whole=True)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence and place; sequences follow the order in which the mix wrote its documents."""
    import public_tokenizers
    written = {"mix_file": F.col("_metadata.file_name"), "mix_row": F.col("_metadata.row_index")}
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, END_ID, order=written)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: A trained classifier, estimated similarities and a packing search have no SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
