"""Readers and writers (SRC-1, SRC-2, SRC-4, SNK-1, SNK-3) and stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import ensure_checkpoint_dir


def read_raw(spark: SparkSession, paths: Iterable[str], schema=S.SOURCE_SCHEMA, fmt: str = "parquet",
             **options) -> DataFrame:
    """SRC-1: read N same-shaped extracts with a fixed schema and stack them in
    order (``extract`` = position of its source, so the original order can be
    restored by (extract, ...))."""
    frames = []
    for i, p in enumerate(paths):
        reader = spark.read.schema(schema).options(**options)
        df = reader.csv(p, header=True) if fmt == "csv" else reader.format(fmt).load(p)
        frames.append(df.withColumn("extract", F.lit(i)))
    if not frames:
        raise ValueError("no input paths")
    return reduce(lambda a, b: a.unionByName(b), frames)


def load_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """SRC-2 / SRC-3: full scan of a stored table; optional column pruning."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] | None = None) -> None:
    """SNK-1: overwrite-write a table as Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """SNK-3: rules sorted by lift as CSV with LHS,RHS,support,confidence,lift.

    A global sort writes ordered part files (range partitioning, no single task).
    """
    (rules.select("LHS", "RHS", "support", "confidence", "lift")
          .orderBy(F.col("lift").desc(), "LHS", "RHS")
          .write.mode("overwrite").option("header", True).csv(path))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: read an exported rules CSV with a fixed schema; fail when missing."""
    from pyspark.errors import AnalysisException
    try:
        df = spark.read.schema(S.RULES_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)
        df.limit(1).collect()  # surface a missing path now, as the analysis does
    except AnalysisException as exc:
        raise FileNotFoundError(f"rules not found: {path}") from exc
    return df.withColumn("antecedent", F.split("LHS", ","))


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stage table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stages/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared checkpoint folder and
    read it back: cuts the lineage (a lost executor re-reads files instead of
    recomputing joins) and later filters and projections prune at the scan."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
