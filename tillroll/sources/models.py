"""Store of fitted models and other costly results, in the shared checkpoint folder.

A result is found again by a fingerprint of its training rows and parameters, so
a query that needs a model loads it whichever query fitted it, in whichever
session: the rows, not their order or partitions, decide. A pointer is written
only after the result itself, so an interrupted fit leaves nothing that is found.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .io import stage_path


def fingerprint(rows: DataFrame, **params) -> str:
    """Hex digest of the multiset of ``rows`` and of ``params``; column names and types count."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("mix")).first()
    text = json.dumps([one.n, str(one.total), one.mix, rows.schema.json(), params], sort_keys=True, default=str)
    return hashlib.md5(text.encode()).hexdigest()


def _pointer(spark: SparkSession, name: str, key: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{name}-{key}"


def stored(spark: SparkSession, name: str, key: str, save: Callable[[str], None]) -> str:
    """The folder of result ``name`` with fingerprint ``key``; ``save`` writes it to a fresh folder if there is none."""
    pointer = _pointer(spark, name, key)
    try:
        found = spark.read.schema("path string").parquet(pointer).first()
    except AnalysisException:
        found = None
    if found is not None:
        return found.path
    path = stage_path(spark, f"model-{name}")
    save(path)
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(pointer)
    return path


def stored_table(rows: DataFrame, name: str, key: str) -> DataFrame:
    """A table of the store: ``rows`` are computed only when it isn't there."""
    spark = rows.sparkSession
    path = stored(spark, name, key, lambda to: rows.write.parquet(to))
    return spark.read.schema(rows.schema).parquet(path)


def stored_pipeline(spark: SparkSession, name: str, key: str, fit: Callable[[], object]):
    """(fitted PipelineModel, its folder): MLlib's own persistence."""
    from pyspark.ml import PipelineModel
    path = stored(spark, name, key, lambda to: fit().write().save(to))
    return PipelineModel.load(path), path
