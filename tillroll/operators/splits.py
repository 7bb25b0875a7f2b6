"""Row-type masks and the split tables (MSK-*, AGG-1, AGG-16, SNK-2, JOI-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.masks import mask_columns
from ..sources.io import load_table, write_table


def add_masks(df: DataFrame, **codes) -> DataFrame:
    """MSK-1..11: eleven boolean columns, a pure projection (stays in codegen)."""
    return df.withColumns(mask_columns(**codes))


def mask_summary(df: DataFrame, masks=S.MASK_COLUMNS) -> DataFrame:
    """AGG-16: DF[mask, n] from a single aggregate, unpivoted."""
    totals = df.agg(*[F.count_if(m).alias(m) for m in masks])
    return totals.unpivot([], list(masks), "mask", "n")


def split_long(df: DataFrame, tables=S.SPLIT_TABLES) -> DataFrame:
    """SNK-2 long form: one output row per (row, split table it belongs to).

    Subsets overlap (a row can land in two tables) and do not cover the table,
    so this is an explode of the matching table names, computed in one pass.
    """
    names = F.array(*[F.when(F.col(mask), F.lit(name)) for name, mask in tables])
    return (df.withColumn("split", F.explode(F.filter(names, lambda x: x.isNotNull())))
              .select("split", *df.columns))


def split_counts(df: DataFrame, tables=S.SPLIT_TABLES) -> DataFrame:
    """AGG-1: row count per split table, without materializing the long form."""
    totals = df.agg(*[F.count_if(mask).alias(name) for name, mask in tables])
    return totals.unpivot([], [name for name, _ in tables], "split", "n")


def split_overlap(a: DataFrame, b: DataFrame, keys=("invoice_no", "stock_code")) -> DataFrame:
    """JOI-5: number of joined pairs between two split tables (many-to-many)."""
    left = a.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("na"))
    right = b.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("nb"))
    # Pre-aggregating both sides turns the pair count into a key join of counts,
    # so a hot key never materializes its cross product.
    return (left.join(right, list(keys))
                .agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).cast("long")
                     .alias("overlap_count")))


def write_splits(df: DataFrame, base_path: str, tables=S.SPLIT_TABLES, all_rows: str = S.ALL_ROWS_TABLE) -> None:
    """SNK-2: the full flagged table plus every subset, from one scan of ``df`` and in one write.

    The full table is one more value of ``split``. Rows are rebalanced by split
    before the write: a small subset ends in one file, a large one in files of
    the advisory partition size, and none in a file per input task."""
    every = split_long(df.withColumn("_all", F.lit(True)), (*tables, (all_rows, "_all"))).drop("_all")
    write_table(every.hint("rebalance", F.col("split")), base_path, partition_by=["split"])


def read_split(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """One table of ``write_splits``; only its files are read."""
    return load_table(spark, base_path).where(F.col("split") == name).drop("split")
