"""Gapless positions without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def positions(rows: DataFrame, group: list[str], bucket, order: list, out: str) -> DataFrame:
    """``rows`` (cheap to read twice) with ``out``: the position from 0 within
    ``group``, by ``bucket`` and then ``order``. A window sees one bucket; the
    counts of buckets, a few thousandths of the rows, give its offset."""
    rows = rows.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    here = Window.partitionBy(*keys).orderBy(*order)
    return (rows.withColumn("_row", F.row_number().over(here)).join(offsets, keys)
            .withColumn(out, F.col("_offset") + F.col("_row") - 1).drop("_bucket", "_row", "_offset"))
