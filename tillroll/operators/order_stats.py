"""Exact order statistics without a task that holds a column (AGG-7, ASC-3, ML-11, TOP-2).

Equal values are counted first, so a hot value is one row. The counts are
range-partitioned by value; a row's rank is the sum of the counts before it in
its range plus the totals of earlier ranges, of which there is one row per
partition. Quantiles and top-n cuts are then lookups by rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialize


def running(counts: DataFrame, order: Sequence[Column], by: Sequence[str] = (), n: str = "n") -> DataFrame:
    """``counts`` with ``before``: the sum of ``n`` over the rows before it in ``order``, per value of ``by``.

    ``by`` and ``order`` together must tell the rows apart. NULLs in ``by`` are not allowed."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    ranged = (counts.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
              .withColumn("_part", F.spark_partition_id()))
    ranged = materialize(ranged, "ranked")
    here = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*by, "_part").agg(F.sum(n).alias("_sum"))  # a row per partition that holds the key
               .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum"))
    return (ranged.withColumn("_here", F.coalesce(F.sum(n).over(here), F.lit(0))).join(offsets, [*by, "_part"])
            .withColumn("before", F.col("_here") + F.col("_offset")).drop("_part", "_here", "_offset"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """DF[column, p, value]: linear quantiles of each column's values that are not NULL, exact.

    A column without a value gives no row."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(counts, [F.col("value")], ["column"])
    at = (F.col("total") - 1) * F.col("p")
    wanted = (ranked.groupBy("column").agg(F.sum("n").alias("total"))
              .select("column", "total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
              .select("column", "p", at.alias("at"), F.floor(at).alias("lo"), F.ceil(at).alias("hi")))
    end = F.col("before") + F.col("n")
    # a row per column and probability: bounded by the call
    hits = ranked.join(F.broadcast(wanted), "column").where((F.col("before") <= F.col("hi")) & (end > F.col("lo")))
    low = F.min(F.when((F.col("before") <= F.col("lo")) & (end > F.col("lo")), F.col("value")))
    high = F.max(F.when((F.col("before") <= F.col("hi")) & (end > F.col("hi")), F.col("value")))
    return (hits.groupBy("column", "p").agg(low.alias("_low"), high.alias("_high"), F.max(F.col("at") - F.col("lo")).alias("_share"))
            .select("column", "p", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("value")))


def first_rows(df: DataFrame, order: Sequence[str], n: int, lead: int = 2) -> DataFrame:
    """TOP-2: the first ``n`` rows in the total order of ``order`` (NULLs last).

    Rows per value of the ``lead`` first columns are counted; values that start
    within the first ``n`` rows are kept, which are at most ``n``, and only their
    rows are sorted: ``n`` and what the last value has beyond."""
    keys = list(order[:lead])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(counts, [F.col(k).asc_nulls_last() for k in keys], n="_n")
    kept = ranked.where(F.col("before") < n).select(*[F.col(k).alias(f"_lead_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_lead_{i}"))
    return df.join(F.broadcast(kept), same, "left_semi").orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
