"""Review sample and its summary (SNK-4, WIN-5, TOP-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .order_stats import first_rows

REVIEW_KEYS = ("stock_code", "invoice_date", "invoice_no")


def review_columns(df: DataFrame, keys=REVIEW_KEYS) -> list[str]:
    """Total order: the review keys, then every other raw column."""
    return [*keys, *[c for c in S.RAW_COLUMNS if c not in keys and c in df.columns]]


def review_order(df: DataFrame, keys=REVIEW_KEYS) -> list:
    """The total order, nulls last."""
    return [F.col(c).asc_nulls_last() for c in review_columns(df, keys)]


def first_per_code(df: DataFrame, keys=REVIEW_KEYS) -> DataFrame:
    """WIN-5: first row per stock_code (NULL code is its own group).

    The least second key per code is a hash aggregate over two columns; only the
    rows that hold it go on, whole, to ``min_by(row, struct(sort keys))``. Both
    combine map-side, so a stock code with a third of all rows is no hot task and
    the full-width rows of the table are never sorted.
    """
    first = df.groupBy(F.col("stock_code").alias("_code")).agg(F.min(keys[1]).alias("_first"))
    df = df.join(first, F.col("stock_code").eqNullSafe(F.col("_code"))
                 & F.col(keys[1]).eqNullSafe(F.col("_first")), "left_semi")
    rest = [c for c in S.RAW_COLUMNS if c not in keys and c in df.columns]
    sort_fields = []
    for c in (*keys, *rest):
        sort_fields += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(f"_k_{c}")]
    return (df.groupBy("stock_code")
              .agg(F.min_by(F.struct(*df.columns), F.struct(*sort_fields)).alias("_row"))
              .select("_row.*"))


def changed_rows(df: DataFrame, n: int = S.REVIEW_CHANGED_ROWS) -> DataFrame:
    """TOP-2: the first n rows whose description changed, in the total order."""
    return first_rows(df.where(F.col("description_standardized")), review_columns(df), n)


def review_sample(df: DataFrame, n: int = S.REVIEW_CHANGED_ROWS) -> DataFrame:
    """SNK-4: one row per code UNION first n changed rows, de-duplicated, sorted."""
    return (first_per_code(df).unionByName(changed_rows(df, n))
            .distinct().orderBy(*review_order(df)))


def review_metrics(df: DataFrame, review: DataFrame, n: int = S.REVIEW_CHANGED_ROWS) -> DataFrame:
    """SNK-4 summary: 17 metric/value rows from two one-row aggregates."""
    full = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("description_in_standardization_map").alias("rows_in_standardization_map"),
        F.count_if("description_standardized").alias("rows_actually_changed"),
        F.count_if(F.col("description").isNull()).alias("missing_descriptions_after_standardization"),
        *[F.count_if(m).alias(m) for m in (
            "is_clean_product_sale_candidate", "is_cancellation_invoice", "is_admin_invoice",
            "is_inventory_adjustment", "is_free_item", "is_gift_voucher", "is_dcgs",
            "is_shipping_fee", "is_manual_product_like_sale", "is_other_special_code")],
    )
    rev = review.agg(
        F.count(F.lit(1)).alias("review_rows_saved"),
        # distinct codes counting NULL as one value
        (F.countDistinct("stock_code") + F.max(F.col("stock_code").isNull().cast("int")))
        .cast("long").alias("unique_stock_codes_in_review"),
    )
    def long(one_row: DataFrame) -> DataFrame:
        cols = one_row.columns
        return (one_row.select(*[F.col(c).cast("long").alias(c) for c in cols])
                       .unpivot([], cols, "metric", "value"))

    requested = df.sparkSession.range(1).select(F.lit(n).cast("long").alias("changed_rows_requested"))
    stacked = long(full).unionByName(long(rev)).unionByName(long(requested))
    order = F.array_position(F.array(*[F.lit(x) for x in S.REVIEW_METRICS]), F.col("metric"))
    return stacked.orderBy(order)
