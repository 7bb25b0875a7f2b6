"""Queries for stage A: raw lines -> cleaned, flagged and split tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import clean, review, splits
from ..sources import fixtures
from ..sources.io import load_table, stage_path
from . import oracle as O
from .catalog import register
from .stages import cleaned, raw_lines

_RAW = ", ".join(S.RAW_COLUMNS)
_CLEAN_ORDER = ("stock_code NULLS LAST, invoice_date NULLS LAST, invoice_no NULLS LAST, "
                "description NULLS LAST, quantity NULLS LAST, price NULLS LAST, "
                "customer_id NULLS LAST, country NULLS LAST")


@register("raw_lines", O.sql(f"SELECT {_RAW} FROM raw", "raw"), ids=("SRC-1", "SRC-2"))
def q_raw_lines(spark, sf):
    return raw_lines(spark, sf)


@register("rename_source", O.sql(
    "SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, description AS Description, "
    "quantity AS Quantity, invoice_date AS InvoiceDate, price AS Price, customer_id AS CustomerID, "
    "country AS Country FROM raw", "raw"), ids=("PRJ-1",))
def q_rename_source(spark, sf):
    return clean.rename_source(fixtures.source_lines(spark, sf))


@register("normalize_columns", O.sql(f"SELECT {_RAW} FROM raw", "raw"), ids=("PRJ-2", "PRJ-3"))
def q_normalize_columns(spark, sf):
    # workbook names -> snake_case; lower_columns is then the identity
    return clean.lower_columns(clean.normalize_columns(fixtures.source_lines(spark, sf)))


@register("normalize_description", O.sql(f"SELECT {_RAW} FROM trimmed", "trimmed"), ids=("STR-1",))
def q_normalize_description(spark, sf):
    return clean.normalize_description(raw_lines(spark, sf))


@register("fill_unique_description", O.sql(
    f"SELECT {_RAW}, description_filled FROM filled", "filled"), ids=("JOI-1", "JOI-2", "WIN-6"))
def q_fill_unique_description(spark, sf):
    return clean.fill_unique_description(clean.normalize_description(raw_lines(spark, sf)))


@register("is_noise_description", O.sql(
    "SELECT description, is_noise_description, count(*) AS n FROM noised GROUP BY ALL", "noised"),
    ids=("MSK-12",))
def q_is_noise(spark, sf):
    filled = clean.fill_unique_description(clean.normalize_description(raw_lines(spark, sf)))
    from ..functions.text import is_noise
    return (filled.withColumn("is_noise_description", is_noise("description"))
                  .groupBy("description", "is_noise_description").agg(F.count(F.lit(1)).alias("n")))


@register("canonical_map", O.sql(
    "SELECT stock_code, canonical_description, description_count, num_valid_descriptions FROM canon_map",
    "canon_map"), ids=("JOI-3", "WIN-4"))
def q_canonical_map(spark, sf):
    filled = clean.fill_unique_description(clean.normalize_description(raw_lines(spark, sf)))
    return clean.canonical_map(filled)


@register("standardize_description", O.sql(
    f"SELECT {_RAW}, description_filled, is_noise_description, description_original, canonical_description, "
    "description_in_standardization_map, description_standardized, description_standardization_reason "
    "FROM described", "described"), ids=("JOI-4",))
def q_standardize(spark, sf):
    filled = clean.fill_unique_description(clean.normalize_description(raw_lines(spark, sf)))
    return clean.standardize_description(filled, clean.canonical_map(filled))


@register("cleaned_all", O.sql("SELECT * FROM cleaned", "cleaned"),
          ids=("SRC-2", "MSK-1", "MSK-2", "MSK-3", "MSK-4", "MSK-5", "MSK-6", "MSK-7", "MSK-8",
               "MSK-9", "MSK-10", "MSK-11"))
def q_cleaned_all(spark, sf):
    return cleaned(spark, sf)


@register("standardization_audit", O.sql(f"""
SELECT count_if(description_in_standardization_map) AS rows_in_standardization_map,
       count_if(description_standardized) AS rows_actually_changed,
       count_if(description_original IS NULL) AS missing_before_apply,
       count_if(description IS NULL) AS missing_after_apply,
       count_if(description_filled) AS filled_by_unique_description,
       count_if(description_standardization_reason = {O.q(S.REASON_FILLED)}) AS missing_filled,
       count_if(description_standardization_reason = {O.q(S.REASON_NOISE)}) AS noise_replaced,
       count_if(description_standardization_reason = {O.q(S.REASON_VARIANT)}) AS variants_standardized
FROM cleaned""", "cleaned"), ids=("AGG-15",))
def q_audit(spark, sf):
    return clean.standardization_audit(cleaned(spark, sf))


@register("mask_summary", O.sql(
    "SELECT mask, n FROM (" + " UNION ALL ".join(
        f"SELECT {O.q(m)} AS mask, count_if({m}) AS n FROM cleaned" for m in S.MASK_COLUMNS) + ")",
    "cleaned"), ids=("AGG-16",))
def q_mask_summary(spark, sf):
    return splits.mask_summary(cleaned(spark, sf))


@register("split_counts", O.sql(
    "SELECT split, n FROM (" + " UNION ALL ".join(
        f"SELECT {O.q(t)} AS split, count_if({m}) AS n FROM cleaned" for t, m in S.SPLIT_TABLES) + ")",
    "cleaned"), ids=("AGG-1",))
def q_split_counts(spark, sf):
    return splits.split_counts(cleaned(spark, sf))


@register("split_long", O.sql(
    " UNION ALL ".join(f"SELECT {O.q(t)} AS split, * FROM cleaned WHERE {m}" for t, m in S.SPLIT_TABLES),
    "cleaned"), ids=("SNK-2",))
def q_split_long(spark, sf):
    return splits.split_long(cleaned(spark, sf))


@register("split_tables", O.sql(
    "SELECT split, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(price) AS DECIMAL(38,2)) AS price, "
    "count(DISTINCT invoice_no) AS invoices FROM ("
    + " UNION ALL ".join(f"SELECT {O.q(t)} AS split, * FROM cleaned WHERE {m}" for t, m in S.SPLIT_TABLES)
    + f" UNION ALL SELECT {O.q(S.ALL_ROWS_TABLE)}, * FROM cleaned) t GROUP BY split", "cleaned"), ids=("SNK-1", "SNK-2", "SRC-2"))
def q_split_tables(spark, sf):
    """Write the full table and its subsets into the shared folder in one pass, and add up what is read back."""
    path = stage_path(spark, "split_tables")
    splits.write_splits(cleaned(spark, sf), path)
    return load_table(spark, path, ("split", "quantity", "price", "invoice_no")).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"), F.sum("price").cast("decimal(38,2)").alias("price"),
        F.countDistinct("invoice_no").alias("invoices"))


@register("split_overlap", O.sql("""
SELECT count(*) AS overlap_count
FROM (SELECT * FROM cleaned WHERE is_clean_product_sale_candidate) cps
JOIN (SELECT * FROM cleaned WHERE is_manual_product_like_sale) mps
  ON cps.invoice_no = mps.invoice_no AND cps.stock_code = mps.stock_code""", "cleaned"), ids=("JOI-5",))
def q_split_overlap(spark, sf):
    df = cleaned(spark, sf)
    return splits.split_overlap(df.where("is_clean_product_sale_candidate"),
                                df.where("is_manual_product_like_sale"))


@register("review_sample", O.sql(f"""
SELECT DISTINCT * FROM (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY {_CLEAN_ORDER}) AS rn FROM cleaned) a
  WHERE rn = 1
  UNION ALL
  SELECT * FROM (SELECT * FROM cleaned WHERE description_standardized
                 ORDER BY {_CLEAN_ORDER} LIMIT {S.REVIEW_CHANGED_ROWS}) b
) u""", "cleaned"), ids=("SNK-4", "WIN-5", "TOP-2", "SET-1", "SET-3"))
def q_review_sample(spark, sf):
    return review.review_sample(cleaned(spark, sf))


_REVIEW_CTE = {"review": f"""
SELECT DISTINCT * FROM (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY {_CLEAN_ORDER}) AS rn FROM cleaned) a
  WHERE rn = 1
  UNION ALL
  SELECT * FROM (SELECT * FROM cleaned WHERE description_standardized
                 ORDER BY {_CLEAN_ORDER} LIMIT {S.REVIEW_CHANGED_ROWS}) b
) u"""}


@register("review_metrics", O.sql("""
SELECT metric, value FROM (
  SELECT 'total_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM cleaned
  UNION ALL SELECT 'review_rows_saved', count(*) FROM review
  UNION ALL SELECT 'unique_stock_codes_in_review', count(DISTINCT stock_code)
             + max(CASE WHEN stock_code IS NULL THEN 1 ELSE 0 END) FROM review
  UNION ALL SELECT 'changed_rows_requested', """ + str(S.REVIEW_CHANGED_ROWS) + """
  UNION ALL SELECT 'rows_in_standardization_map', count_if(description_in_standardization_map) FROM cleaned
  UNION ALL SELECT 'rows_actually_changed', count_if(description_standardized) FROM cleaned
  UNION ALL SELECT 'missing_descriptions_after_standardization', count_if(description IS NULL) FROM cleaned
""" + "".join(f"  UNION ALL SELECT {O.q(m)}, count_if({m}) FROM cleaned\n" for m in (
    "is_clean_product_sale_candidate", "is_cancellation_invoice", "is_admin_invoice",
    "is_inventory_adjustment", "is_free_item", "is_gift_voucher", "is_dcgs", "is_shipping_fee",
    "is_manual_product_like_sale", "is_other_special_code")) + ") t", "cleaned", extra=_REVIEW_CTE),
    ids=("SNK-4",))
def q_review_metrics(spark, sf):
    df = cleaned(spark, sf)
    return review.review_metrics(df, review.review_sample(df))


@register("top_products_by_revenue", O.sql("""
SELECT description, CAST(sum(price * quantity) AS DECIMAL(38,2)) AS revenue, count(*) AS lines
FROM cleaned WHERE is_clean_product_sale_candidate
GROUP BY description
ORDER BY revenue DESC, description ASC NULLS LAST
LIMIT 10""", "cleaned"), ids=("TOP-1", "NUM-2"))
def q_top_products(spark, sf):
    return top_products_by_revenue(cleaned(spark, sf))


def top_products_by_revenue(flagged, n: int = 10):
    """Flagship slice: clean sales -> revenue per description -> top n."""
    return (flagged.where("is_clean_product_sale_candidate")
                   .groupBy("description")
                   .agg(F.sum(F.col("price") * F.col("quantity")).cast("decimal(38,2)").alias("revenue"),
                        F.count(F.lit(1)).alias("lines"))
                   .orderBy(F.col("revenue").desc(), F.col("description").asc_nulls_last())
                   .limit(n))
