"""Schemas, column names and the fixed values every operator defaults to."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the analysed workflow's own constants for the
# results to match. Every operator takes them as arguments with these defaults.
# ---------------------------------------------------------------------------
HOME_COUNTRY = "United Kingdom"
NOISE_WORDS = ("found", "lost", "damages", "check", "missing", "mixed", "damaged", "amazon", "adjustment")
SHIPPING_CODES = ("DOT", "POST", "C2")
MANUAL_CODE = "M"
OTHER_SPECIAL_CODES = ("BANK CHARGES", "ADJUST", "AMAZONFEE", "D", "S", "TEST001", "TEST002")
GIFT_TOKEN = "gift"
DCGS_TOKEN = "DCGS"
ADMIN_PREFIX = "A"
CANCEL_PREFIX = "C"
REASON_FILLED = "filled_missing_from_canonical_stockcode_description"
REASON_NOISE = "replaced_noise_with_canonical_stockcode_description"
REASON_VARIANT = "standardized_variant_to_canonical_stockcode_description"
INVOICE_PATTERN = r"^C?\d{6}$"
CUSTOMER_PATTERN = r"^\d{5}$"
STOCK_NUMERIC_PATTERN = r"^\d{5}$"
STOCK_SUFFIX_PATTERN = r"^\d{5}[A-Za-z]$"
STOCK_NORMAL_WIDE_PATTERN = r"^\d{5}([A-Za-z]{1,2})?$"
EXCLUDED_CUSTOMERS = (16446,)
RULE_MIN_SUPPORT = 0.01
RULE_MIN_CONFIDENCE = 0.20
RULE_MAX_LEN = 10
SPIKE_QUANTILE = 0.75
PEAK_QUANTILE = 0.67
TRAIN_SHARE = 0.8
REVIEW_CHANGED_ROWS = 20_000
FUZZY_CUTOFF = 0.5
TOP_RULES = 20
HOLDOUT_RULES = 50
RECOMMEND_TOP_N = 10
PCA_VARIANCE_TARGET = 0.85
KMEANS_KS = (3, 4, 5)
KMEANS_CHOSEN_K = 4
KMEANS_STARTS = 20
SPIKE_TREE_DEPTH = 5
SPIKE_TREE_MIN_SPLIT = 10
SPIKE_TREE_CP = 0.001
SPIKE_COST_NORMAL_AS_HIGH = 3.0
SPIKE_COST_HIGH_AS_NORMAL = 1.0
SPIKE_FOREST_TREES = 500
FOREST_DEPTH = 30  # the most that MLlib allows
BOOST_TREES = 1000
BOOST_RATE = 0.01
BOOST_SPLITS = 2
BOOST_FOLDS = 5
BOOST_CUTS = (0.5, 0.3)
BULK_FOREST_TREES = 100
BULK_FOREST_MTRY = 2
GAM_DF = 4
SPLINE_DFS = tuple(range(3, 12))
SPLINE_FOLDS = 5
# The ten subset tables written next to the full flagged table, keyed by mask.
SPLIT_TABLES = (
    ("clean_product_sales", "is_clean_product_sale_candidate"),
    ("manual_product_sales", "is_manual_product_like_sale"),
    ("cancellations", "is_cancellation_invoice"),
    ("admin_invoices", "is_admin_invoice"),
    ("inventory_adjustments", "is_inventory_adjustment"),
    ("free_items", "is_free_item"),
    ("gift_vouchers", "is_gift_voucher"),
    ("dcgs_rows", "is_dcgs"),
    ("shipping_fees", "is_shipping_fee"),
    ("other_special_rows", "is_other_special_code"),
)
# The full flagged table beside them.
ALL_ROWS_TABLE = "cleaned_retail_all"
MASK_COLUMNS = (
    "is_admin_invoice",
    "is_cancellation_invoice",
    "is_inventory_adjustment",
    "is_free_item",
    "is_gift_voucher",
    "is_dcgs",
    "is_shipping_fee",
    "is_manual",
    "is_manual_product_like_sale",
    "is_other_special_code",
    "is_clean_product_sale_candidate",
)
# Rows of the review summary, in their order.
REVIEW_METRICS = (
    "total_rows",
    "review_rows_saved",
    "unique_stock_codes_in_review",
    "changed_rows_requested",
    "rows_in_standardization_map",
    "rows_actually_changed",
    "missing_descriptions_after_standardization",
    "is_clean_product_sale_candidate",
    "is_cancellation_invoice",
    "is_admin_invoice",
    "is_inventory_adjustment",
    "is_free_item",
    "is_gift_voucher",
    "is_dcgs",
    "is_shipping_fee",
    "is_manual_product_like_sale",
    "is_other_special_code",
)
# Workbook header names of the raw extract.
SOURCE_COLUMNS = ("Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                  "Customer ID", "Country")
# ---------------------------------------------------------------------------

RAW_COLUMNS = ("invoice_no", "stock_code", "description", "quantity", "invoice_date", "price",
               "customer_id", "country")

RAW_SCHEMA = T.StructType([
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("customer_id", T.DoubleType()),
    T.StructField("country", T.StringType()),
])

SOURCE_SCHEMA = T.StructType([
    T.StructField(src, field.dataType) for src, field in zip(SOURCE_COLUMNS, RAW_SCHEMA.fields)
])

RULES_SCHEMA = T.StructType([
    T.StructField("LHS", T.StringType()),
    T.StructField("RHS", T.StringType()),
    T.StructField("support", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("lift", T.DoubleType()),
])
