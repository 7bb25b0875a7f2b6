"""Queries for the validation report and split-decision EDA on the raw lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import invoice_prefix
from ..operators import profile as P
from . import oracle as O
from .catalog import register
from .stages import raw_lines

CTE = O.CTES
CTE["eda"] = (f"SELECT * REPLACE ({O.strip('CAST(stock_code AS VARCHAR)')} AS stock_code) FROM raw", ("raw",))
_num = f"COALESCE(regexp_matches(CAST(stock_code AS VARCHAR), {O.q(S.STOCK_NUMERIC_PATTERN)}), false)"
_suf = f"COALESCE(regexp_matches(CAST(stock_code AS VARCHAR), {O.q(S.STOCK_SUFFIX_PATTERN)}), false)"
_wide_special = f"NOT COALESCE(regexp_matches(stock_code, {O.q(S.STOCK_NORMAL_WIDE_PATTERN)}), false)"
_dcgs = O.icontains("stock_code", S.DCGS_TOKEN)
_gift = O.icontains("stock_code", S.GIFT_TOKEN)
CTE["special_raw"] = (f"SELECT * FROM raw WHERE NOT ({_num} OR {_suf})", ("raw",))
CTE["other_special"] = (f"SELECT * FROM eda WHERE {_wide_special} AND NOT {_dcgs} AND NOT {_gift}", ("eda",))
_RAW = ", ".join(S.RAW_COLUMNS)


def _bucket(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN '< 0' WHEN {c} = 0 THEN '= 0' WHEN {c} > 0 THEN '> 0' END"


@register("validate_invoice", O.sql(f"""
SELECT count_if(v) AS valid_count, count_if(NOT v) AS invalid_count,
       count_if(NOT v) / count(*) AS invalid_rate,
       count(DISTINCT CASE WHEN NOT v THEN stock_code END) AS invalid_unique_stock_codes,
       count(DISTINCT CASE WHEN NOT v THEN country END) AS invalid_unique_countries,
       count(DISTINCT CASE WHEN NOT v THEN customer_id END) AS invalid_unique_customers
FROM (SELECT *, COALESCE(regexp_matches(invoice_no, {O.q(S.INVOICE_PATTERN)}), false) AS v FROM raw) t""",
    "raw"), ids=("VAL-1", "STR-7"))
def q_validate_invoice(spark, sf):
    return P.validate_invoice(raw_lines(spark, sf))


@register("invalid_invoice_rows", O.sql(
    f"SELECT {_RAW} FROM raw WHERE NOT COALESCE(regexp_matches(invoice_no, {O.q(S.INVOICE_PATTERN)}), false)",
    "raw"), ids=("VAL-1",))
def q_invalid_rows(spark, sf):
    return P.invalid_rows(raw_lines(spark, sf))


@register("validate_customer", O.sql(f"""
SELECT count_if(customer_id IS NULL) AS missing_count,
       count_if(customer_id IS NULL) / count(*) AS missing_rate,
       count_if(customer_id IS NOT NULL AND ok) AS valid_count,
       count_if(customer_id IS NOT NULL AND NOT ok) AS invalid_count
FROM (SELECT *, COALESCE(regexp_matches(CAST(TRY_CAST(customer_id AS BIGINT) AS VARCHAR),
                                        {O.q(S.CUSTOMER_PATTERN)}), false) AS ok FROM raw) t""", "raw"),
    ids=("VAL-2", "STR-2"))
def q_validate_customer(spark, sf):
    return P.validate_customer(raw_lines(spark, sf))


@register("validate_amounts", O.sql("""
SELECT count_if(TRY_CAST(CAST(quantity AS VARCHAR) AS DOUBLE) IS NULL) AS quantity_non_numeric,
       count_if(TRY_CAST(CAST(price AS VARCHAR) AS DOUBLE) IS NULL) AS price_non_numeric,
       count_if(quantity < 0) AS quantity_neg, count_if(quantity = 0) AS quantity_zero,
       count_if(quantity > 0) AS quantity_pos,
       count_if(price < 0) AS price_neg, count_if(price = 0) AS price_zero, count_if(price > 0) AS price_pos
FROM raw""", "raw"), ids=("VAL-3", "NUM-1"))
def q_validate_amounts(spark, sf):
    return P.validate_amounts(raw_lines(spark, sf))


@register("date_profile", O.sql("""
SELECT count(p) AS valid_dates, count_if(p IS NULL) AS invalid_dates,
       count_if(p IS NULL) / count(*) AS invalid_rate, min(p) AS min_date, max(p) AS max_date
FROM (SELECT TRY_CAST(CAST(invoice_date AS VARCHAR) AS TIMESTAMP) AS p FROM raw) t""", "raw"),
    ids=("DAT-1",))
def q_date_profile(spark, sf):
    return P.date_profile(raw_lines(spark, sf))


@register("stock_code_profile", O.sql(f"""
SELECT count_if(n) AS numeric_count, count_if(NOT n) AS non_numeric_count,
       count_if(NOT n) / count(*) AS non_numeric_rate,
       count(DISTINCT stock_code) AS unique_codes,
       count(DISTINCT CASE WHEN NOT n THEN stock_code END) AS unique_non_numeric,
       count_if(NOT (n OR s)) AS special_count,
       count(DISTINCT CASE WHEN NOT (n OR s) THEN stock_code END) AS unique_special
FROM (SELECT *, {_num} AS n, {_suf} AS s FROM raw) t""", "raw"), ids=("VAL-4",))
def q_stock_code_profile(spark, sf):
    return P.stock_code_profile(raw_lines(spark, sf))


@register("desc_per_code", O.sql("""
SELECT stock_code, count(DISTINCT description) AS n_descriptions
FROM raw WHERE stock_code IS NOT NULL GROUP BY stock_code""", "raw"), ids=("AGG-2",))
def q_desc_per_code(spark, sf):
    return P.desc_per_code(raw_lines(spark, sf))


@register("ambiguous_codes", O.sql("""
SELECT count_if(n > 1) AS ambiguous_codes FROM (
  SELECT stock_code, count(DISTINCT description) AS n FROM raw WHERE stock_code IS NOT NULL GROUP BY 1) t""",
    "raw"), ids=("AGG-2",))
def q_ambiguous_codes(spark, sf):
    return P.ambiguous_codes(raw_lines(spark, sf))


@register("special_code_stats", O.sql("""
SELECT stock_code, count(DISTINCT description) AS n_descriptions, min(price) AS min_price,
       max(price) AS max_price, CAST(sum(price) AS DOUBLE) / count(price) AS mean_price,
       round_even(count_if(customer_id IS NULL) / count(*), 3) AS missing_customer_share
FROM special_raw GROUP BY stock_code""", "special_raw"), ids=("AGG-3", "AGG-4", "UDF-1"))
def q_special_code_stats(spark, sf):
    return P.special_code_stats(raw_lines(spark, sf))


def _value_counts_sql(expr: str, source: str, n: int | None, where: str = "TRUE") -> str:
    lim = f" LIMIT {n}" if n else ""
    return (f"SELECT value, count(*) AS n FROM (SELECT {expr} AS value FROM {source} WHERE {where}) t "
            f"WHERE value IS NOT NULL GROUP BY value ORDER BY n DESC, value ASC{lim}")


@register("top_special_codes", O.sql(_value_counts_sql("stock_code", "special_raw", 20), "special_raw"),
          ids=("AGG-5", "VAL-4"))
def q_top_special_codes(spark, sf):
    return P.value_counts(P.special_rows(raw_lines(spark, sf)), "stock_code", 20)


@register("special_invoice_prefix", O.sql(
    _value_counts_sql("NULLIF(substr(CAST(invoice_no AS VARCHAR), 1, 1), '')", "special_raw", None), "special_raw"),
    ids=("STR-3", "AGG-5"))
def q_special_invoice_prefix(spark, sf):
    return P.value_counts(P.special_rows(raw_lines(spark, sf)), invoice_prefix("invoice_no"))


@register("country_profile", O.sql(f"""
SELECT count_if(country IS NULL) AS missing_country,
       count_if({O.strip('CAST(country AS VARCHAR)')} = '') AS blank_country,
       count_if({O.strip('CAST(country AS VARCHAR)')} = 'Unspecified') AS unspecified_country,
       count_if({O.strip('CAST(country AS VARCHAR)')} = 'Unspecified') / count(*) AS unspecified_share,
       count(DISTINCT country) AS unique_countries
FROM raw""", "raw"), ids=("VAL-6",))
def q_country_profile(spark, sf):
    return P.country_profile(raw_lines(spark, sf))


@register("top_countries", O.sql(_value_counts_sql("country", "raw", 20), "raw"), ids=("VAL-6", "AGG-5"))
def q_top_countries(spark, sf):
    return P.value_counts(raw_lines(spark, sf), "country", 20)


@register("country_list", O.sql(
    f"SELECT DISTINCT {O.strip('CAST(country AS VARCHAR)')} AS country FROM raw WHERE country IS NOT NULL "
    "ORDER BY country", "raw"), ids=("VAL-6", "SET-3", "TOP-4", "STR-6"))
def q_country_list(spark, sf):
    return P.country_list(raw_lines(spark, sf))


@register("missing_profile", O.sql("""
SELECT count_if(description IS NULL) AS missing_count, count_if(description IS NULL) / count(*) AS missing_share
FROM raw""", "raw"), ids=("VAL-7",))
def q_missing_profile(spark, sf):
    return P.missing_profile(raw_lines(spark, sf))


@register("shape_profile", O.sql(f"SELECT count(*) AS n_rows, CAST({len(S.RAW_COLUMNS)} AS BIGINT) AS n_columns FROM raw",
                                 "raw"), ids=("VAL-8",))
def q_shape_profile(spark, sf):
    return P.shape_profile(raw_lines(spark, sf))


@register("split_candidates", O.sql(f"""
SELECT count_if(r) AS returns, count_if(r) / count(*) AS returns_share,
       count_if(f) AS free, count_if(f) / count(*) AS free_share,
       count_if(a) AS admin, count_if(a) / count(*) AS admin_share,
       count_if(r AND f) AS return_and_free, count_if(r AND a) AS return_and_admin,
       count_if(f AND a) AS free_and_admin
FROM (SELECT COALESCE(quantity < 0, false) AS r, COALESCE(price = 0, false) AS f,
             {O.starts('invoice_no', 'A')} AS a FROM raw) t""", "raw"), ids=("FLT-1", "STR-4"))
def q_split_candidates(spark, sf):
    return P.split_candidates(raw_lines(spark, sf))


def _xt(name: str, a: str, b: str) -> str:
    return (f"SELECT '{name}' AS \"table\", CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS n "
            f"FROM eda GROUP BY ALL")


_prefix = "NULLIF(substr(CAST(invoice_no AS VARCHAR), 1, 1), '')"
_ret = "(quantity < 0)"
_free = "(price = 0)"


def _bool_text(expr: str) -> str:
    return f"CASE WHEN {expr} THEN 'true' WHEN NOT {expr} THEN 'false' END"


@register("eda_crosstabs", O.sql(" UNION ALL ".join([
    _xt("prefix_x_return", _prefix, _bool_text(_ret)),
    _xt("prefix_x_free", _prefix, _bool_text(_free)),
    _xt("special_x_return", _bool_text(f"({_wide_special})"), _bool_text(_ret)),
    _xt("special_x_free", _bool_text(f"({_wide_special})"), _bool_text(_free)),
    _xt("prefix_x_special", _prefix, _bool_text(f"({_wide_special})")),
]), "eda"), ids=("AGG-6", "VAL-5", "STR-3"))
def q_eda_crosstabs(spark, sf):
    return P.eda_crosstabs(raw_lines(spark, sf))


@register("invoice_qty_mismatch", O.sql(f"""
SELECT count_if(neg AND NOT c) AS negative_not_c, count_if(c AND NOT neg) AS c_not_negative
FROM (SELECT {O.starts('invoice_no', 'C')} AS c, COALESCE(quantity < 0, false) AS neg FROM raw) t""", "raw"),
    ids=("FLT-2",))
def q_invoice_qty_mismatch(spark, sf):
    return P.invoice_qty_mismatch(raw_lines(spark, sf))


_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in S.RAW_COLUMNS)


@register("mismatch_examples", O.sql(f"""
SELECT * FROM (
  SELECT {_RAW}, kind, row_number() OVER (PARTITION BY kind ORDER BY {_ORDER}) AS rk FROM (
    SELECT *, CASE WHEN neg AND NOT c THEN 'negative_not_c' WHEN c AND NOT neg THEN 'c_not_negative' END AS kind
    FROM (SELECT *, {O.starts('invoice_no', 'C')} AS c, COALESCE(quantity < 0, false) AS neg FROM raw) a) b
  WHERE kind IS NOT NULL) z
WHERE rk <= 20""", "raw"), ids=("FLT-2", "TOP-2"))
def q_mismatch_examples(spark, sf):
    return P.mismatch_examples(raw_lines(spark, sf))


@register("group_top_codes", O.sql(f"""
SELECT eda_group, stock_code, n, rk FROM (
  SELECT eda_group, stock_code, n,
         row_number() OVER (PARTITION BY eda_group ORDER BY n DESC, stock_code ASC) AS rk
  FROM (SELECT eda_group, stock_code, count(*) AS n FROM (
          SELECT stock_code, CASE WHEN {O.starts('invoice_no', 'A')} THEN NULL
                                  WHEN {O.starts('invoice_no', 'C')} THEN 'c_invoice_rows'
                                  WHEN quantity > 0 AND price > 0 THEN 'clean_sales'
                                  WHEN quantity > 0 AND price = 0 THEN 'free_items' END AS eda_group
          FROM eda) g
        WHERE eda_group IS NOT NULL GROUP BY ALL) c) r
WHERE rk <= 10""", "eda"), ids=("FLT-3", "AGG-5"))
def q_group_top_codes(spark, sf):
    return P.group_top_codes(raw_lines(spark, sf))


@register("zero_price_subtypes", O.sql(f"""
SELECT count_if(na AND quantity > 0 AND price = 0) AS zero_price_positive_qty,
       count_if(na AND quantity < 0 AND price = 0) AS zero_price_negative_qty
FROM (SELECT *, NOT {O.starts('invoice_no', 'C')} AND NOT {O.starts('invoice_no', 'A')} AS na FROM raw) t""",
    "raw"), ids=("FLT-4",))
def q_zero_price_subtypes(spark, sf):
    return P.zero_price_subtypes(raw_lines(spark, sf))


_free_pos = (f"NOT {O.starts('invoice_no', 'C')} AND NOT {O.starts('invoice_no', 'A')} "
             "AND quantity > 0 AND price = 0")


@register("free_item_top_codes", O.sql(_value_counts_sql("stock_code", "eda", 20, _free_pos), "eda"),
          ids=("FLT-4", "AGG-5"))
def q_free_item_top_codes(spark, sf):
    e = P.eda_frame(raw_lines(spark, sf))
    return P.value_counts(_free_positive(e), "stock_code", 20)


@register("free_item_top_descriptions", O.sql(_value_counts_sql("description", "eda", 20, _free_pos), "eda"),
          ids=("FLT-4", "AGG-5"))
def q_free_item_top_descriptions(spark, sf):
    e = P.eda_frame(raw_lines(spark, sf))
    return P.value_counts(_free_positive(e), "description", 20)


def _free_positive(e):
    from ..functions.text import starts
    return e.where(~starts("invoice_no", "C") & ~starts("invoice_no", "A")
                   & (F.col("quantity") > 0) & (F.col("price") == 0))


CTE["fam"] = (f"""
  SELECT 'DCGS' AS family, * FROM eda WHERE {_dcgs}
  UNION ALL SELECT 'GIFT' AS family, * FROM eda WHERE {_gift}""", ("eda",))
CTE["fam_counts"] = (f"""
  SELECT family, section, key, count(*) AS n FROM (
    SELECT family, 'rows' AS section, 'all' AS key FROM fam
    UNION ALL SELECT family, 'invoice_type', {_prefix} FROM fam
    UNION ALL SELECT family, 'quantity_bucket', {_bucket('quantity')} FROM fam
    UNION ALL SELECT family, 'price_bucket', {_bucket('price')} FROM fam
    UNION ALL SELECT family, 'quantity_x_price', {_bucket('quantity')} || ' | ' || {_bucket('price')} FROM fam
    UNION ALL SELECT family, 'customer', CASE WHEN customer_id IS NOT NULL THEN 'present' ELSE 'missing' END FROM fam
    UNION ALL SELECT family, 'country', country FROM fam
    UNION ALL SELECT family, 'stock_code', stock_code FROM fam
    UNION ALL SELECT family, 'description', description FROM fam) c
  WHERE key IS NOT NULL GROUP BY ALL""", ("fam",))


@register("family_profile", O.sql("""
SELECT family, section, key, n FROM (
  SELECT *, row_number() OVER (PARTITION BY family, section ORDER BY n DESC, key ASC) AS rk FROM fam_counts) t
WHERE rk <= CASE section WHEN 'country' THEN 10 WHEN 'stock_code' THEN 20 WHEN 'description' THEN 20
                 ELSE 1073741824 END
UNION ALL
SELECT family, 'distinct_codes', 'all', count(*) FROM fam_counts WHERE section = 'stock_code' GROUP BY family""",
    "fam_counts"), ids=("AGG-8", "FLT-5", "NUM-7", "STR-5"))
def q_family_profile(spark, sf):
    return P.family_profile(raw_lines(spark, sf))


@register("code_families", O.sql(f"""
SELECT CASE WHEN {_dcgs} THEN 'DCGS' WHEN {_gift} THEN 'GIFT' WHEN {_wide_special} THEN 'OTHER_SPECIAL' ELSE 'NORMAL' END AS family,
       count(*) AS n_rows, count(DISTINCT stock_code) AS n_codes, count(DISTINCT invoice_no) AS n_invoices
FROM eda GROUP BY 1""", "eda"), ids=("FLT-5",))
def q_code_families(spark, sf):
    return P.code_families(raw_lines(spark, sf))


@register("paid_family_checks", O.sql(f"""
SELECT count_if(g AND paid) AS gift_paid_rows, count_if(g AND paid AND blank) AS gift_paid_blank_description,
       count_if(d AND paid) AS dcgs_paid_rows, count_if(d AND paid AND blank) AS dcgs_paid_blank_description,
       count_if(d AND paid AND COALESCE(lower(description) IN ('ebay', 'update'), false)) AS dcgs_paid_ebay_update,
       count_if(d AND quantity > 0 AND price = 0) AS dcgs_zero_price_positive_qty
FROM (SELECT *, {_gift} AS g, {_dcgs} AS d, COALESCE(quantity > 0 AND price > 0, false) AS paid,
             (description IS NULL OR {O.strip('description')} = '') AS blank FROM eda) t""", "eda"),
    ids=("AGG-9",))
def q_paid_family_checks(spark, sf):
    return P.paid_family_checks(raw_lines(spark, sf))


CTE["dcgs_paid"] = (f"SELECT * FROM eda WHERE {_dcgs} AND quantity > 0 AND price > 0", ("eda",))
_hash_cols = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<null>')" for c in S.RAW_COLUMNS)


@register("dcgs_sample", O.sql(f"""
SELECT {_RAW} FROM dcgs_paid
ORDER BY md5(concat_ws('|', '67', {_hash_cols})), {_ORDER}
LIMIT 20""", "dcgs_paid"), ids=("TOP-3",))
def q_dcgs_sample(spark, sf):
    return P.sample_rows(P.dcgs_paid(raw_lines(spark, sf)), 20, 67)


def _describe_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, min({x}) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, "
            f"round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75, "
            f"max({x}) AS max FROM dcgs_paid")


@register("dcgs_describe", O.sql(_describe_sql("price") + " UNION ALL " + _describe_sql("quantity"), "dcgs_paid"),
          ids=("AGG-7",))
def q_dcgs_describe(spark, sf):
    return P.describe(P.dcgs_paid(raw_lines(spark, sf)), ["price", "quantity"])


@register("shared_descriptions", O.sql(f"""
SELECT description FROM eda WHERE {_dcgs} AND quantity > 0 AND price > 0
INTERSECT
SELECT description FROM eda WHERE NOT {_dcgs} AND quantity > 0 AND price > 0""", "eda"), ids=("SET-2",))
def q_shared_descriptions(spark, sf):
    return P.shared_descriptions(raw_lines(spark, sf))


CTE["special_summary"] = ("""
  SELECT c.stock_code, c.count, COALESCE(m.unique_descriptions, 0) AS unique_descriptions, m.top_description
  FROM (SELECT stock_code, count(*) AS count FROM other_special GROUP BY stock_code) c
  LEFT JOIN (
    SELECT stock_code, count(*) AS unique_descriptions,
           arg_min(description, struct_pack(k := -dn, d := description)) AS top_description
    FROM (SELECT stock_code, description, count(*) AS dn FROM other_special
          WHERE description IS NOT NULL GROUP BY ALL) x
    GROUP BY stock_code) m ON c.stock_code = m.stock_code
  ORDER BY c.count DESC, c.stock_code ASC
  LIMIT 20""", ("other_special",))


@register("special_code_summary", O.sql("SELECT * FROM special_summary", "special_summary"),
          ids=("AGG-10", "UDF-2"))
def q_special_code_summary(spark, sf):
    return P.special_code_summary(raw_lines(spark, sf))


@register("descriptions_by_code", O.sql("""
SELECT stock_code, description, count(*) AS lines
FROM other_special WHERE stock_code IN (SELECT stock_code FROM special_summary) AND description IS NOT NULL
GROUP BY stock_code, description""", "special_summary"), ids=("AGG-11",))
def q_descriptions_by_code(spark, sf):
    raw = raw_lines(spark, sf)
    return P.descriptions_by_code(raw, P.special_code_summary(raw))


@register("code_customer_presence", O.sql("""
SELECT count(*) AS rows, count_if(customer_id IS NOT NULL) AS with_customer,
       count_if(customer_id IS NULL) AS without_customer, count_if(customer_id IS NULL) / count(*) AS missing_rate
FROM eda WHERE stock_code = 'DOT'""", "eda"), ids=("AGG-12",))
def q_code_customer_presence(spark, sf):
    return P.code_customer_presence(raw_lines(spark, sf))


@register("exclusion_breakdown", O.sql(f"""
SELECT count(*) AS total, count_if(c) AS cancellations, count_if(a) AS admin,
       count_if(NOT (quantity > 0)) AS quantity_le_0, count_if(NOT (price > 0)) AS price_le_0,
       count_if(NOT c AND NOT a AND quantity > 0 AND price > 0) AS clean_like
FROM (SELECT *, {O.starts('invoice_no', 'C')} AS c, {O.starts('invoice_no', 'A')} AS a FROM other_special) t""",
    "other_special"), ids=("AGG-13",))
def q_exclusion_breakdown(spark, sf):
    return P.exclusion_breakdown(raw_lines(spark, sf))


@register("shipping_invoice_share", O.sql(f"""
SELECT count(DISTINCT CASE WHEN pd THEN invoice_no END) AS post_dot_invoices,
       count(DISTINCT CASE WHEN cl THEN invoice_no END) AS clean_sales_invoices,
       count(DISTINCT CASE WHEN pd THEN invoice_no END)
         / count(DISTINCT CASE WHEN cl THEN invoice_no END) AS post_dot_share
FROM (SELECT *, ({_wide_special} AND NOT {_dcgs} AND NOT {_gift} AND stock_code IN ('POST', 'DOT')) AS pd,
             (NOT {O.starts('invoice_no', 'A')} AND NOT {O.starts('invoice_no', 'C')}
              AND quantity > 0 AND price > 0) AS cl FROM eda) t""", "eda"), ids=("AGG-14",))
def q_shipping_invoice_share(spark, sf):
    return P.shipping_invoice_share(raw_lines(spark, sf))


@register("amount_examples", O.sql(f"""
SELECT * FROM (SELECT {_RAW}, 'negative_price' AS kind FROM raw WHERE price < 0 ORDER BY {_ORDER} LIMIT 10) a
UNION ALL
SELECT * FROM (SELECT {_RAW}, 'zero_quantity' AS kind FROM raw WHERE quantity = 0 ORDER BY {_ORDER} LIMIT 10) b""",
    "raw"), ids=("VAL-3", "TOP-2"))
def q_amount_examples(spark, sf):
    return P.amount_examples(raw_lines(spark, sf))
