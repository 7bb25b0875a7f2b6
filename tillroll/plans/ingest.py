"""Queries on the text extracts: typed ingest, and the validation of what doesn't parse or is missing."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import demand as D
from ..operators import profile as P
from ..operators.splits import mask_summary
from ..sources import extracts
from ..sources.fixtures import stage
from ..sources.io import materialize
from . import oracle as O
from .catalog import register
from .stages import build_cleaned

_TYPES = {"invoice_date": "TIMESTAMP", "quantity": "INTEGER", "price": "DECIMAL(10,2)", "customer_id": "DOUBLE"}
_CAST = {c: f"TRY_CAST({c} AS {_TYPES[c]})" if c in _TYPES else c for c in S.RAW_COLUMNS}
O.CTES["extract"] = (extracts.EXTRACT_SQL, ("raw",))
O.CTES["ingested"] = (f"""
  SELECT {', '.join(f'{e} AS {c}' for c, e in _CAST.items())}, extract,
         {' OR '.join(f'({c} IS NOT NULL AND {_CAST[c]} IS NULL)' for c in _TYPES)} AS is_corrupt
  FROM extract""", ("extract",))


def text(spark, sf):
    return extracts.text_lines(spark, sf)


def ingested(spark, sf):
    return extracts.ingested_lines(spark, sf)


@register("ingest_raw", O.sql("SELECT * FROM ingested", "ingested"), ids=("SRC-1", "SNK-1", "SRC-2"))
def q_ingest_raw(spark, sf):
    """Two CSV extracts read with declared types, written as one table and read back."""
    return ingested(spark, sf)


@register("ingest_columns", O.sql(
    "SELECT CAST(p AS INTEGER) AS position, name, type, non_null, n_rows FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS p, {O.q(c)} AS name, {O.q(t)} AS type, count({c}) AS non_null, count(*) AS n_rows FROM ingested"
        for i, (c, t) in enumerate([*[(f.name, f.dataType.simpleString()) for f in S.RAW_SCHEMA.fields], ("extract", "int"),
                                    ("is_corrupt", "boolean")])) + ") t", "ingested"), ids=("VAL-8", "VAL-7"))
def q_ingest_columns(spark, sf):
    return P.column_profile(ingested(spark, sf))


@register("ingest_amounts", O.sql("""
SELECT count_if(q IS NULL) AS quantity_non_numeric, count_if(p IS NULL) AS price_non_numeric,
       count_if(q < 0) AS quantity_neg, count_if(q = 0) AS quantity_zero, count_if(q > 0) AS quantity_pos,
       count_if(p < 0) AS price_neg, count_if(p = 0) AS price_zero, count_if(p > 0) AS price_pos
FROM (SELECT TRY_CAST(quantity AS DOUBLE) AS q, TRY_CAST(price AS DOUBLE) AS p FROM extract) t""", "extract"), ids=("VAL-3", "NUM-1"))
def q_ingest_amounts(spark, sf):
    return P.validate_amounts(text(spark, sf))


@register("ingest_dates", O.sql("""
SELECT count(p) AS valid_dates, count_if(p IS NULL) AS invalid_dates,
       count_if(p IS NULL) / count(*) AS invalid_rate, min(p) AS min_date, max(p) AS max_date
FROM (SELECT TRY_CAST(invoice_date AS TIMESTAMP) AS p FROM extract) t""", "extract"), ids=("DAT-1",))
def q_ingest_dates(spark, sf):
    return P.date_profile(text(spark, sf))


_ID_OK = f"COALESCE(regexp_matches(CAST(TRY_CAST(customer_id AS BIGINT) AS VARCHAR), {O.q(S.CUSTOMER_PATTERN)}), false)"


@register("ingest_customers", O.sql(f"""
SELECT count_if(customer_id IS NULL) AS missing_count, count_if(customer_id IS NULL) / count(*) AS missing_rate,
       count_if(customer_id IS NOT NULL AND ok) AS valid_count, count_if(customer_id IS NOT NULL AND NOT ok) AS invalid_count
FROM (SELECT *, {_ID_OK} AS ok FROM extract) t""", "extract"), ids=("VAL-2", "STR-2"))
def q_ingest_customers(spark, sf):
    return P.validate_customer(text(spark, sf))


@register("ingest_customer_examples", O.sql(
    f"SELECT {', '.join(S.RAW_COLUMNS)} FROM extract WHERE customer_id IS NOT NULL AND NOT {_ID_OK} "
    f"ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in S.RAW_COLUMNS)} LIMIT 10", "extract"), ids=("VAL-2", "TOP-2"))
def q_ingest_customer_examples(spark, sf):
    """The first rows whose customer id is there but not of the known form."""
    return P.customer_examples(text(spark, sf))


# ------------------------------------------------------------- the cleaning on lines with missing keys
def _again(names: dict[str, str]) -> None:
    """The cleaning steps of the oracle over the ingested lines, under other names."""
    for name, new in names.items():
        body, deps = O.CTES[name]
        body = re.sub(r"\b(FROM|JOIN) (\w+)", lambda m: f"{m[1]} {'ingested' if m[2] == 'raw' else names.get(m[2], m[2])}", body)
        O.CTES[new] = (body, tuple(names.get(d, "ingested" if d == "raw" else d) for d in deps))


_again({n: f"{n}_in" for n in ("trimmed", "fill_map", "filled", "noised", "canon_freq", "canon_map", "described", "masked", "cleaned")})


def ingested_cleaned(spark, sf):
    return stage(spark, ("ingested_cleaned", sf.rstrip("/")), lambda: materialize(
        build_cleaned(ingested(spark, sf).select(*S.RAW_COLUMNS)), "ingested_cleaned"))


@register("ingest_cleaned", O.sql("SELECT * FROM cleaned_in", "cleaned_in"), ids=("MSK-1", "MSK-10", "JOI-4"))
def q_ingest_cleaned(spark, sf):
    """Cleaning and masks where invoices, codes, countries, dates and amounts may be missing."""
    return ingested_cleaned(spark, sf)


@register("ingest_mask_summary", O.sql(" UNION ALL ".join(
    f"SELECT {O.q(m)} AS mask, count_if({m}) AS n FROM cleaned_in" for m in S.MASK_COLUMNS), "cleaned_in"), ids=("AGG-16",))
def q_ingest_mask_summary(spark, sf):
    return mask_summary(ingested_cleaned(spark, sf))


@register("ingest_market_lines", O.sql(f"""
SELECT CASE WHEN country = {O.q(S.HOME_COUNTRY)} THEN 'UK' WHEN country IS NOT NULL THEN 'Non-UK' END AS market,
       count(*) AS n, count(DISTINCT invoice_no) AS invoices, count(invoice_date) AS dated
FROM cleaned_in WHERE is_clean_product_sale_candidate GROUP BY 1""", "cleaned_in"), ids=("FLT-6",))
def q_ingest_market_lines(spark, sf):
    """Clean sales per market; lines without a country stand by themselves."""
    sales = ingested_cleaned(spark, sf).where("is_clean_product_sale_candidate")
    return sales.groupBy(D.market().alias("market")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("invoice_no").alias("invoices"),
                                                         F.count("invoice_date").alias("dated"))
