"""Queries for product-month seasonality and bulk buying."""

from __future__ import annotations

from .. import schema as S
from ..operators import season as N
from ..sources import fixtures
from . import oracle as O
from .catalog import register
from .stages import clean_sales

_KEY = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in N.PM_KEY)
O.CTES["pm"] = ("""
  SELECT * FROM (
    SELECT stock_code, description, CAST(month(invoice_date) AS INTEGER) AS month_num, country,
           CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
           count(DISTINCT invoice_no) AS num_invoices
    FROM sales GROUP BY ALL HAVING sum(quantity) > 0) p
  WHERE stock_code IS NOT NULL AND description IS NOT NULL AND month_num IS NOT NULL AND country IS NOT NULL
    AND total_qty IS NOT NULL AND avg_price IS NOT NULL AND num_invoices IS NOT NULL""", ("sales",))
O.CTES["pm_split"] = (f"""
  SELECT *, CASE WHEN country <> {O.q(S.HOME_COUNTRY)} THEN 'nouk_test'
                 WHEN substr(md5(concat_ws('|', {_KEY})), 1, 4) < 'cccd' THEN 'uk_train'
                 ELSE 'uk_test' END AS part
  FROM pm""", ("pm",))


def product_months(spark, sf):
    return fixtures.memo(spark, ("pm", sf.rstrip("/")),
                         lambda: N.product_month_split(N.product_month(clean_sales(spark, sf))))


@register("product_month", O.sql("SELECT * FROM pm_split", "pm_split"),
          ids=("AGG-21", "FLT-9", "FLT-10", "SPL-1", "SPL-3", "SET-4", "JOI-8"))
def q_product_month(spark, sf):
    return product_months(spark, sf)


@register("product_month_split_counts", O.sql(
    "SELECT part, count(*) AS n, CAST(sum(total_qty) AS BIGINT) AS total_qty FROM pm_split GROUP BY part",
    "pm_split"), ids=("AGG-31", "SPL-1"))
def q_pm_split_counts(spark, sf):
    from pyspark.sql import functions as F
    return product_months(spark, sf).groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                                          F.sum("total_qty").cast("long").alias("total_qty"))


def _bulk(spark, sf):
    from ..operators.season import bulk_forest
    return fixtures.remember(spark, ("bulk_forest", sf.rstrip("/")), lambda: bulk_forest(product_months(spark, sf)))


@register("bulk_forest_mse", None, ids=("ML-10", "EVL-3"))
def q_bulk_forest_mse(spark, sf):
    return _bulk(spark, sf)[0]


@register("bulk_importance", None, ids=("ML-7", "ML-8"))
def q_bulk_importance(spark, sf):
    return _bulk(spark, sf)[1]


def _additive(spark, sf):
    from ..operators.season import additive_model
    return fixtures.remember(spark, ("additive", sf.rstrip("/")), lambda: additive_model(product_months(spark, sf)))


@register("additive_model", None, ids=("ML-11",))
def q_additive_model(spark, sf):
    return _additive(spark, sf)[0]


@register("additive_model_mse", None, ids=("ML-11", "EVL-3"))
def q_additive_model_mse(spark, sf):
    return _additive(spark, sf)[1]


@register("spline_cv", None, ids=("ML-12",))
def q_spline_cv(spark, sf):
    from ..operators.season import spline_cv
    return spline_cv(product_months(spark, sf))


@register("additive_model_df", None, ids=("ML-11",))
def q_additive_model_df(spark, sf):
    from ..operators.season import additive_model_df
    return additive_model_df(product_months(spark, sf))
