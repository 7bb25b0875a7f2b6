"""Queries for when customers shop: peak-hour labels and invoice roll-ups."""

from __future__ import annotations

from .. import schema as S
from ..operators import hours as H
from ..sources import fixtures
from . import oracle as O
from .catalog import register
from .stages import clean_sales

_MARKET = f"CASE WHEN country = {O.q(S.HOME_COUNTRY)} THEN 'UK' WHEN country IS NOT NULL THEN 'Non-UK' END"
_KEY = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in H.SPLIT_KEY)
O.CTES["hsplit"] = (f"""
  SELECT *, CASE WHEN market <> 'UK' THEN 'nouk_test'
                 WHEN substr(md5(concat_ws('|', {_KEY})), 1, 4) < 'cccd' THEN 'uk_train'
                 ELSE 'uk_test' END AS part
  FROM (SELECT invoice_no, stock_code, description, quantity, price, country, invoice_date,
               price * quantity AS revenue, CAST(month(invoice_date) AS INTEGER) AS month_num,
               CAST(isodow(invoice_date) AS INTEGER) AS day_of_week, CAST(hour(invoice_date) AS INTEGER) AS hour,
               CAST(quarter(invoice_date) AS INTEGER) AS quarter_num, {_MARKET} AS market
        FROM sales WHERE country = {O.q(S.HOME_COUNTRY)} OR country <> {O.q(S.HOME_COUNTRY)}) l""", ("sales",))
O.CTES["hour_rev"] = ("""
  SELECT hour, CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_revenue
  FROM hsplit WHERE part = 'uk_train' GROUP BY hour""", ("hsplit",))
O.CTES["hlabel"] = (f"""
  SELECT s.*, h.avg_revenue,
         CASE WHEN h.avg_revenue IS NOT NULL
                   AND h.avg_revenue >= (SELECT quantile_cont(avg_revenue, {S.PEAK_QUANTILE}) FROM hour_rev)
              THEN 1 ELSE 0 END AS is_peak_hour
  FROM hsplit s LEFT JOIN hour_rev h ON s.hour = h.hour""", ("hour_rev",))
O.CTES["inv_features"] = ("""
  SELECT part, invoice_no, arg_min(is_peak_hour, invoice_date) AS is_peak_hour,
         CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_qty,
         count(*) AS num_items, arg_min(day_of_week, invoice_date) AS day_of_week,
         arg_min(month_num, invoice_date) AS month_num
  FROM hlabel GROUP BY part, invoice_no""", ("hlabel",))


def split(spark, sf, unit: str = "row"):
    # line-level: a projection of the Parquet stage table, recomputed rather
    # than cached (only aggregated tables are persisted)
    return fixtures.stage(spark, ("hsplit", sf.rstrip("/"), unit),
                          lambda: H.peak_split(H.shopping_lines(clean_sales(spark, sf)), unit=unit))


def invoices(spark, sf, unit: str = "row"):
    return fixtures.memo(spark, ("invoices", sf.rstrip("/"), unit),
                         lambda: H.invoice_features(H.peak_label(split(spark, sf, unit))))


@register("hour_revenue", O.sql("SELECT * FROM hour_rev", "hour_rev"), ids=("AGG-22", "SPL-1", "SPL-3", "DAT-3"))
def q_hour_revenue(spark, sf):
    from pyspark.sql import functions as F
    return H.hour_revenue(split(spark, sf).where(F.col("part") == "uk_train"))


@register("peak_threshold", O.sql(f"""
SELECT round(quantile_cont(avg_revenue, {S.PEAK_QUANTILE}), 6) AS peak_threshold, count(*) AS n_hours
FROM hour_rev""", "hour_rev"), ids=("PEAK-1", "AGG-20"))
def q_peak_threshold(spark, sf):
    return H.peak_threshold(split(spark, sf))


@register("invoice_features", O.sql("SELECT * FROM inv_features", "inv_features"),
          ids=("AGG-23", "PEAK-1", "JOI-6", "JOI-7", "JOI-8"))
def q_invoice_features(spark, sf):
    return invoices(spark, sf)


@register("hour_day_revenue", O.sql("""
SELECT hour, day_of_week, CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_revenue
FROM hsplit GROUP BY hour, day_of_week""", "hsplit"), ids=("AGG-24",))
def q_hour_day_revenue(spark, sf):
    return H.hour_day_revenue(split(spark, sf))


def _logit(spark, sf):
    return fixtures.remember(spark, ("peak_logistic", sf.rstrip("/")), lambda: H.peak_logistic(invoices(spark, sf)))


def _lda(spark, sf):
    return fixtures.remember(spark, ("peak_lda", sf.rstrip("/")), lambda: H.peak_lda(invoices(spark, sf)))


@register("peak_logistic_coefficients", None, ids=("ML-13",))
def q_peak_logistic_coefficients(spark, sf):
    return _logit(spark, sf)[0]


@register("peak_logistic_confusion", None, ids=("ML-13", "EVL-1", "AGG-6"))
def q_peak_logistic_confusion(spark, sf):
    return _logit(spark, sf)[1]


@register("peak_logistic_error", None, ids=("ML-13", "EVL-2"))
def q_peak_logistic_error(spark, sf):
    return _logit(spark, sf)[2]


@register("lda_class_stats", O.sql("""
SELECT is_peak_hour, count(*) AS n,
       round(avg(CAST(total_revenue AS DOUBLE)), 6) AS mean_total_revenue,
       round(avg(CAST(total_qty AS DOUBLE)), 6) AS mean_total_qty,
       round(avg(CAST(day_of_week AS DOUBLE)), 6) AS mean_day_of_week,
       round(avg(CAST(month_num AS DOUBLE)), 6) AS mean_month_num
FROM inv_features WHERE part = 'uk_train' GROUP BY is_peak_hour""", "inv_features"), ids=("ML-14",))
def q_lda_class_stats(spark, sf):
    return H.lda_class_stats(invoices(spark, sf))


@register("peak_lda_weights", None, ids=("ML-14",))
def q_peak_lda_weights(spark, sf):
    return _lda(spark, sf)[0]


@register("peak_lda_confusion", None, ids=("ML-14", "EVL-1"))
def q_peak_lda_confusion(spark, sf):
    return _lda(spark, sf)[1]


@register("peak_lda_error", None, ids=("ML-14", "EVL-2"))
def q_peak_lda_error(spark, sf):
    return _lda(spark, sf)[2]
