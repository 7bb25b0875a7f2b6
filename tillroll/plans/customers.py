"""Queries for customer RFM features and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import segments as G
from ..sources import fixtures
from . import oracle as O
from .catalog import register
from .stages import clean_sales

O.CTES["cust_lines"] = ("""
  SELECT invoice_no, invoice_date, price, quantity, country, description, customer_id,
         CAST(invoice_date AS DATE) AS invoice_date_only, price * quantity AS line_revenue
  FROM sales
  WHERE customer_id IS NOT NULL AND NOT is_cancellation_invoice AND NOT is_admin_invoice
    AND NOT is_inventory_adjustment AND NOT is_gift_voucher AND NOT is_shipping_fee AND NOT is_free_item
    AND quantity > 0 AND price > 0""", ("sales",))
O.CTES["rfm"] = (f"""
  SELECT CAST(customer_id AS BIGINT) AS customer_id,
         CAST(datediff('day', max(invoice_date_only),
                       (SELECT max(invoice_date_only) FROM cust_lines) + 1) AS INTEGER) AS recency,
         count(DISTINCT invoice_no) AS frequency,
         CAST(sum(line_revenue) AS DECIMAL(38,2)) AS monetary,
         CAST(sum(line_revenue) AS DOUBLE) / count(DISTINCT invoice_no) AS avg_order_value,
         CAST(sum(quantity) AS DOUBLE) / count(DISTINCT invoice_no) AS avg_basket_size,
         count(DISTINCT description) + max(CASE WHEN description IS NULL THEN 1 ELSE 0 END) AS n_products
  FROM cust_lines GROUP BY customer_id
  HAVING sum(line_revenue) > 0 AND customer_id NOT IN ({", ".join(str(c) for c in S.EXCLUDED_CUSTOMERS)})""",
                     ("cust_lines",))


def customer_rfm(spark, sf):
    return fixtures.memo(spark, ("rfm", sf.rstrip("/")),
                         lambda: G.rfm(G.customer_lines(clean_sales(spark, sf))))


@register("rfm", O.sql("SELECT * FROM rfm", "rfm"),
          ids=("AGG-17", "FLT-7", "FLT-8", "SRC-3", "DAT-2", "DAT-4", "NUM-2", "NUM-4"))
def q_rfm(spark, sf):
    return customer_rfm(spark, sf)


@register("rfm_log", O.sql("""
SELECT customer_id, recency,
       round(ln(1 + CAST(frequency AS DOUBLE)), 6) AS frequency,
       round(ln(1 + CAST(monetary AS DOUBLE)), 6) AS monetary,
       round(ln(1 + avg_order_value), 6) AS avg_order_value,
       round(ln(1 + avg_basket_size), 6) AS avg_basket_size,
       round(ln(1 + CAST(n_products AS DOUBLE)), 6) AS n_products
FROM rfm""", "rfm"), ids=("NUM-3",))
def q_rfm_log(spark, sf):
    return G.log_features(customer_rfm(spark, sf), digits=6)


@register("customer_step_counts", O.sql("""
SELECT 'clean_transactions' AS step, count(*) AS rows, count(DISTINCT customer_id) AS distinct_keys FROM cust_lines
UNION ALL
SELECT 'customers_after_cleaning', count(*), count(DISTINCT customer_id) FROM rfm""", "rfm"), ids=("AGG-31",))
def q_customer_step_counts(spark, sf):
    lines = G.customer_lines(clean_sales(spark, sf))
    return (G.step_counts(lines, "customer_id", "clean_transactions")
            .unionByName(G.step_counts(customer_rfm(spark, sf), "customer_id", "customers_after_cleaning")))


def customer_points(spark, sf):
    """ML-1: first PCA scores of log-RFM, the clustering input."""
    def build():
        scores, _, m = G.customer_pca(G.log_features(customer_rfm(spark, sf)))
        return G.first_components(scores, m).select("customer_id", "features")
    return fixtures.memo(spark, ("points", sf.rstrip("/")), build)


def segment_models(spark, sf, ks):
    """ML-2: the best K-means of every K, fitted once for the queries that use it; those not yet fitted share their passes."""
    key = lambda k: ("kmeans", sf.rstrip("/"), k)
    rest = [k for k in ks if not fixtures.known(spark, key(k))]
    fits = G.kmeans_many(customer_points(spark, sf), rest) if rest else {}
    return {k: fixtures.memo(spark, key(k), lambda k=k: fits[k]) for k in ks}


def customer_segments(spark, sf):
    """ML-1 -> ML-2: PCA scores on log-RFM, the chosen K's clusters relabelled by spend."""
    assigned = G.assign_clusters(customer_points(spark, sf), segment_models(spark, sf, (S.KMEANS_CHOSEN_K,))[S.KMEANS_CHOSEN_K])
    return G.relabel_by_spend(assigned, customer_rfm(spark, sf))


@register("customer_pca_variance", None, ids=("ML-1", "WIN-8"))
def q_customer_pca_variance(spark, sf):
    _, variance, _ = G.customer_pca(G.log_features(customer_rfm(spark, sf)))
    return variance


@register("kmeans_sweep", None, ids=("ML-2",))
def q_kmeans_sweep(spark, sf):
    table, _ = G.kmeans_sweep(customer_points(spark, sf), fit=lambda points, ks, *_: segment_models(spark, sf, ks))
    return table


@register("segment_profiles", None, ids=("AGG-18", "ML-2", "JOI-10", "NUM-6"))
def q_segment_profiles(spark, sf):
    seg = customer_segments(spark, sf).select("customer_id", "segment")
    return G.segment_profiles(customer_rfm(spark, sf).join(seg, "customer_id"))


@register("segment_agreement", None, ids=("ML-3", "ML-4", "AGG-6"))
def q_segment_agreement(spark, sf):
    seg = customer_segments(spark, sf)
    hc = G.hierarchical_segments(seg.select("customer_id", "features"), k=S.KMEANS_CHOSEN_K)
    return G.crosstab(seg.join(hc.select("customer_id", "hc"), "customer_id"), "segment", "hc")


# Segments by fixed bands instead of a fitted model: the steps after the clustering, checked by SQL.
RECENCY_BANDS = (30, 90, 365)
_BAND = "CASE " + " ".join(f"WHEN recency <= {d} THEN {i}" for i, d in enumerate(RECENCY_BANDS)) + f" ELSE {len(RECENCY_BANDS)} END"
O.CTES["banded"] = (f"""
  SELECT r.*, s.segment FROM (SELECT *, {_BAND} AS band FROM rfm) r
  JOIN (SELECT band, CAST(row_number() OVER (ORDER BY avg(CAST(monetary AS DOUBLE)) DESC, band) AS INTEGER) AS segment
        FROM (SELECT *, {_BAND} AS band FROM rfm) b GROUP BY band) s ON s.band = r.band""", ("rfm",))


def banded(spark, sf):
    rfm = customer_rfm(spark, sf)
    bands = rfm.select("customer_id", F.expr(_BAND).alias("cluster"))
    return rfm.join(G.relabel_by_spend(bands, rfm), "customer_id")


@register("band_profiles", O.sql("""
SELECT segment, count(*) AS n_customers, round_even(avg(recency), 0) AS avg_recency, round_even(avg(frequency), 1) AS avg_frequency,
       round_even(avg(CAST(monetary AS DOUBLE)), 0) AS avg_monetary, round_even(avg(avg_order_value), 0) AS avg_order_value,
       round_even(avg(avg_basket_size), 1) AS avg_basket_size, round_even(avg(n_products), 0) AS avg_n_products
FROM banded GROUP BY segment""", "banded"), ids=("AGG-18", "JOI-10", "NUM-6"))
def q_band_profiles(spark, sf):
    return G.segment_profiles(banded(spark, sf))


@register("band_agreement", O.sql("SELECT segment, least(frequency, 10) AS orders, count(*) AS n FROM banded GROUP BY ALL", "banded"),
          ids=("ML-4", "AGG-6"))
def q_band_agreement(spark, sf):
    rows = banded(spark, sf).withColumn("orders", F.least(F.col("frequency"), F.lit(10).cast("long")))
    return G.crosstab(rows, "segment", "orders")
