"""Daily demand, spike labels and next-day features (AGG-19, SPK-*, WIN-1..3, AGG-27..29).

Scale note: every window here runs on the *daily aggregate* (one row per market
and trading day), never on invoice lines. Its size is bounded by the calendar
(days x markets), not by the data volume, so a single task per market is fine
even when the line table is petabytes; the heavy step is the partial
aggregation by (market, day), which combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dates import is_weekend, week_of_year_simple
from ..functions.numeric import label_threshold, ratio

DEMAND_COLUMNS = ("invoice_no", "invoice_date", "price", "quantity", "country", "description")
MODEL_COLUMNS = ("month", "day_of_the_week", "quarter", "is_weekend", "week_of_the_year", "lag1_quantity",
                 "lag1_orders", "lag1_revenue", "day7_roll_quantity", "day7_roll_order", "weekxday",
                 "weekxweekend", "day7rollxlag1")


def market(country="country", home: str = S.HOME_COUNTRY) -> F.Column:
    """FLT-6: home market vs the rest, as a key (never a repartition column)."""
    c = F.col(country) if isinstance(country, str) else country
    return F.when(c == home, F.lit("UK")).when(c.isNotNull(), F.lit("Non-UK"))


def daily_demand(sales: DataFrame, home: str = S.HOME_COUNTRY, revenue: str = "price") -> DataFrame:
    """AGG-19: per market and day: quantity, revenue, distinct orders, ratios, calendar.

    ``revenue='price'`` sums unit prices as the analysed workflow does;
    ``revenue='line'`` sums price x quantity. Lines without a country belong to no market.
    """
    rev = F.col("price") if revenue == "price" else F.col("price") * F.col("quantity")
    lines = (sales.select(*DEMAND_COLUMNS).where(F.col("country").isNotNull())
                  .withColumn("market", market("country", home))
                  .withColumn("date", F.to_date("invoice_date"))
                  .withColumn("_rev", rev))
    daily = lines.groupBy("market", "date").agg(
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.sum("_rev").cast("decimal(38,2)").alias("total_revenue"),
        F.countDistinct("invoice_no").alias("n_order"))
    d = F.col("date")
    return daily.select(
        "market", "date",
        F.month(d).alias("month"), F.dayofweek(d).alias("day_of_the_week"), F.quarter(d).alias("quarter"),
        is_weekend(d).alias("is_weekend"), week_of_year_simple(d).alias("week_of_the_year"),
        "total_quantity", "total_revenue", "n_order",
        ratio("total_revenue", "n_order").alias("revenue_per_order"),
        ratio("total_quantity", "n_order").alias("avg_order_size"))


def spike_label(daily: DataFrame, p: float = S.SPIKE_QUANTILE) -> DataFrame:
    """SPK-2 / AGG-20 / CND-1: High when the day's quantity >= its market's exact
    p-quantile (linear interpolation), else Normal."""
    thr = F.percentile(F.col("total_quantity").cast("double"), p).over(Window.partitionBy("market"))
    return (daily.withColumn("_thr", thr)
                 .withColumn("demand_spike", label_threshold("total_quantity", F.col("_thr")))
                 .withColumn("spike_threshold", F.round("_thr", 6)).drop("_thr"))


def demand_features(labelled: DataFrame) -> DataFrame:
    """SPK-1: lags (by trading day, not calendar), right-aligned 7-row means,
    interactions and tomorrow's label; rows lacking any of them dropped."""
    w = Window.partitionBy("market").orderBy("date")
    w7 = w.rowsBetween(-6, 0)
    full7 = F.row_number().over(w) >= 7
    out = labelled.select(
        "*",
        F.lag("total_quantity", 1).over(w).alias("lag1_quantity"),
        F.lag("n_order", 1).over(w).alias("lag1_orders"),
        F.lag("total_revenue", 1).over(w).alias("lag1_revenue"),
        F.when(full7, F.sum("total_quantity").over(w7) / 7.0).alias("day7_roll_quantity"),
        F.when(full7, F.sum("n_order").over(w7) / 7.0).alias("day7_roll_order"),
        F.lead("demand_spike", 1).over(w).alias("next_day_spike"))
    out = out.withColumns({
        "weekxday": (F.col("week_of_the_year") * F.col("day_of_the_week")).cast("double"),
        "weekxweekend": (F.col("week_of_the_year") * F.col("is_weekend").cast("int")).cast("double"),
        "day7rollxlag1": F.col("day7_roll_order") * F.col("lag1_orders"),
    })
    return out.where(F.col("lag1_quantity").isNotNull() & F.col("day7_roll_quantity").isNotNull()
                     & F.col("next_day_spike").isNotNull())


def spike_revenue(features: DataFrame, market_name: str = "UK") -> DataFrame:
    """AGG-28: mean, count and total revenue of High days (R half-even rounding)."""
    hi = features.where((F.col("market") == market_name) & (F.col("demand_spike") == "High"))
    # R prints the mean rounded to cents; the unrounded ratio is kept here
    # (rounding is presentation, apply ``r_round(..., 2)`` when reporting).
    return hi.agg(ratio(F.sum("total_revenue"), F.count(F.lit(1))).alias("avg_spike_revenue"),
                  F.count(F.lit(1)).alias("total_spike_days"),
                  F.sum("total_revenue").cast("decimal(38,2)").alias("total_spike_revenue"))


def market_means(features: DataFrame) -> DataFrame:
    """AGG-29 / UDF-4: four feature means per market."""
    return features.groupBy("market").agg(
        ratio(F.sum("total_quantity"), F.count("total_quantity")).alias("total_quantity"),
        ratio(F.sum("n_order"), F.count("n_order")).alias("n_order"),
        ratio(F.sum("total_revenue"), F.count("total_revenue")).alias("total_revenue"),
        F.round(F.avg("day7_roll_quantity"), 6).alias("day7_roll_quantity"))


def spike_weeks(pred: DataFrame, prediction: str = "predicted_spike") -> DataFrame:
    """AGG-27: predicted High days per week, descending."""
    return (pred.where(F.col(prediction) == "High").groupBy("week_of_the_year")
                .agg(F.count(F.lit(1)).alias("predicted_spike_days"))
                .orderBy(F.col("predicted_spike_days").desc(), "week_of_the_year"))
