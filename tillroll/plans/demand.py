"""Queries for daily demand, spike labels and next-day spike features."""

from __future__ import annotations

from .. import schema as S
from ..operators import demand as D
from ..operators import evaluate as E
from ..sources import fixtures
from . import oracle as O
from .catalog import register
from .stages import clean_sales

_MARKET = f"CASE WHEN country = {O.q(S.HOME_COUNTRY)} THEN 'UK' WHEN country IS NOT NULL THEN 'Non-UK' END"
O.CTES["daily"] = (f"""
  SELECT market, date,
         CAST(month(date) AS INTEGER) AS month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_the_week,
         CAST(quarter(date) AS INTEGER) AS quarter, dayofweek(date) IN (0, 6) AS is_weekend,
         CAST(floor((dayofyear(date) - 1) / 7) + 1 AS INTEGER) AS week_of_the_year,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(price) AS DECIMAL(38,2)) AS total_revenue,
         count(DISTINCT invoice_no) AS n_order,
         CAST(sum(price) AS DOUBLE) / count(DISTINCT invoice_no) AS revenue_per_order,
         CAST(sum(quantity) AS DOUBLE) / count(DISTINCT invoice_no) AS avg_order_size
  FROM (SELECT invoice_no, price, quantity, {_MARKET} AS market, CAST(invoice_date AS DATE) AS date FROM sales
        WHERE country = {O.q(S.HOME_COUNTRY)} OR country <> {O.q(S.HOME_COUNTRY)}) l
  GROUP BY market, date""", ("sales",))
O.CTES["labelled"] = (f"""
  SELECT * EXCLUDE (thr), CASE WHEN total_quantity >= thr THEN 'High' ELSE 'Normal' END AS demand_spike,
         round(thr, 6) AS spike_threshold
  FROM (SELECT *, quantile_cont(CAST(total_quantity AS DOUBLE), {S.SPIKE_QUANTILE})
                    OVER (PARTITION BY market) AS thr FROM daily) d""", ("daily",))
O.CTES["features"] = ("""
  SELECT *, CAST(week_of_the_year * day_of_the_week AS DOUBLE) AS weekxday,
         CAST(week_of_the_year * CAST(is_weekend AS INTEGER) AS DOUBLE) AS weekxweekend,
         day7_roll_order * lag1_orders AS day7rollxlag1
  FROM (
    SELECT *, lag(total_quantity) OVER w AS lag1_quantity, lag(n_order) OVER w AS lag1_orders,
           lag(total_revenue) OVER w AS lag1_revenue,
           CASE WHEN row_number() OVER w >= 7 THEN CAST(sum(total_quantity) OVER w7 AS DOUBLE) / 7 END
             AS day7_roll_quantity,
           CASE WHEN row_number() OVER w >= 7 THEN CAST(sum(n_order) OVER w7 AS DOUBLE) / 7 END AS day7_roll_order,
           lead(demand_spike) OVER w AS next_day_spike
    FROM labelled
    WINDOW w AS (PARTITION BY market ORDER BY date),
           w7 AS (PARTITION BY market ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) f
  WHERE lag1_quantity IS NOT NULL AND day7_roll_quantity IS NOT NULL AND next_day_spike IS NOT NULL""",
                      ("labelled",))


def daily(spark, sf):
    return fixtures.memo(spark, ("daily", sf.rstrip("/")), lambda: D.daily_demand(clean_sales(spark, sf)))


def features(spark, sf):
    return fixtures.memo(spark, ("features", sf.rstrip("/")),
                         lambda: D.demand_features(D.spike_label(daily(spark, sf))))


@register("daily_demand", O.sql("SELECT * FROM daily", "daily"),
          ids=("AGG-19", "DAT-3", "FLT-6", "NUM-4", "SRC-3"))
def q_daily_demand(spark, sf):
    return daily(spark, sf)


@register("spike_label", O.sql("SELECT * FROM labelled", "labelled"), ids=("SPK-2", "AGG-20", "JOI-7", "CND-1"))
def q_spike_label(spark, sf):
    return D.spike_label(daily(spark, sf))


@register("demand_features", O.sql("SELECT * FROM features", "features"),
          ids=("SPK-1", "WIN-1", "WIN-2", "WIN-3", "NUM-5", "FLT-9", "PRJ-4"))
def q_demand_features(spark, sf):
    return features(spark, sf)


@register("spike_revenue", O.sql("""
SELECT CAST(sum(total_revenue) AS DOUBLE) / count(*) AS avg_spike_revenue, count(*) AS total_spike_days,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_spike_revenue
FROM features WHERE market = 'UK' AND demand_spike = 'High'""", "features"), ids=("AGG-28",))
def q_spike_revenue(spark, sf):
    return D.spike_revenue(features(spark, sf))


@register("market_means", O.sql("""
SELECT market, CAST(sum(total_quantity) AS DOUBLE) / count(total_quantity) AS total_quantity,
       CAST(sum(n_order) AS DOUBLE) / count(n_order) AS n_order,
       CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS total_revenue,
       round(avg(day7_roll_quantity), 6) AS day7_roll_quantity
FROM features GROUP BY market""", "features"), ids=("AGG-29", "UDF-4", "SET-1"))
def q_market_means(spark, sf):
    return D.market_means(features(spark, sf))


# ---------------------------------------------------------------------------- models
def spike_models(spark, sf):
    from ..operators.spike_models import SpikeModels, spike_sets
    return fixtures.remember(spark, ("spike_models", sf.rstrip("/")), lambda: SpikeModels(spike_sets(features(spark, sf)).persist()))


@register("spike_split", O.sql("""
SELECT part, next_day_spike, count(*) AS n FROM (
  SELECT next_day_spike,
         CASE WHEN row_number() OVER (PARTITION BY next_day_spike ORDER BY h, date)
                   <= ceil(count(*) OVER (PARTITION BY next_day_spike) * CAST(0.8 AS DOUBLE)) THEN 'train'
              ELSE 'uk_test' END AS part
  FROM (SELECT *, md5(COALESCE(CAST(date AS VARCHAR), '')) AS h FROM features WHERE market = 'UK') u
  UNION ALL
  SELECT next_day_spike, 'nouk_test' FROM features WHERE market = 'Non-UK') s
GROUP BY part, next_day_spike""", "features"), ids=("SPL-2", "SPL-3", "ENC-1"))
def q_spike_split(spark, sf):
    from pyspark.sql import functions as F
    from ..operators.spike_models import spike_sets
    return (spike_sets(features(spark, sf)).groupBy("part", "next_day_spike")
            .agg(F.count(F.lit(1)).alias("n")))


# Evaluation of a predictor that needs no fit: tomorrow will be as today.
O.CTES["persistence"] = ("SELECT *, least(total_quantity / (2 * spike_threshold), 1.0) AS p_high FROM features", ("features",))


def persistence(spark, sf):
    from pyspark.sql import functions as F
    return features(spark, sf).withColumn("p_high", F.least(F.col("total_quantity") / (2 * F.col("spike_threshold")), F.lit(1.0)))


@register("persistence_confusion", O.sql("""
SELECT market, demand_spike AS predicted, next_day_spike AS actual, count(*) AS n FROM persistence GROUP BY ALL""", "persistence"),
          ids=("EVL-1",))
def q_persistence_confusion(spark, sf):
    return E.confusion(persistence(spark, sf), "demand_spike", "next_day_spike", ("market",))


@register("persistence_metrics", O.sql("""
SELECT market, n, ok / n AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall, (n - ok) / n AS error_rate, round(brier, 9) AS brier
FROM (SELECT market, count(*) AS n, count_if(demand_spike = next_day_spike) AS ok,
             count_if(demand_spike = 'High' AND next_day_spike = 'High') AS tp,
             count_if(demand_spike = 'High' AND next_day_spike <> 'High') AS fp,
             count_if(demand_spike <> 'High' AND next_day_spike = 'High') AS fn,
             avg(pow(CASE WHEN next_day_spike = 'High' THEN 1.0 ELSE 0.0 END - p_high, 2)) AS brier
      FROM persistence GROUP BY market) t""", "persistence"), ids=("EVL-2", "EVL-3"))
def q_persistence_metrics(spark, sf):
    from pyspark.sql import functions as F
    out = E.classification_metrics(persistence(spark, sf), "demand_spike", "next_day_spike", by=("market",), probability="p_high")
    return out.withColumn("brier", F.round("brier", 9))


@register("persistence_mse", O.sql("""
SELECT market, round(avg(pow(CAST(total_quantity AS DOUBLE) - lag1_quantity, 2)), 3) AS mse, count(*) AS n
FROM features GROUP BY market""", "features"), ids=("EVL-3",))
def q_persistence_mse(spark, sf):
    from pyspark.sql import functions as F
    return E.mse(features(spark, sf), "total_quantity", "lag1_quantity", ("market",)).withColumn("mse", F.round("mse", 3))


@register("persistence_weeks", O.sql("""
SELECT week_of_the_year, count(*) AS predicted_spike_days FROM persistence
WHERE market = 'UK' AND demand_spike = 'High' GROUP BY 1""", "persistence"), ids=("AGG-27",))
def q_persistence_weeks(spark, sf):
    from pyspark.sql import functions as F
    return D.spike_weeks(persistence(spark, sf).where(F.col("market") == "UK"), "demand_spike")


@register("spike_model_comparison", None, ids=("ML-5", "ML-6", "ML-9", "EVL-2", "EVL-3", "EVL-4", "CND-1"))
def q_spike_model_comparison(spark, sf):
    return spike_models(spark, sf).comparison()


@register("spike_tree", None, ids=("ML-5", "EVL-2"))
def q_spike_tree(spark, sf):
    return spike_models(spark, sf).comparison(("Decision Tree",))


@register("spike_tree_pruned", None, ids=("ML-5",))
def q_spike_tree_pruned(spark, sf):
    """The pruning path; the tree in use is the last one whose cp is within the limit."""
    from pyspark.sql import functions as F
    path = spike_models(spark, sf).pruning_path()
    used = path.where(F.col("cp") <= S.SPIKE_TREE_CP).select(F.max("step")).scalar()
    return path.select("step", "complexity", "cp", "leaves", "relative_risk", F.array_join("cut", ",").alias("cut_nodes"),
                       (F.col("step") == used).alias("is_used"))


@register("spike_forest", None, ids=("ML-6", "EVL-2"))
def q_spike_forest(spark, sf):
    return spike_models(spark, sf).comparison(("Random Forest",))


@register("spike_confusion", None, ids=("EVL-1",))
def q_spike_confusion(spark, sf):
    return spike_models(spark, sf).confusion()


@register("spike_importance", None, ids=("ML-7",))
def q_spike_importance(spark, sf):
    from ..operators.spike_models import MODELS, _stack
    models = spike_models(spark, sf)
    return _stack([models.importance(m) for m in MODELS])


@register("spike_permutation_importance", None, ids=("ML-8",))
def q_spike_permutation_importance(spark, sf):
    return spike_models(spark, sf).forest_permutation()


@register("spike_weeks", None, ids=("AGG-27",))
def q_spike_weeks(spark, sf):
    from pyspark.sql import functions as F
    boosted = spike_models(spark, sf).scored("Boosting (GBM)")
    return D.spike_weeks(boosted.where((F.col("part") == "uk_test") & (F.col("cut") == S.BOOST_CUTS[0])))


@register("spike_boost_rounds", None, ids=("ML-9", "EVL-4"))
def q_spike_boost_rounds(spark, sf):
    """The cross-validated loss after every round."""
    from pyspark.sql import functions as F
    from ..operators import boosting as B
    models = spike_models(spark, sf)
    return B.cv_loss(models.trees()).select("round", "cv_loss", (F.col("round") == models.best_round()).alias("is_best"))
