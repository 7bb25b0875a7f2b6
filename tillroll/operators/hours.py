"""When customers shop: peak-hour labels and invoice roll-ups (PEAK-1, AGG-22..24, JOI-6).

The hour table has at most 24 rows, so joining it back is a broadcast with a
fixed bound; the 0.67-quantile over those hours is a window over that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dates import weekday_mon1
from ..functions.numeric import line_revenue, ratio
from .demand import market
from .evaluate import hash_split

SPLIT_KEY = ("invoice_no", "stock_code", "description", "quantity", "price")


def shopping_lines(sales: DataFrame, home: str = S.HOME_COUNTRY) -> DataFrame:
    """Clean sales with revenue and calendar columns (DAT-3)."""
    ts = F.col("invoice_date")
    return sales.select(
        "invoice_no", "stock_code", "description", "quantity", "price", "country", "invoice_date",
        line_revenue().alias("revenue"), F.month(ts).alias("month_num"),
        weekday_mon1(ts).alias("day_of_week"), F.hour(ts).alias("hour"), F.quarter(ts).alias("quarter_num"),
        market("country", home).alias("market"))


def peak_split(lines: DataFrame, share: float = S.TRAIN_SHARE, unit: str = "row") -> DataFrame:
    """SPL-1 / SPL-3: 'uk_train' / 'uk_test' by hash of the row (``unit='row'``,
    as the analysed workflow: one invoice may sit on both sides) or of the invoice
    (``unit='invoice'``, no leak); every foreign row is 'nouk_test'. Rows without
    a country belong to neither market and are left out."""
    lines = lines.where(F.col("market").isNotNull())
    key = SPLIT_KEY if unit == "row" else ("invoice_no",)
    s = hash_split(lines, key, share, "_train")
    return s.withColumn("part", F.when(F.col("market") != "UK", "nouk_test")
                                 .when(F.col("_train"), "uk_train").otherwise("uk_test")).drop("_train")


def hour_revenue(lines: DataFrame) -> DataFrame:
    """AGG-22: mean line revenue per hour."""
    return lines.groupBy("hour").agg(ratio(F.sum("revenue"), F.count("revenue")).alias("avg_revenue"))


def peak_label(split: DataFrame, p: float = S.PEAK_QUANTILE) -> DataFrame:
    """PEAK-1 / JOI-6: hours learned on uk_train rows only; a row is peak when
    its hour's training mean >= the p-quantile over hours (unseen hour -> 0)."""
    from pyspark.sql import Window
    # One aggregate gives the hour table (at most 24 rows); its quantile is a
    # window over those rows, and the table joins back as a fixed-size broadcast.
    hours = (hour_revenue(split.where(F.col("part") == "uk_train"))
             .withColumn("_thr", F.percentile("avg_revenue", p).over(Window.partitionBy())))
    labelled = split.join(F.broadcast(hours), "hour", "left")
    return labelled.withColumn("is_peak_hour",
                               F.when(F.col("avg_revenue").isNotNull() & (F.col("avg_revenue") >= F.col("_thr")), 1)
                                .otherwise(0)).drop("_thr")


def peak_threshold(split: DataFrame, p: float = S.PEAK_QUANTILE) -> DataFrame:
    hours = hour_revenue(split.where(F.col("part") == "uk_train"))
    return hours.agg(F.round(F.percentile("avg_revenue", p), 6).alias("peak_threshold"),
                     F.count(F.lit(1)).alias("n_hours"))


def invoice_features(labelled: DataFrame) -> DataFrame:
    """AGG-23: one row per (part, invoice). 'first' label/weekday/month is taken
    at the earliest timestamp; all three are functions of that timestamp, so the
    pick is deterministic."""
    first = lambda c: F.min_by(c, "invoice_date")
    return labelled.groupBy("part", "invoice_no").agg(
        first("is_peak_hour").alias("is_peak_hour"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("quantity").cast("long").alias("total_qty"),
        F.count(F.lit(1)).alias("num_items"),
        first("day_of_week").alias("day_of_week"),
        first("month_num").alias("month_num"))


def hour_day_revenue(lines: DataFrame) -> DataFrame:
    """AGG-24: mean revenue by hour and weekday (heat-map data)."""
    return lines.groupBy("hour", "day_of_week").agg(ratio(F.sum("revenue"), F.count("revenue")).alias("avg_revenue"))


# ----------------------------------------------------------------------------- models
LOGIT_FEATURES = ("total_revenue", "total_qty", "num_items", "day_of_week", "month_num")
LDA_FEATURES = ("total_revenue", "total_qty", "day_of_week", "month_num")


def _as_double(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols}).withColumn(
        "label", F.col("is_peak_hour").cast("double"))


def peak_logistic(invoices: DataFrame, features=LOGIT_FEATURES, cut: float = 0.5):
    """ML-13 / EVL-1 / EVL-2: binomial GLM (logit) of the peak label on the basket
    features, fitted on uk_train by IRLS; class = probability > cut.
    Returns (coefficients DF[term, estimate, std_error, z_value, p_value],
    confusion DF[part, predicted, actual, n], errors DF[part, error_rate, n])."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(_as_double(invoices, features))
    model = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50).fit(
        data.where(F.col("part") == "uk_train"))
    s = model.summary
    terms = [*features, "intercept"]
    est = [*model.coefficients.toArray().tolist(), model.intercept]
    rows = list(zip(terms, est, s.coefficientStandardErrors, s.tValues, s.pValues))
    spark = invoices.sparkSession
    coefs = spark.createDataFrame([(t, float(a), float(b), float(c), float(d)) for t, a, b, c, d in rows],
                                  "term string, estimate double, std_error double, z_value double, p_value double")
    pred = (model.transform(data.where(F.col("part") != "uk_train"))
                 .withColumn("predicted", (F.col("prediction") > cut).cast("int")))
    return coefs, *_class_tables(pred)


def _class_tables(pred: DataFrame):
    conf = pred.groupBy("part", "predicted", F.col("is_peak_hour").alias("actual")).agg(
        F.count(F.lit(1)).alias("n"))
    err = pred.groupBy("part").agg((F.count_if(F.col("predicted") != F.col("is_peak_hour")) / F.count(F.lit(1)))
                                   .alias("error_rate"), F.count(F.lit(1)).alias("n"))
    return conf, err


def lda_class_stats(invoices: DataFrame, features=LDA_FEATURES) -> DataFrame:
    """ML-14 statistics: per class n and feature means on uk_train (one aggregate)."""
    train = invoices.where(F.col("part") == "uk_train")
    return train.groupBy("is_peak_hour").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(F.col(c).cast("double")), 6).alias(f"mean_{c}") for c in features])


def peak_lda(invoices: DataFrame, features=LDA_FEATURES):
    """ML-14: linear discriminant analysis with priors = class shares.

    Class counts, sums and cross-products come from one grouped aggregate on
    uk_train; the pooled covariance and discriminant weights are a p x p solve
    on the driver (p = 4); scoring is a linear Column expression.
    Returns (weights DF[class, term, weight], confusion DF, errors DF)."""
    import numpy as np

    train = invoices.where(F.col("part") == "uk_train")
    x = [F.col(c).cast("double") for c in features]
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    aggs += [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    rows = train.groupBy("is_peak_hour").agg(*aggs).collect()
    p, n_total = len(features), sum(r["n"] for r in rows)
    means, scatter = {}, np.zeros((p, p))
    for r in rows:
        s = np.array([r[f"s{i}"] for i in range(p)])
        q = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        mu = s / r["n"]
        means[r["is_peak_hour"]] = (mu, r["n"])
        scatter += q - r["n"] * np.outer(mu, mu)
    cov = scatter / max(n_total - len(rows), 1)
    inv = np.linalg.pinv(cov)
    scores, wrows = {}, []
    for k, (mu, n) in sorted(means.items()):
        w = inv @ mu
        b = float(-0.5 * mu @ inv @ mu + np.log(n / n_total))
        scores[k] = F.lit(b) + sum((F.lit(float(wi)) * xi for wi, xi in zip(w, x)), F.lit(0.0))
        wrows += [(int(k), t, float(v)) for t, v in zip([*features, "constant"], [*w, b])]
    keys = sorted(scores)
    best = F.lit(keys[0])
    top = scores[keys[0]]
    for k in keys[1:]:
        best = F.when(scores[k] > top, F.lit(k)).otherwise(best)
        top = F.greatest(top, scores[k])
    pred = invoices.where(F.col("part") != "uk_train").withColumn("predicted", best.cast("int"))
    weights = invoices.sparkSession.createDataFrame(wrows, "class int, term string, weight double")
    return weights, *_class_tables(pred)
