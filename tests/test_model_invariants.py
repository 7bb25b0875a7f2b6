"""Invariants for the rows-only model operators."""
import numpy as np
from pyspark.sql import functions as F


def _invoices(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rev = float(rng.gamma(2.0, 50.0))
        qty = int(rng.integers(1, 40))
        items = int(rng.integers(1, 10))
        dow = int(rng.integers(1, 8))
        month = int(rng.integers(1, 13))
        logit = -1.0 + 0.01 * rev - 0.02 * qty + 0.1 * items
        y = int(rng.random() < 1 / (1 + np.exp(-logit)))
        part = "uk_train" if i < 300 else ("uk_test" if i < 350 else "nouk_test")
        rows.append((part, f"{i}", y, rev, qty, items, dow, month))
    return spark.createDataFrame(rows, "part string, invoice_no string, is_peak_hour int, total_revenue double, "
                                       "total_qty long, num_items long, day_of_week int, month_num int")


def test_pca_shares_and_uncorrelated_scores(spark):
    from pyspark.ml.functions import vector_to_array

    from tillroll.operators.segments import RFM_FEATURES, customer_pca
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 3))
    data = np.column_stack([base, base[:, 0] + 0.1 * rng.normal(size=300), base[:, 1] * 2, rng.normal(size=300)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)],
                               "customer_id long, " + ", ".join(f"{c} double" for c in RFM_FEATURES))
    scores, variance, m = customer_pca(df)
    shares = [r["variance_share"] for r in variance.orderBy("pc").collect()]
    assert abs(sum(shares) - 1.0) < 1e-9 and shares == sorted(shares, reverse=True) and 1 <= m <= 6
    s = np.array([r[0] for r in scores.select(vector_to_array("scores")).collect()])
    cov = np.cov(s, rowvar=False)
    off = cov - np.diag(np.diag(cov))
    assert np.abs(off).max() < 1e-8 * np.abs(np.diag(cov)).max()


def test_logistic_gradient_is_zero_at_optimum(spark):
    from tillroll.operators.hours import LOGIT_FEATURES, peak_logistic
    inv = _invoices(spark)
    coefs, conf, err = peak_logistic(inv)
    est = {r["term"]: r["estimate"] for r in coefs.collect()}
    train = inv.where("part = 'uk_train'")
    eta = F.lit(est["intercept"])
    for f in LOGIT_FEATURES:
        eta = eta + F.lit(est[f]) * F.col(f).cast("double")
    resid = F.col("is_peak_hour") - 1 / (1 + F.exp(-eta))
    grad = train.agg(F.sum(resid).alias("g0"), *[F.sum(resid * F.col(f)).alias(f) for f in LOGIT_FEATURES]).first()
    scale = train.agg(*[F.sum(F.abs(F.col(f))).alias(f) for f in LOGIT_FEATURES]).first()
    assert abs(grad["g0"]) < 1e-4 * 300
    for f in LOGIT_FEATURES:
        assert abs(grad[f]) < 1e-4 * scale[f]
    # confusion cells sum to the number of scored rows per part
    n = {r["part"]: r["n"] for r in err.collect()}
    cells = {r["part"]: r["s"] for r in conf.groupBy("part").agg(F.sum("n").alias("s")).collect()}
    assert n == cells == {"uk_test": 50, "nouk_test": 50}


def test_lda_confusion_sums_to_n(spark):
    from tillroll.operators.hours import peak_lda
    weights, conf, err = peak_lda(_invoices(spark))
    assert conf.agg(F.sum("n")).first()[0] == 100
    assert weights.select("class").distinct().count() == 2


def test_permutation_importance_of_constant_feature_is_zero(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from tillroll.operators.evaluate import permutation_importance
    rng = np.random.default_rng(9)
    rows = [(float(a), 7.0, float(3 * a + rng.normal())) for a in rng.normal(size=400)]
    df = spark.createDataFrame(rows, "x double, c double, y double")
    asm = VectorAssembler(inputCols=["x", "c"], outputCol="features")
    model = RandomForestRegressor(numTrees=10, seed=1, labelCol="y").fit(asm.transform(df))

    squared = F.avg((F.col("y") - F.col("prediction")) ** 2)
    imp = {r.feature: r.increase for r in permutation_importance(
        lambda d: model.transform(asm.transform(d)), df, ["x", "c"], ["y"], squared, seed=3).collect()}
    assert abs(imp["c"]) < 1e-9          # zero up to summation order
    assert imp["x"] > 0.0


def test_product_months_shuffle_their_lines_once(spark, tmp_path):
    """Both levels of the distinct invoice count use one exchange of the lines; the counts are right."""
    from rows import lines

    from tillroll.operators.season import product_month
    raw = lines(spark, [(f"5363{i % 7}", f"1000{i % 3}", "CUP", 2, "1.50") for i in range(60)])
    out = product_month(raw)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(tuple(r)[4:] for r in out.collect()) == [(40, 1.5, 7)] * 3
