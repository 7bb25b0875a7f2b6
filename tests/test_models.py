import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tillroll.operators import linear as L
from tillroll.operators.evaluate import hash_split, share_threshold, stratified_split
from tillroll.operators.segments import assign_clusters, kmeans_sweep, total_ss


def _points(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [6, 6], [0, 8]])
    pts = centers[rng.integers(0, 3, n)] + rng.normal(size=(n, 2))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("customer_id", LongType()), StructField("features", VectorUDT())])
    return spark.createDataFrame([(i, Vectors.dense(p.tolist())) for i, p in enumerate(pts)], schema)


def test_kmeans_ss_decomposition(spark):
    pts = _points(spark)
    table, models = kmeans_sweep(pts, ks=(2, 3, 4), n_start=5)
    rows = {r["k"]: r for r in table.collect()}
    tot = total_ss(pts)
    x = np.array([r["features"].toArray() for r in pts.collect()])
    assert abs(((x - x.mean(0)) ** 2).sum() - tot) < 1e-6 * tot
    for k, model in models.items():
        d2 = ((x[:, None, :] - np.array(model.clusterCenters())[None]) ** 2).sum(2)
        assert rows[k]["converged"]
        assert abs(d2.min(1).sum() - rows[k]["within_ss"]) < 1e-5 * tot
        labels = [r["cluster"] for r in assign_clusters(pts, model).orderBy("customer_id").collect()]
        assert labels == d2.argmin(1).tolist()
    for r in rows.values():
        assert abs(r["within_ss"] + r["between_ss"] - tot) < 1e-6 * tot
    assert rows[2]["within_ss"] > rows[3]["within_ss"] >= rows[4]["within_ss"] * 0.999


def test_gramian_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 1 + 2 * x[:, 0] - 3 * x[:, 1] + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    g = L.gramian(df, ["a", "b"], "y")[None]
    beta = L.solve(g[0], g[1])
    ref = np.linalg.lstsq(np.column_stack([np.ones(200), x]), y, rcond=None)[0]
    assert np.allclose(beta, ref)


def test_splits_are_deterministic_and_complementary(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    a = hash_split(df, ["k"]).where("is_train").count()
    assert share_threshold(0.8) == "cccd"
    assert 1500 < a < 1700
    s = stratified_split(df.withColumn("lab", (F.col("id") % 3 == 0).cast("string")), "lab", ["k"])
    per = {r["lab"]: (r["t"], r["n"]) for r in s.groupBy("lab").agg(F.count_if("is_train").alias("t"),
                                                                     F.count(F.lit(1)).alias("n")).collect()}
    for t, n in per.values():
        assert t == -(-n * 8 // 10)


def test_penalty_bisection_hits_target_df():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6))
    g = x.T @ x
    pen = np.diag([0, 0, 0, 1, 1, 1.0])
    lam = L.lambda_for_df(g, pen, 4.0)
    assert abs(L.effective_df(g, pen, lam) - 4.0) < 1e-6


def test_feature_kinds_are_named_not_counted(spark):
    from pyspark.ml import Pipeline
    from tillroll.operators.demand import MODEL_COLUMNS
    from tillroll.operators.spike_models import _feature_stages, _typed

    def kinds(distinct):
        df = spark.createDataFrame([tuple(float(i % distinct) for _ in MODEL_COLUMNS) for i in range(40)],
                                   [f"f_{c}" for c in MODEL_COLUMNS])
        out = Pipeline(stages=_feature_stages()).fit(_typed(df)).transform(_typed(df))
        return {a["name"] for a in out.schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])}
    assert kinds(2) == kinds(30) == {"f_quarter", "f_is_weekend"}


def test_spike_queries_fit_the_workflows_rounds_and_full_depth(spark):
    import inspect

    from tillroll import schema as S
    from tillroll.operators import season, spike_models
    how = inspect.signature(spike_models.SpikeModels).parameters
    assert how["boost_rounds"].default == S.BOOST_TREES == 1000 and how["forest_trees"].default == S.SPIKE_FOREST_TREES == 500
    assert how["boost_folds"].default == 5 and how["cp"].default == 0.001
    assert all(inspect.signature(f).parameters["depth"].default == 30 for f in (spike_models.fit_forest, season.bulk_forest))


def test_spline_cv_equals_direct_fits(spark):
    """Against least squares on the rows themselves, fold by fold."""
    from tillroll.operators.season import PM_KEY, spline_cv
    rng = np.random.default_rng(4)
    rows = [("uk_train" if i % 5 else "uk_test", f"c{i}", "d", int(rng.integers(1, 13)), "United Kingdom", int(rng.integers(1, 200))) for i in range(400)]
    df = spark.createDataFrame(rows, "part string, stock_code string, description string, month_num int, country string, total_qty long")
    got = {r.dof: r for r in spline_cv(df).collect()}
    train = df.where("part = 'uk_train'").withColumn("_fold", F.pmod(F.xxhash64(*PM_KEY), F.lit(5))).collect()
    x, y, fold = (np.array([r[c] for r in train], float) for c in ("month_num", "total_qty", "_fold"))
    for d in (3, 5, 11):
        knots, m, s = L.knots_for(df.where("part = 'uk_train'"), "month_num", d)
        assert np.allclose(knots, np.quantile(x, np.arange(1, d - 2) / (d - 2)) if d > 3 else [])
        design = np.column_stack([np.ones(len(x)), L.spline_values(x, knots, m, s)])
        error = 0.0
        for k in range(5):
            beta = np.linalg.lstsq(design[fold != k], y[fold != k], rcond=None)[0]
            error += ((y[fold == k] - design[fold == k] @ beta) ** 2).sum()
        assert abs(got[d].cv_mse - error / len(x)) < 1e-8 * max(1.0, error / len(x))
    assert [r.is_best for r in got.values()].count(True) == 1


def test_additive_model_matches_penalised_least_squares(spark):
    from tillroll.operators.season import FEATURES, additive_model, additive_model_df
    rng = np.random.default_rng(5)
    part = np.array(["uk_train"] * 300 + ["uk_test"] * 60)
    x = np.column_stack([rng.integers(1, 13, 360), rng.gamma(2.0, 3.0, 360), rng.integers(1, 30, 360)]).astype(float)
    y = np.round(20 + 5 * np.sin(x[:, 0]) + 3 * x[:, 2] + rng.normal(size=360))
    df = spark.createDataFrame([(str(p), int(a), float(b), int(c), int(t)) for p, (a, b, c), t in zip(part, x, y)],
                               "part string, month_num int, avg_price double, num_invoices int, total_qty long")
    coefs, errors = additive_model(df)
    rows = coefs.collect()
    train, blocks, ridge = part == "uk_train", [np.ones(360)], [0.0]
    for j, f in enumerate(FEATURES):
        knots, m, s = L.knots_for(df.where("part = 'uk_train'"), f, 11)
        own = L.spline_values(x[:, j], sorted(set(knots)), m, s)
        lam = next(r.penalty for r in rows if r.term == f"{f}_1")
        blocks += list(own.T)
        ridge += [0.0] * 3 + [lam] * (own.shape[1] - 3)
    design = np.column_stack(blocks)
    beta = np.linalg.solve(design[train].T @ design[train] + np.diag(ridge), design[train].T @ y[train])
    held = float(((y[~train] - design[~train] @ beta) ** 2).mean())
    got = errors.collect()
    assert [(r.part, r.n) for r in got] == [("uk_test", 60)] and abs(got[0].mse - held) < 1e-6 * held
    assert all(abs(r.effective_df - 4.0) < 1e-6 for r in additive_model_df(df).collect())


def test_kmeans_starts_share_their_passes(spark):
    """20 starts of three K take a job per round, not per start and round, and end where MLlib's own fits end."""
    from pyspark.ml.clustering import KMeans

    from tillroll.operators.segments import kmeans_many
    rng = np.random.default_rng(8)
    data = np.concatenate([rng.normal(c, 0.6, size=(60, 2)) for c in ((0, 0), (3, 0), (0, 3), (3, 3))])
    pts = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(data)], ["customer_id", "features"]).repartition(3).persist()
    sc = spark.sparkContext
    tracked = sc.statusTracker()
    sc.setJobGroup("kmeans", "kmeans")
    fits = kmeans_many(pts, (2, 3, 4), n_start=6, parallelism=1)
    jobs = len(tracked.getJobIdsForGroup("kmeans"))
    sc.setJobGroup("other", "other")
    for k, fit in fits.items():
        whole = [KMeans(k=k, initMode="random", seed=197000 + i, maxIter=200, tol=1e-4).fit(pts).summary for i in range(6)]
        assert abs(fit.summary.trainingCost - min(m.trainingCost for m in whole)) < 1e-6
        if k == 4:
            alone = sum(m.numIter for m in whole)
    drawn = 18 * 6  # jobs that draw the starts, at most
    assert jobs <= drawn + 60 and alone > 6
    near = ((data[:, None, :] - np.array(fits[4].clusterCenters())[None]) ** 2).sum(2).argmin(1)
    assert [r.cluster for r in fits[4].transform(pts).orderBy("customer_id").collect()] == near.tolist()


def test_bulk_forest_is_mllibs_forest_whatever_the_partitions(spark):
    """The error of MLlib's trees on the same rows, each tree's sums right, and one result for all orders and partitions."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from tillroll.operators import forest
    from tillroll.operators.season import FEATURES, PM_KEY, bulk_forest
    rng = np.random.default_rng(6)
    rows = [(p, f"c{i}", "d", "UK", int(a), float(b), int(c), int(30 + 8 * a + 5 * c + b + rng.integers(0, 20)))
            for i, (p, a, b, c) in enumerate(zip(np.repeat(["uk_train", "uk_test", "nouk_test"], (3000, 600, 300)), rng.integers(1, 13, 3900),
                                                  rng.gamma(2.0, 3.0, 3900), rng.geometric(0.3, 3900)))]
    df = spark.createDataFrame(rows, "part string, stock_code string, description string, country string, month_num int, "
                                     "avg_price double, num_invoices int, total_qty long")
    some = [bulk_forest(d, n_trees=20) for d in (df.repartition(7, "total_qty"), df.coalesce(1))]
    (errors, weights), again = [[{r[0]: r[1:] for r in t.collect()} for t in x] for x in some]
    for a, b in ((errors, again[0]), (weights, again[1])):
        assert all(np.allclose(a[k], b[k], rtol=1e-9) for k in a | b)
    wide = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)
    model = RandomForestRegressor(numTrees=20, featureSubsetStrategy="2", maxDepth=30, minInstancesPerNode=5, seed=1,
                                  labelCol="total_qty").fit(wide.where("part = 'uk_train'"))
    theirs = {r.part: r.mse for r in model.transform(wide).groupBy("part").agg(F.avg((F.col("total_qty") - F.col("prediction")) ** 2).alias("mse")).collect()}
    assert all(abs(errors[p][0] - theirs[p]) < 0.08 * theirs[p] for p in ("uk_test", "nouk_test")), (errors, theirs)
    shares = 100 * model.featureImportances.toArray()
    assert all(abs(weights[f][0] - v) < 4 for f, v in zip(FEATURES, shares)) and all(weights[f][1] > 0 for f in FEATURES)
    train = df.where("part = 'uk_train'")
    cuts = forest.cut_points(train, FEATURES)
    assert cuts["month_num"] == [m + 0.5 for m in range(1, 12)] and len(cuts["avg_price"]) == 31
    n_cells = int(np.prod([len(c) + 1 for c in cuts.values()]))
    bag = forest.bagged_cells(train.select(forest.cell(cuts).alias("_cell"), F.col("total_qty").cast("double").alias("_y"),
                                           F.xxhash64(*PM_KEY, F.lit(1)).alias("_h")), 20, n_cells).collect()
    drawn = np.bincount([r.tree for r in bag], [sum(r.rows) for r in bag])
    assert len(drawn) == 20 and np.all(np.abs(drawn - 3000) < 5 * 3000 ** 0.5) and len(set(drawn)) > 5


def test_tree_of_cells_takes_the_best_cut():
    from tillroll.operators.forest import grow
    n, y = np.full((4, 3), 10.0), np.array([[1, 1, 5], [1, 1, 5], [9, 9, 9], [9, 9, 9]], float)
    found, drop = grow(n, n * y, 2, 30, 5, np.random.default_rng(0))
    assert np.allclose(found, y) and abs(drop.sum() - (n * (y - y.mean()) ** 2).sum()) < 1e-9 and np.all(drop > 0)
    found, _ = grow(n, n * y, 2, 30, 70, np.random.default_rng(0))  # no cut leaves 70 rows on both sides
    assert np.allclose(found, y.mean())


def test_spike_models_score_their_days_in_one_task(spark):
    """A task a cached partition loaded the forest hundreds of times for a few thousand rows."""
    from pyspark.sql import functions as F

    from tillroll.operators.spike_models import FEATURES, FOREST, SpikeModels
    days = spark.range(120).select(
        F.when(F.col("id") % 3 > 0, "train").when(F.col("id") % 2 > 0, "uk_test").otherwise("nouk_test").alias("part"),
        F.expr("date_add(date '2011-01-01', cast(id as int))").alias("date"), F.lit(1).alias("week_of_the_year"),
        F.when(F.col("id") % 5 > 2, "High").otherwise("Normal").alias("next_day_spike"), (F.col("id") % 5 > 2).cast("double").alias("label"),
        *[(F.col("id") % (2 + i % 7) % (2 if f == "f_is_weekend" else 5)).cast("double").alias(f) for i, f in enumerate(FEATURES)])
    models = SpikeModels(days.repartition(16), forest_trees=3)
    tests = days.where("part <> 'train'")
    scored = models.scored(FOREST).select("date", "part", "p_high", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in scored}) == 1
    assert {(r.date, r.part) for r in scored} == {(r.date, r.part) for r in tests.collect()} and len(scored) == 40
