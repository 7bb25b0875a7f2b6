"""Product-month seasonality and bulk buying (AGG-21, FLT-9, FLT-10, ML-10..12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import ratio
from ..sources.io import materialize
from .demand import market
from .evaluate import hash_split, mse

PM_KEY = ("stock_code", "description", "month_num", "country")


def product_month(sales: DataFrame) -> DataFrame:
    """AGG-21 + FLT-10 + FLT-9: per (code, description, month number, country):
    total quantity, unweighted mean price, distinct invoices; TotalQty > 0 and
    no NULLs. Month numbers pool all years together, as the analysis does."""
    # The keys are nearly as many as the lines: combined map-side they would only fill (and spill) hash tables, and be shuffled
    # once per (key, invoice) and again per key. One shuffle of the lines serves both levels of the distinct count.
    pm = (sales.withColumn("month_num", F.month("invoice_date"))
               .select(*PM_KEY, "quantity", "price", "invoice_no").repartition(*PM_KEY)
               .groupBy(*PM_KEY)
               .agg(F.sum("quantity").cast("long").alias("total_qty"),
                    ratio(F.sum("price"), F.count("price")).alias("avg_price"),
                    F.countDistinct("invoice_no").alias("num_invoices")))
    return pm.where(F.col("total_qty") > 0).dropna()


def product_month_split(pm: DataFrame, share: float = S.TRAIN_SHARE, home: str = S.HOME_COUNTRY) -> DataFrame:
    """SPL-1 / SPL-3 / SET-4: uk_train / uk_test by key hash, foreign = nouk_test."""
    s = hash_split(pm, PM_KEY, share, "_train")
    return s.withColumn("part", F.when(market("country", home) != "UK", "nouk_test")
                                 .when(F.col("_train"), "uk_train").otherwise("uk_test")).drop("_train")


# ----------------------------------------------------------------------------- models
FEATURES = ("month_num", "avg_price", "num_invoices")


def bulk_forest(split: DataFrame, n_trees: int = S.BULK_FOREST_TREES, mtry: int = S.BULK_FOREST_MTRY,
                seed: int = 1, depth: int = S.FOREST_DEPTH, permutation: bool = True):
    """ML-10 / ML-7 / ML-8 / EVL-3: forest regression of monthly quantity on month,
    mean price and invoice count (``mtry`` features per split), trained on
    uk_train; MSE on uk_test and nouk_test; impurity importance and the MSE
    increase when one feature is permuted (on uk_test, as the spike forest).
    The trees are MLlib's (32 bins, 5 rows a leaf), grown from sums per cell, see ``forest``.
    Returns (mse DF[part, mse, n], importance DF[feature, impurity, mse_increase])."""
    from . import forest
    from .evaluate import permutation_importance

    train = split.where(F.col("part") == "uk_train")
    if train.isEmpty():
        raise ValueError("no training rows")
    cuts = forest.cut_points(train, FEATURES)
    trees = materialize(forest.fit_trees(train, "total_qty", cuts, PM_KEY, n_trees, mtry, depth, 5, seed), "bulk_trees")
    # a row per cell of the grid, bounded by forest.MAX_CELLS
    cells = F.broadcast(materialize(forest.cell_predictions(trees), "bulk_cells"))

    def score(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_cell", forest.cell(cuts)).join(cells, "_cell").drop("_cell")

    errors = mse(score(split.where(F.col("part") != "uk_train")), "total_qty", "prediction", ("part",))
    importance = forest.importance(trees, FEATURES)
    if not permutation:
        return errors, importance.withColumn("mse_increase", F.lit(None).cast("double"))
    squared = F.avg((F.col("total_qty").cast("double") - F.col("prediction")) ** 2)
    grown = permutation_importance(score, split.where(F.col("part") == "uk_test"), list(FEATURES), PM_KEY, squared, seed=seed)
    return errors, importance.join(grown.withColumnRenamed("increase", "mse_increase"), "feature", "left")


def _additive_design(df: DataFrame, specs) -> tuple[DataFrame, list[str]]:
    from .linear import spline_basis
    cols = []
    for name, (knots, m, s) in specs.items():
        cols += spline_basis(F.col(name), knots, m, s, name)
    out = df.select("*", *cols)
    return out, [c for c in out.columns if c not in df.columns]


def additive_model(split: DataFrame, dof: int = S.GAM_DF, features=FEATURES, n_knots: int = 8):
    """ML-11: additive model with one penalized cubic spline per feature.

    Each term is a truncated-power cubic spline with up to ``n_knots`` interior
    knots at quantiles, its knot coefficients ridge-penalized. The penalty of
    each term is bisected until the term's effective degrees of freedom
    (trace of its smoother, from its centred Gramian block) equal ``dof`` —
    the role of ``s(x, 4)``; then all terms are fitted jointly. Every number
    comes from one executor-side Gramian; only a p x p system is solved on the
    driver. Returns (coefficients DF[term, estimate, lambda], mse DF[part, mse, n]).
    """
    import numpy as np

    from . import linear as L
    train = split.where(F.col("part") == "uk_train")
    specs = {f: (sorted(set(knots)), m, sd) for f, (knots, m, sd) in L.knots_for_all(train, features, n_knots + 3).items()}
    design, names = _additive_design(split, specs)
    g = L.gramian(design.where(F.col("part") == "uk_train"), names, "total_qty")[None]
    xtx, xty, _, n = g
    p = len(names) + 1
    penalty = np.zeros((p, p))
    lambdas = {}
    col = 1
    # centred block per term: G_j - n * mean mean'
    means = xtx[0, 1:] / n
    for f in features:
        k = 3 + len(specs[f][0])
        idx = list(range(col, col + k))
        block = xtx[np.ix_(idx, idx)] - n * np.outer(means[[i - 1 for i in idx]], means[[i - 1 for i in idx]])
        pj = np.diag([0.0, 0.0, 0.0] + [1.0] * (k - 3))
        lam = L.lambda_for_df(block, pj, float(dof))
        lambdas[f] = lam
        penalty[np.ix_(idx, idx)] = lam * pj
        col += k
    beta = L.solve(xtx + penalty, xty)
    pred = design.withColumn("prediction", L.linear_column(beta, names))
    errors = mse(pred.where(F.col("part") != "uk_train"), "total_qty", "prediction", ("part",))
    term_lambda = {n_: lambdas.get(n_.rsplit("_", 1)[0].rsplit("_k", 1)[0], None) for n_ in names}
    rows = [("intercept", float(beta[0]), None)] + [
        (n_, float(b), term_lambda.get(n_)) for n_, b in zip(names, beta[1:])]
    coefs = split.sparkSession.createDataFrame(rows, "term string, estimate double, penalty double")
    return coefs, errors


def additive_model_df(split: DataFrame, dof: int = S.GAM_DF, features=FEATURES, n_knots: int = 8) -> DataFrame:
    """Effective degrees of freedom reached per term (invariant check for ML-11)."""
    import numpy as np

    from . import linear as L
    train = split.where(F.col("part") == "uk_train")
    rows = []
    for f, (knots, m, sd) in L.knots_for_all(train, features, n_knots + 3).items():
        knots = sorted(set(knots))
        design, names = _additive_design(train, {f: (knots, m, sd)})
        xtx, _, _, n = L.gramian(design, names, "total_qty")[None]
        mean = xtx[0, 1:] / n
        block = xtx[1:, 1:] - n * np.outer(mean, mean)
        pj = np.diag([0.0, 0.0, 0.0] + [1.0] * (len(names) - 3))
        lam = L.lambda_for_df(block, pj, float(dof))
        rows.append((f, len(knots), lam, L.effective_df(block, pj, lam)))
    return split.sparkSession.createDataFrame(rows, "feature string, knots int, penalty double, effective_df double")


def spline_cv(split: DataFrame, dofs=S.SPLINE_DFS, folds: int = S.SPLINE_FOLDS, feature: str = "month_num"):
    """ML-12: k-fold CV error of a regression spline of month for each df.

    The feature is a calendar month, so (fold, month) with the number of rows,
    the sum and the sum of squares of the quantity says all that a fit and its
    held-out error need: one aggregate of 60 rows feeds every df and fold. The
    leave-one-fold-out fit is total minus fold. Knots come from all training
    rows. Month has 12 distinct values: coinciding knots make collinear columns,
    solved by minimum-norm least squares. Returns DF[dof, cv_mse, is_best]."""
    import numpy as np

    from . import linear as L
    y = F.col("total_qty").cast("double")
    cells = (split.where((F.col("part") == "uk_train") & F.col(feature).isNotNull() & y.isNotNull())
             .groupBy(F.pmod(F.xxhash64(*PM_KEY), F.lit(folds)).alias("fold"), F.col(feature).alias("x"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("ss")).collect())  # folds x months
    fold, x, n, s, ss = (np.array([r[c] for r in cells], float) for c in ("fold", "x", "n", "s", "ss"))
    rows = []
    for d in dofs:
        knots, m, sd = L.knots_of(x, n, d)
        design = np.column_stack([np.ones(len(x)), L.spline_values(x, knots, m, sd)])
        error = 0.0
        for k in np.unique(fold):
            fit, held = fold != k, fold == k
            beta = L.solve((design[fit].T * n[fit]) @ design[fit], design[fit].T @ s[fit])
            p = design[held] @ beta
            error += float((ss[held] - 2 * p * s[held] + n[held] * p * p).sum())
        rows.append((int(d), error / max(float(n.sum()), 1.0)))
    best = min(rows, key=lambda r: r[1])[0]
    return split.sparkSession.createDataFrame([(d, e, d == best) for d, e in rows],
                                              "dof int, cv_mse double, is_best boolean")
