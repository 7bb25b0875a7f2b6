import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import boosting, pruning
from tillroll.operators.evaluate import classification_metrics, confusion, mse, permutation_importance
from tillroll.sources import models

FEATURES = ("a", "b", "c")


def _rows(spark, n=500, seed=4):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rnd.normal(scale=0.4, size=n) > 0.4).astype(float)
    return spark.createDataFrame([(f"d{i:04}", float(p), float(q), 3.0, float(t)) for i, ((p, q), t) in enumerate(zip(x, y))],
                                 "date string, a double, b double, c double, label double")


# ------------------------------------------------------------------------------- pruning
#          0 (R 40)
#    1 (R 16)      2 (R 20)
#  3(6)  4(8)    5(10)  6 (R 8)
#                      7(4)  8(4)
TREE = [(0, 1, 2, 40.0), (1, 3, 4, 16.0), (2, 5, 6, 20.0), (3, -1, -1, 6.0), (4, -1, -1, 8.0), (5, -1, -1, 10.0), (6, 7, 8, 8.0),
        (7, -1, -1, 4.0), (8, -1, -1, 4.0)]


def _brute_path(tree):
    """[(complexity, leaves, risk)] of weakest-link pruning, by walking the tree."""
    kids = {i: (a, b) for i, a, b, _ in tree if a >= 0}
    risk = {i: r for i, _, _, r in tree}

    def leaves(i):
        return [i] if i not in kids else [x for c in kids[i] for x in leaves(c)]

    out, worst = [(0.0, len(leaves(0)), sum(risk[x] for x in leaves(0)))], 0.0
    while 0 in kids:
        seen = [i for i in kids if i == 0 or any(i in kids[j] for j in kids)]
        reach, todo = set(), [0]
        while todo:
            i = todo.pop()
            reach.add(i)
            todo += kids.get(i, ())
        worth = {i: (risk[i] - sum(risk[x] for x in leaves(i))) / (len(leaves(i)) - 1) for i in seen if i in reach}
        worst = max(worst, min(worth.values()))
        for i in [i for i, w in worth.items() if w <= min(worth.values()) + 1e-9]:
            kids.pop(i, None)
        out.append((worst, len(leaves(0)), sum(risk[x] for x in leaves(0))))
    return out


def _nodes(spark, tree):
    rows = [(i, a, b, r, float(i % 2), [r, 2 * r], 0 if a >= 0 else -1, [float(i)], -1) for i, a, b, r in tree]
    return spark.createDataFrame(rows, pruning.NODES)


def _random_tree(seed):
    rnd = np.random.default_rng(seed)
    tree, todo, last = {}, [(0, 0, 64.0)], 0
    while todo:
        i, depth, r = todo.pop()
        if depth == 4 or (depth and rnd.random() < 0.3):
            tree[i] = (i, -1, -1, r)
            continue
        a, b, last = last + 1, last + 2, last + 2
        tree[i] = (i, a, b, r)
        share = float(rnd.choice([0.5, 0.75, 1.0]))
        split = float(rnd.choice([0.25, 0.5]))
        todo += [(a, depth + 1, r * share * split), (b, depth + 1, r * share * (1 - split))]
    return [tree[i] for i in sorted(tree)]


@pytest.mark.parametrize("tree", [TREE, TREE[3:4] and [(0, -1, -1, 5.0)], _random_tree(1), _random_tree(2)])
def test_pruning_path_matches_a_walk(spark, tree):
    path = pruning.pruning_path(_nodes(spark, tree), 5).orderBy("step").collect()
    want = _brute_path(tree)
    root = tree[0][3]
    assert [(round(r.complexity, 9), r.leaves, round(r.relative_risk * root, 9)) for r in path] == [
        (round(c, 9), n, round(x, 9)) for c, n, x in want]
    assert all(abs(r.cp * root - r.complexity) < 1e-9 for r in path)


def test_pruned_tree_scores_rows_like_its_nodes(spark):
    nodes = _nodes(spark, TREE)
    path = pruning.pruning_path(nodes, 5)
    label, p = pruning.tree_columns(pruning.pruned_nodes(nodes, path, 0.0), ["x"])  # node 6 gains nothing
    out = spark.createDataFrame([(float(v),) for v in (-1, 0.5, 1.5, 5.5, 7)], "x double").select("x", label.alias("y"), p.alias("p"))
    got = {r.x: r.y for r in out.collect()}
    # root: x <= 0 goes left; node 1: x <= 1; node 2: x <= 2 goes to 5, else 6, a leaf now
    assert got == {-1.0: 1.0, 0.5: 1.0, 1.5: 1.0, 5.5: 0.0, 7.0: 0.0}
    assert {i for r in path.where("cp <= 0").collect() for i in r.cut} == {6}
    assert {r.id for r in pruning.reached(pruning.pruned_nodes(nodes, path, 0.0)).collect()} == set(range(7))


def test_fitted_tree_nodes_come_back_from_the_store(spark):
    from pyspark.ml.functions import vector_to_array

    from tillroll.operators.spike_models import FEATURES as NAMES
    from tillroll.operators.spike_models import fit_tree
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(400, len(NAMES)))
    x[:, 2], x[:, 3] = rnd.integers(1, 5, 400), rnd.integers(0, 2, 400)
    y = (x[:, 0] + x[:, 5] * (x[:, 2] == 2) > 0.2).astype(float)
    train = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], [*NAMES, "label"])
    model, path = models.stored_pipeline(spark, "test-tree", models.fingerprint(train), lambda: fit_tree(train))
    from tillroll.operators.spike_models import _typed, saved_stage
    nodes = pruning.saved_nodes(spark, saved_stage(spark, path))
    label, p = pruning.tree_columns(nodes, NAMES)
    both = model.transform(_typed(train)).select("prediction", vector_to_array("probability")[1].alias("q"), label.alias("y"), p.alias("p"))
    assert both.where("prediction <> y OR abs(p - q) > 1e-9").count() == 0
    drop = {r.feature: r.importance for r in pruning.impurity_drop(nodes, NAMES).collect()}
    assert abs(sum(drop.values()) - 100) < 1e-6 and max(drop, key=drop.get) == NAMES[0]
    own = dict(zip(NAMES, model.stages[-1].featureImportances.toArray()))
    assert all(abs(drop[f] / 100 - own[f]) < 1e-6 for f in NAMES)


# ------------------------------------------------------------------------------ boosting
def test_boosting_learns_and_does_not_depend_on_partitions(spark):
    rows = _rows(spark)
    fit = lambda df: boosting.boost(df, FEATURES, "label", "date", 120, 0.1, folds=3)
    trees = fit(rows.repartition(5)).persist()
    again = fit(rows.orderBy(F.col("date").desc()).coalesce(1))
    key = lambda df: sorted(str(r) for r in df.collect())
    assert key(trees) == key(again)
    loss = [r.cv_loss for r in boosting.cv_loss(trees).orderBy("round").collect()]
    best = boosting.best_round(trees)
    assert len(loss) == 121 and loss[best] == min(loss[1:]) < 0.7 * loss[0]
    scored = boosting.probability(rows, trees, FEATURES, best).collect()
    assert sum((r.p_high > 0.5) == (r.label == 1.0) for r in scored) > 0.9 * len(scored)
    share = {r.feature: r.importance for r in boosting.relative_influence(trees, FEATURES, best).collect()}
    assert share["c"] == 0.0 and share["a"] > share["b"] > 0 and abs(sum(share.values()) - 100) < 1e-9


def test_a_boosted_round_matches_brute_force():
    """One round without bagging: the split search against all cuts, the leaf values against a Newton step."""
    rnd = np.random.default_rng(8)
    x = np.column_stack([rnd.integers(0, 9, 80), rnd.normal(size=80)]).astype(float)
    z = rnd.normal(size=80)
    data = boosting._Binned(x)
    gain, f, b = data.split(np.arange(80), z, 5)
    best = (0.0, None, None)
    for j in range(2):
        values = np.unique(x[:, j])
        for t in (values[1:] + values[:-1]) / 2:
            left = x[:, j] < t
            if 5 <= left.sum() <= 75:
                g = left.sum() * (~left).sum() / 80 * (z[left].mean() - z[~left].mean()) ** 2
                best = max(best, (g, j, t), key=lambda v: v[0])
    assert abs(gain - best[0]) < 1e-9 and (f, data.edges[f][b]) == best[1:]
    feature, threshold, child, gains, leaf = boosting._tree(data, np.arange(80), z, 2, 5)
    assert len(feature) == 2 and (boosting.leaves(x, feature, threshold, child) == leaf).all() and set(leaf) == {0, 1, 2}


def test_boosting_on_one_class_and_few_rows(spark):
    rows = _rows(spark, 30).withColumn("label", F.lit(1.0))
    trees = boosting.boost(rows, FEATURES, "label", "date", 5, 0.1, folds=2)
    assert all(r.p_high > 0.99 for r in boosting.probability(rows, trees, FEATURES, boosting.best_round(trees)).collect())


# --------------------------------------------------------------------------------- store
def test_store_fits_once_per_rows_and_parameters(spark):
    rows = _rows(spark, 60)
    made = []

    def save(path):
        made.append(path)
        spark.range(3).write.parquet(path)

    key = models.fingerprint(rows, rounds=7)
    first = models.stored(spark, "test-store", key, save)
    assert models.stored(spark, "test-store", models.fingerprint(rows.repartition(4).orderBy("b"), rounds=7), save) == first and len(made) == 1
    assert models.fingerprint(rows, rounds=8) != key != models.fingerprint(rows.limit(59), rounds=7)
    assert models.fingerprint(rows.limit(0)) != key
    models.stored(spark, "test-store", models.fingerprint(rows, rounds=8), save)
    assert len(made) == 2


# --------------------------------------------------------------------------- permutation
def test_permutation_importance_is_fixed_by_rows_and_seed(spark):
    rows = _rows(spark)
    right = F.avg((F.when(F.col("a") + 0.5 * F.col("b") ** 2 > 0.4, 1.0).otherwise(0.0) != F.col("label")).cast("double"))
    run = lambda df, **how: {r.feature: r.increase for r in permutation_importance(
        lambda d: d, df, FEATURES, ("date",), right, **how).collect()}
    one, two = run(rows.repartition(6), bucket_rows=100), run(rows.coalesce(1), bucket_rows=100)
    assert one == two and one["c"] == 0.0 and one["a"] > 0.1 and one["b"] > 0.0
    assert run(rows, bucket_rows=100, seed=9) != one


def test_permuted_columns_keep_their_values(spark):
    from tillroll.operators.evaluate import permuted
    rows = _rows(spark, 200)
    out = permuted(rows, ("a", "b"), ("date",), bucket_rows=50).collect()
    plain = {r.date: r for r in rows.collect()}
    assert len(out) == 600
    for copy in (None, "a", "b"):
        own = [r for r in out if r.feature == copy]
        for c in ("a", "b"):
            assert sorted(r[c] for r in own) == sorted(r[c] for r in plain.values())
            assert all(r[c] == plain[r.date][c] for r in own) == (c != copy)


# ----------------------------------------------------------------------------- evaluation
def test_metrics_on_given_predictions(spark):
    rows = [("m", "High", "High", 0.9), ("m", "High", "Normal", 0.6), ("m", "Normal", "Normal", 0.2), ("k", "Normal", "High", 0.1)]
    df = spark.createDataFrame(rows, "model string, p string, y string, q double")
    got = {r.model: r for r in classification_metrics(df, "p", "y", by=("model",), probability="q").collect()}
    assert (got["m"].accuracy, got["m"].precision, got["m"].recall) == (2 / 3, 0.5, 1.0) and got["k"].precision is None and got["k"].recall == 0.0
    assert abs(got["m"].brier - (0.01 + 0.36 + 0.04) / 3) < 1e-12
    assert {(r.predicted, r.actual): r.n for r in confusion(df, "p", "y").collect()} == {
        ("High", "High"): 1, ("High", "Normal"): 1, ("Normal", "Normal"): 1, ("Normal", "High"): 1}
    assert mse(spark.createDataFrame([(1.0, 3.0), (2.0, 2.0)], "y double, p double"), "y", "p").first().mse == 2.0
