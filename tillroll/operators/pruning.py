"""Weakest-link pruning of a fitted classification tree (ML-5).

The tree is the table of its nodes. A node's risk is the weight it gets wrong
as a leaf; per inner node, (its risk - the risk of the leaves below) / (leaves
below - 1) is what a leaf of its branch is worth. The branch worth least is cut,
ties together, until only the root is left: one small aggregate per cut over the
table of (inner node, leaf below), which holds depth rows per leaf. A tree of
depth 5 has 63 nodes at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "id int, left int, right int, risk double, prediction double, stats array<double>, feature int, cuts array<double>, categories int"
PATH = "step int, complexity double, cp double, leaves int, relative_risk double, cut array<int>"


def saved_nodes(spark: SparkSession, stage_folder: str) -> DataFrame:
    """The nodes of a saved tree model; class weights stand in the node's statistics."""
    data = spark.read.parquet(f"{stage_folder.rstrip('/')}/data")
    return data.select(
        "id", F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        (F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x) - F.array_max("impurityStats")).alias("risk"),
        "prediction", F.col("impurityStats").alias("stats"), F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("cuts"), F.col("split.numCategories").alias("categories"))


def below(nodes: DataFrame, depth: int) -> DataFrame:
    """(id, under): every node with every node of its branch, itself included; ``depth`` joins."""
    edges = nodes.select("id", F.explode(F.array("left", "right")).alias("under")).where(F.col("under") >= 0)
    step = out = nodes.select("id", F.col("id").alias("under"))
    for _ in range(depth):
        step = step.join(edges.select(F.col("id").alias("under"), F.col("under").alias("next")), "under").select(
            "id", F.col("next").alias("under"))
        out = out.unionByName(step)
    return out


def _branches(pairs: DataFrame, cut: list[int]) -> DataFrame:
    """(id, risk, below_risk, n): the inner nodes left after the cuts, with the risk and number of the leaves below."""
    hidden = pairs.where(F.col("id").isin(cut) & (F.col("id") != F.col("under"))).select("under").distinct()
    seen = pairs.join(hidden, "under", "left_anti")
    inner = seen.where((F.col("id") == F.col("under")) & ~F.col("ends") & ~F.col("id").isin(cut)).select("id")
    leaves = seen.where(F.col("ends") | F.col("under").isin(cut)).join(inner, "id", "left_semi")
    return leaves.groupBy("id").agg(F.first("risk").alias("risk"), F.sum("under_risk").alias("below_risk"),
                                    F.count(F.lit(1)).alias("n"))


def pruning_path(nodes: DataFrame, depth: int, tolerance: float = 1e-9) -> DataFrame:
    """DF[step, complexity, cp, leaves, relative_risk, cut]: the nested trees from the full one (step 0) to the root.

    ``cp`` is the complexity in units of the root's risk; ``cut`` lists the
    nodes that became leaves in that step. A branch that gains nothing has cp 0."""
    under = nodes.select(F.col("id").alias("under"), F.col("risk").alias("under_risk"), (F.col("left") < 0).alias("ends"))
    pairs = below(nodes, depth).join(under, "under").join(nodes.select("id", "risk"), "id").persist()
    root_risk = float(nodes.where("id = 0").first().risk)
    unit, cut, worst, path = root_risk or 1.0, [], 0.0, []
    while True:
        left = _branches(pairs, cut).collect()  # fewer than 2 ** depth rows
        root = next((r for r in left if r.id == 0), None)
        leaves, risk = (root.n, root.below_risk) if root else (1, root_risk)
        gone = cut[sum(len(p[-1]) for p in path):]
        path.append((len(path), worst, worst / unit, leaves, risk / unit, gone))
        if not left:
            break
        worth = {r.id: (r.risk - r.below_risk) / (r.n - 1) for r in left}
        least = min(worth.values())
        worst = max(worst, least)
        cut = cut + sorted(i for i, w in worth.items() if w <= least + tolerance * unit)
    pairs.unpersist()
    return nodes.sparkSession.createDataFrame(path, PATH)


def pruned_nodes(nodes: DataFrame, path: DataFrame, cp: float) -> DataFrame:
    """The nodes with every node cut at a complexity up to ``cp`` made a leaf; nodes below it are not reached any more."""
    gone = path.where((F.col("step") > 0) & (F.col("cp") <= cp)).select(F.explode("cut").alias("id")).distinct().withColumn("gone", F.lit(True))
    marked = nodes.join(F.broadcast(gone), "id", "left")  # fewer rows than the tree has nodes
    return marked.select("id", *[F.when(F.col("gone"), F.lit(-1)).otherwise(F.col(c)).alias(c) for c in ("left", "right")],
                         *[c for c in nodes.columns if c not in ("id", "left", "right")])


def tree_columns(nodes: DataFrame, features: Sequence[str]) -> tuple[Column, Column]:
    """(predicted class, probability of class 1) as expressions over ``features``: the tree as nested CASEs."""
    table = {r.id: r for r in nodes.collect()}  # bounded by the depth

    def walk(i: int, leaf) -> Column:
        node = table[i]
        if node.left < 0:
            return F.lit(float(leaf(node)))
        x = F.col(features[node.feature])
        goes = x <= node.cuts[0] if node.categories < 0 else x.isin([float(v) for v in node.cuts])
        return F.when(goes, walk(node.left, leaf)).otherwise(walk(node.right, leaf))

    return walk(0, lambda n: n.prediction), walk(0, lambda n: n.stats[1] / (sum(n.stats) or 1.0))


def impurity_drop(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """ML-7: DF[feature, importance]: each feature's share of the Gini impurity that the tree's splits take away, in
    hundredths; 0 for a feature that no split of the tree uses."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    impurity = weight - F.try_divide(F.aggregate("stats", F.lit(0.0), lambda a, x: a + x * x), weight)
    tree = reached(nodes)
    own = tree.select("id", "left", "right", "feature", F.coalesce(impurity, F.lit(0.0)).alias("gini"))
    side = own.select(F.col("id").alias("child"), F.col("gini").alias("child_gini"))
    below_gini = (own.where("left >= 0").select("id", "feature", "gini", F.explode(F.array("left", "right")).alias("child"))
                  .join(side, "child").groupBy("id", "feature", "gini").agg(F.sum("child_gini").alias("below")))
    names = F.array(*[F.lit(c) for c in features])
    drops = below_gini.groupBy(F.element_at(names, F.col("feature") + 1).alias("feature")).agg(F.sum(F.col("gini") - F.col("below")).alias("drop"))
    every = nodes.sparkSession.range(1).select(F.explode(names).alias("feature")).join(drops, "feature", "left").na.fill(0.0)
    total = every.select(F.sum("drop")).scalar()
    return every.select("feature", F.coalesce(100 * F.try_divide(F.col("drop"), total), F.lit(0.0)).alias("importance"))


def reached(nodes: DataFrame) -> DataFrame:
    """The nodes that a row can come to: the root and the children of reached inner nodes."""
    table = {r.id: r for r in nodes.select("id", "left", "right").collect()}  # bounded by the depth
    todo, found = [0], []
    while todo:
        found.append(i := todo.pop())
        todo += [c for c in (table[i].left, table[i].right) if c >= 0]
    return nodes.where(F.col("id").isin(found))
