"""Next-day spike classifiers (ENC-1, SPL-2, ML-5..9, EVL-1..4, AGG-27).

Inputs are the daily feature rows of ``demand.demand_features`` (one row per
market and trading day, bounded by the calendar). Training uses the home
market; the test sets are a stratified 20% of home days and all foreign days.
Each model is fitted by itself, once per training table and parameters, and
kept in the model store: a result fits only the models that it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.models import fingerprint, stored_pipeline, stored_table
from . import boosting, pruning
from .demand import MODEL_COLUMNS
from .evaluate import classification_metrics, confusion, impurity_importance, permutation_importance, stratified_split

FEATURES = tuple(f"f_{c}" for c in MODEL_COLUMNS)
TREE, FOREST, BOOSTING = "Decision Tree", "Random Forest", "Boosting (GBM)"
MODELS = (TREE, FOREST, BOOSTING)


def encode(features: DataFrame) -> DataFrame:
    """ENC-1: ordered factors as their integer codes, weekend as 0/1, label
    High = 1.0, and the cost weight (true Normal rows weigh 3, see ML-5)."""
    return features.select(
        "market", "date", "next_day_spike", "demand_spike", "total_revenue", "week_of_the_year",
        *[F.col(c).cast("double").alias(f"f_{c}") for c in MODEL_COLUMNS],
        (F.col("next_day_spike") == "High").cast("double").alias("label"))


def spike_sets(features: DataFrame, share: float = S.TRAIN_SHARE) -> DataFrame:
    """SPL-2 / SPL-3: 'train' / 'uk_test' stratified by label on home days,
    'nouk_test' for every foreign day."""
    enc = encode(features)
    uk = stratified_split(enc.where(F.col("market") == "UK"), "next_day_spike", ["date"], share)
    uk = uk.withColumn("part", F.when(F.col("is_train"), "train").otherwise("uk_test")).drop("is_train")
    return uk.unionByName(enc.where(F.col("market") == "Non-UK").withColumn("part", F.lit("nouk_test")))


#: Features split as categories, with the levels their codes can take (from 0); all others are numbers.
CATEGORICAL = {"quarter": 5, "is_weekend": 2}


def _typed(df: DataFrame) -> DataFrame:
    """Mark the categorical features by name: their kind does not depend on the values a table happens to hold."""
    for c, levels in CATEGORICAL.items():
        df = df.withMetadata(f"f_{c}", {"ml_attr": {"type": "nominal", "num_vals": levels}})
    return df


def _feature_stages():
    from pyspark.ml.feature import VectorAssembler
    return [VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")]


def fit_tree(train: DataFrame, depth: int = S.SPIKE_TREE_DEPTH, min_split: int = S.SPIKE_TREE_MIN_SPLIT,
             cost_normal_as_high: float = S.SPIKE_COST_NORMAL_AS_HIGH,
             cost_high_as_normal: float = S.SPIKE_COST_HIGH_AS_NORMAL, seed: int = 193):
    """ML-5: depth-limited tree; the loss matrix becomes class weights (true
    Normal rows weigh cost_normal_as_high / cost_high_as_normal), the minimum
    split size becomes a minimum of min_split/3 rows per child (rpart's
    minbucket default). It is pruned by its complexity afterwards, see ``pruned_tree``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    w = F.when(F.col("label") == 0.0, F.lit(cost_normal_as_high / cost_high_as_normal)).otherwise(F.lit(1.0))
    clf = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=max(1, round(min_split / 3)),
                                 weightCol="weight", seed=seed)
    return Pipeline(stages=_feature_stages() + [clf]).fit(_typed(train).withColumn("weight", w))


def fit_forest(train: DataFrame, n_trees: int = S.SPIKE_FOREST_TREES, depth: int = S.FOREST_DEPTH, seed: int = 194):
    """ML-6: random forest (R grows trees to purity, MLlib at most to a depth of 30)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    clf = RandomForestClassifier(numTrees=n_trees, maxDepth=depth, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=_feature_stages() + [clf]).fit(_typed(train))


def saved_stage(spark, path: str) -> str:
    """The folder of the saved pipeline's stage that has data of its own: its tree model."""
    found = spark.read.parquet(f"{path}/stages/*/data").select("_metadata.file_path").first()
    return found.file_path.rsplit("/data/", 1)[0]


class SpikeModels:
    """The three models of one set of training rows, each fitted or loaded when first asked for."""

    def __init__(self, sets: DataFrame, forest_trees: int = S.SPIKE_FOREST_TREES, boost_rounds: int = S.BOOST_TREES,
                 boost_folds: int = S.BOOST_FOLDS, cp: float = S.SPIKE_TREE_CP, cuts: tuple[float, ...] = S.BOOST_CUTS):
        self.spark, self.cp, self.cuts = sets.sparkSession, cp, cuts
        self.forest_trees, self.boost_rounds, self.boost_folds = forest_trees, boost_rounds, boost_folds
        self.train = sets.where(F.col("part") == "train").select("date", "label", *FEATURES)
        # a row per market and trading day: split into more tasks, each would only load the models again
        self.tests = sets.where(F.col("part") != "train").coalesce(1)
        self._made: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def key(self, name: str, **params) -> str:
        rows = self._once("rows", lambda: fingerprint(self.train))
        return f"{rows[:16]}-" + "-".join(f"{k}{v}" for k, v in sorted(params.items()))

    # ------------------------------------------------------------------ tree
    def tree_nodes(self) -> DataFrame:
        """ML-5: the fitted tree's nodes, before pruning."""
        def make():
            _, path = stored_pipeline(self.spark, "spike-tree", self.key("tree"), lambda: fit_tree(self.train.coalesce(1)))
            return pruning.saved_nodes(self.spark, saved_stage(self.spark, path)).persist()
        return self._once("nodes", make)

    def pruning_path(self) -> DataFrame:
        """ML-5: the nested trees of weakest-link pruning."""
        return self._once("path", lambda: pruning.pruning_path(self.tree_nodes(), S.SPIKE_TREE_DEPTH).persist())

    def pruned_tree(self) -> DataFrame:
        """ML-5: the tree at complexity ``cp``."""
        return pruning.pruned_nodes(self.tree_nodes(), self.pruning_path(), self.cp)

    # ---------------------------------------------------------------- forest
    def forest(self):
        return self._once("forest", lambda: stored_pipeline(
            self.spark, "spike-forest", self.key("forest", trees=self.forest_trees),
            lambda: fit_forest(self.train.coalesce(1), self.forest_trees))[0])  # a row per home day

    def forest_permutation(self, part: str = "uk_test") -> DataFrame:
        """ML-8: DF[feature, accuracy_drop] of the forest on a test set (MLlib keeps no out-of-bag rows)."""
        rows = self.tests.where(F.col("part") == part).select("date", "label", *FEATURES)
        wrong = F.avg((F.col("prediction") != F.col("label")).cast("double"))
        out = permutation_importance(lambda d: self.forest().transform(_typed(d)), rows, FEATURES, ("date",), wrong, seed=194)
        return out.select(F.expr("substring(feature, 3)").alias("feature"), F.col("increase").alias("accuracy_drop"))

    # -------------------------------------------------------------- boosting
    def trees(self) -> DataFrame:
        """ML-9: the boosted trees of all folds and of the model on all rows."""
        return self._once("trees", lambda: stored_table(
            boosting.boost(self.train, FEATURES, "label", "date", self.boost_rounds, S.BOOST_RATE, self.boost_folds, S.BOOST_SPLITS),
            "spike-boost", self.key("boost", rounds=self.boost_rounds, folds=self.boost_folds)))

    def best_round(self) -> int:
        return self._once("best", lambda: boosting.best_round(self.trees()))

    # --------------------------------------------------------------- results
    def scored(self, model: str) -> DataFrame:
        """The test rows with ``p_high`` and, per cut of the model, ``predicted_spike``."""
        from pyspark.ml.functions import vector_to_array
        cuts: tuple[float | None, ...] = (None,)
        if model == TREE:
            label, p = pruning.tree_columns(self.pruned_tree(), FEATURES)
            rows = self.tests.withColumns({"p_high": p, "prediction": label})
        elif model == FOREST:
            rows = self.forest().transform(_typed(self.tests)).withColumn("p_high", vector_to_array("probability")[1])
        else:
            rows, cuts = boosting.probability(self.tests, self.trees(), FEATURES, self.best_round()), self.cuts
            rows = rows.withColumn("prediction", F.lit(None).cast("double"))
        cut = F.array(*[F.lit(c).cast("double") for c in cuts])
        high = F.when(F.col("cut").isNull(), F.col("prediction") == 1.0).otherwise(F.col("p_high") >= F.col("cut"))
        return (rows.select(F.lit(model).alias("model"), F.explode(cut).alias("cut"), "part", "date", "week_of_the_year", "next_day_spike",
                            "p_high", "prediction")
                .withColumn("predicted_spike", F.when(high, "High").otherwise("Normal")).drop("prediction"))

    def comparison(self, models: tuple[str, ...] = MODELS) -> DataFrame:
        """EVL-2..4: a row per model, cut and test set."""
        rows = [classification_metrics(self.scored(m), "predicted_spike", "next_day_spike", by=("model", "cut", "part"),
                                       probability="p_high").drop("error_rate") for m in models]
        return _stack(rows)

    def confusion(self, models: tuple[str, ...] = MODELS) -> DataFrame:
        """EVL-1: counts per model, cut, test set, predicted and actual label."""
        return _stack([confusion(self.scored(m), "predicted_spike", "next_day_spike", ("model", "cut", "part")) for m in models])

    def importance(self, model: str) -> DataFrame:
        """ML-7: DF[model, feature, importance], in hundredths of the model's total."""
        if model == BOOSTING:
            rows = boosting.relative_influence(self.trees(), MODEL_COLUMNS, self.best_round())
        elif model == FOREST:
            pairs = impurity_importance(self.forest().stages[-1], list(MODEL_COLUMNS))
            rows = self.spark.createDataFrame([(f, float(v)) for f, v in pairs], "feature string, importance double")
        else:
            rows = pruning.impurity_drop(self.pruned_tree(), MODEL_COLUMNS)
        return rows.select(F.lit(model).alias("model"), "feature", "importance")


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
