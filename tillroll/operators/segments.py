"""Customer RFM features and segments (FLT-7, FLT-8, AGG-17, AGG-18, NUM-3, ML-1..4)."""

from __future__ import annotations

from collections.abc import Iterable
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import line_revenue, r_round, ratio

RFM_FEATURES = ("recency", "frequency", "monetary", "avg_order_value", "avg_basket_size", "n_products")
CUSTOMER_COLUMNS = ("invoice_no", "invoice_date", "price", "quantity", "country", "description", "customer_id",
                    "is_cancellation_invoice", "is_gift_voucher", "is_free_item", "is_shipping_fee",
                    "is_admin_invoice", "is_inventory_adjustment")


def customer_lines(sales: DataFrame) -> DataFrame:
    """SRC-3 + FLT-7 + NUM-2: pruned columns, known customer, six masks false,
    positive quantity and price; adds the day and the line revenue."""
    df = sales.select(*CUSTOMER_COLUMNS)
    masks = ["is_cancellation_invoice", "is_admin_invoice", "is_inventory_adjustment", "is_gift_voucher",
             "is_shipping_fee", "is_free_item"]
    cond = F.col("customer_id").isNotNull() & (F.col("quantity") > 0) & (F.col("price") > 0)
    for m in masks:
        cond = cond & ~F.col(m)
    return (df.where(cond)
              .withColumn("invoice_date_only", F.to_date("invoice_date"))
              .withColumn("line_revenue", line_revenue()))


def rfm(lines: DataFrame, exclude: Iterable[int] = S.EXCLUDED_CUSTOMERS) -> DataFrame:
    """AGG-17 + FLT-8: one row per customer.

    Recency counts days to (latest day in the data + 1); that global date is a
    scalar subquery, evaluated once and inlined, so no join is needed.
    ``n_products`` counts a missing description as one more product, as R's
    ``n_distinct`` does.
    """
    ref = lines.select(F.date_add(F.max("invoice_date_only"), 1)).scalar()
    freq = F.countDistinct("invoice_no")
    monetary = F.sum("line_revenue")
    out = (lines.groupBy("customer_id").agg(
        F.datediff(ref, F.max("invoice_date_only")).alias("recency"),
        freq.alias("frequency"),
        monetary.cast("decimal(38,2)").alias("monetary"),
        ratio(monetary, freq).alias("avg_order_value"),
        ratio(F.sum("quantity"), freq).alias("avg_basket_size"),
        (F.countDistinct("description") + F.max(F.col("description").isNull().cast("int")))
        .cast("long").alias("n_products")))
    out = out.where((F.col("monetary") > 0) & ~F.col("customer_id").isin(list(exclude)))
    return out.withColumn("customer_id", F.col("customer_id").cast("long"))


def log_features(rfm_df: DataFrame, digits: int | None = None) -> DataFrame:
    """NUM-3: log1p of every feature except recency."""
    cols = {}
    for c in ("monetary", "frequency", "avg_order_value", "avg_basket_size", "n_products"):
        v = F.log1p(F.col(c).cast("double"))
        cols[c] = F.round(v, digits) if digits is not None else v
    return rfm_df.withColumns(cols)


def step_counts(df: DataFrame, key: str, step: str) -> DataFrame:
    """AGG-31: rows and distinct keys at one step."""
    return df.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("rows"),
                  F.countDistinct(key).alias("distinct_keys"))


def segment_profiles(rfm_df: DataFrame, segment_col: str = "segment") -> DataFrame:
    """AGG-18: customers and rounded means per segment, by mean spend descending."""
    mean = lambda c: F.avg(F.col(c).cast("double"))
    return (rfm_df.groupBy(segment_col).agg(
        F.count(F.lit(1)).alias("n_customers"),
        r_round(mean("recency"), 0).alias("avg_recency"),
        r_round(mean("frequency"), 1).alias("avg_frequency"),
        r_round(mean("monetary"), 0).alias("avg_monetary"),
        r_round(mean("avg_order_value"), 0).alias("avg_order_value"),
        r_round(mean("avg_basket_size"), 1).alias("avg_basket_size"),
        r_round(mean("n_products"), 0).alias("avg_n_products"))
        .orderBy(F.col("avg_monetary").desc(), F.col(segment_col)))


# ----------------------------------------------------------------------------- ML
def customer_pca(rfm_log: DataFrame, target: float = S.PCA_VARIANCE_TARGET, features=RFM_FEATURES):
    """ML-1 / WIN-8: standardize (mean 0, sample sd 1), PCA on all features.

    Returns (scores DF[customer_id, scores], variance DF[pc, variance_share,
    cumulative_share], m = first component count reaching ``target``).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    k = len(features)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=k, inputCol="_std", outputCol="scores"),
    ])
    model = pipe.fit(rfm_log)
    shares = [float(x) for x in model.stages[-1].explainedVariance]
    total = sum(shares)
    shares = [s / total for s in shares]
    rows, cum = [], 0.0
    for i, s in enumerate(shares, start=1):
        cum += s
        rows.append((i, s, cum))
    m = next((i for i, _, c in rows if c >= target - 1e-12), k)
    spark = rfm_log.sparkSession
    variance = spark.createDataFrame(rows, "pc int, variance_share double, cumulative_share double")
    scores = model.transform(rfm_log).select("customer_id", "scores")
    return scores, variance, m


def first_components(scores: DataFrame, m: int, col: str = "scores", out: str = "features") -> DataFrame:
    """Keep the first m principal-component scores as the clustering input."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    return scores.withColumn(out, array_to_vector(F.slice(vector_to_array(col), 1, m)))


class KMeansFit:
    """Centres of the best start with its within SS and number of rounds (``summary``, as MLlib's model has them)."""

    def __init__(self, centers, cost: float, rounds: int, features: str):
        self._centers, self._features = centers, features
        self.summary = SimpleNamespace(trainingCost=cost, numIter=rounds)

    def clusterCenters(self) -> list:
        return list(self._centers)

    def transform(self, points: DataFrame) -> DataFrame:
        """``points`` with the number of the nearest centre, ``cluster`` (the first of equals)."""
        from pyspark.ml.functions import vector_to_array
        v = vector_to_array(self._features)
        far = F.array(*[sum(((v[i] - F.lit(float(x))) * (v[i] - F.lit(float(x))) for i, x in enumerate(c)), F.lit(0.0))
                        for c in self._centers])
        return points.withColumn("_far", far).withColumn(
            "cluster", (F.array_position("_far", F.array_min("_far")) - 1).cast("int")).drop("_far")


def _round_sums(centers: dict):
    """Per task and start: rows, within SS and sum of the points of every cluster."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        total: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            for start, c in centers.items():
                far = ((x[:, None, :] - c[None]) ** 2).sum(2)
                near = far.argmin(1)
                sums = np.zeros((len(c), x.shape[1] + 2))
                sums[:, 0] = np.bincount(near, minlength=len(c))
                sums[:, 1] = np.bincount(near, far[np.arange(len(x)), near], len(c))
                for i in range(x.shape[1]):
                    sums[:, i + 2] = np.bincount(near, x[:, i], len(c))
                total[start] = total.get(start, 0.0) + sums
        yield pa.record_batch([pa.array([s[0] for s in total], pa.int32()), pa.array([s[1] for s in total], pa.int32()),
                               pa.array([sums.tobytes() for sums in total.values()], pa.binary())], names=["k", "start", "sums"])
    return run


def kmeans_many(points: DataFrame, ks: Iterable[int], n_start: int = S.KMEANS_STARTS, seed: int = 197,
                features: str = "features", max_iter: int = 200, tol: float = 1e-4, parallelism: int = 8) -> dict[int, KMeansFit]:
    """ML-2: per K the K-means (Lloyd) with the least within SS of ``n_start`` random starts (the first of equals).

    MLlib draws the centres of every start. All starts of all K then move in the
    same pass over the points, a job per round instead of one per start and
    round; a start leaves when no centre moves by ``tol``; one that ``max_iter``
    ends before is told apart by ``summary.numIter == max_iter``. A task sends a
    row per start to the driver, and tasks are bounded by the cores. The
    workflow's own K-means updates centres in another way, so local optima can
    differ. ``parallelism`` starts are drawn at a time."""
    from multiprocessing.pool import ThreadPool

    import numpy as np
    from pyspark import inheritable_thread_target
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import vector_to_array

    spark = points.sparkSession

    def draw(start: tuple[int, int]):
        return np.array(KMeans(k=start[0], initMode="random", seed=seed * 1000 + start[1], maxIter=0,
                               featuresCol=features, predictionCol="cluster").fit(points).clusterCenters())

    starts = [(k, i) for k in sorted(ks) for i in range(n_start)]
    with ThreadPool(min(parallelism, len(starts))) as pool:
        centers = dict(zip(starts, pool.map(inheritable_thread_target(spark)(draw), starts)))
    arrays = points.select(vector_to_array(features).alias("v")).coalesce(2 * spark.sparkContext.defaultParallelism)
    moving, costs, rounds = set(starts), dict.fromkeys(starts, 0.0), dict.fromkeys(starts, 0)
    for _ in range(max_iter):
        if not moving:
            break
        found = arrays.mapInArrow(_round_sums({s: centers[s] for s in sorted(moving)}), "k int, start int, sums binary").collect()
        total: dict = {}
        for r in found:  # tasks x starts, in the order of the partitions
            s = (r.k, r.start)
            total[s] = total.get(s, 0.0) + np.frombuffer(r.sums).reshape(len(centers[s]), -1)
        for s, sums in total.items():
            new, held = centers[s].copy(), sums[:, 0] > 0
            new[held] = sums[held, 2:] / sums[held, :1]
            rounds[s] += 1
            costs[s] = float(sums[:, 1].sum())
            if (((new - centers[s]) ** 2).sum(1) <= tol * tol).all():
                moving.remove(s)
            centers[s] = new
    best = {k: min((s for s in starts if s[0] == k), key=costs.get) for k in sorted(ks)}
    return {k: KMeansFit(centers[s], costs[s], rounds[s], features) for k, s in best.items()}


def kmeans_best(points: DataFrame, k: int, *args, **kwargs) -> KMeansFit:
    """``kmeans_many`` of one K."""
    return kmeans_many(points, (k,), *args, **kwargs)[k]


def assign_clusters(points: DataFrame, model) -> DataFrame:
    """Every point with the number of its nearest centre, ``cluster``."""
    return model.transform(points)


def total_ss(points: DataFrame, features: str = "features") -> float:
    """Total sum of squares around the grand mean, summed on executors."""
    from pyspark.ml.functions import vector_to_array
    arr = points.select(vector_to_array(features).alias("v"))
    dim = arr.select(F.max(F.size("v"))).first()[0]
    sums = arr.agg(*[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dim)],
                   *[F.sum(F.col("v")[i] * F.col("v")[i]).alias(f"q{i}") for i in range(dim)],
                   F.count(F.lit(1)).alias("n")).first()
    n = sums["n"]
    return float(sum(sums[f"q{i}"] - sums[f"s{i}"] ** 2 / n for i in range(dim)))


def kmeans_sweep(points: DataFrame, ks=S.KMEANS_KS, n_start: int = S.KMEANS_STARTS, seed: int = 197,
                 features: str = "features", max_iter: int = 200, fit=kmeans_many):
    """ML-2: within / between / total SS for each K; returns (table DF, {k: model}).

    ``converged`` is false where the best start was ended by ``max_iter``."""
    tot = total_ss(points, features)
    models = fit(points, sorted(ks), n_start, seed, features, max_iter)
    rows = []
    for k, model in models.items():
        within = float(model.summary.trainingCost)
        rows.append((k, within, tot - within, tot, (tot - within) / tot if tot else None, model.summary.numIter < max_iter))
    table = points.sparkSession.createDataFrame(
        rows, "k int, within_ss double, between_ss double, total_ss double, between_over_total double, converged boolean")
    return table, models


def relabel_by_spend(assigned: DataFrame, rfm_df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster ids are arbitrary: renumber 1..K by descending mean monetary."""
    from pyspark.sql import Window
    means = (assigned.join(rfm_df.select("customer_id", "monetary"), "customer_id")
             .groupBy(cluster).agg(F.avg(F.col("monetary").cast("double")).alias("_m")))
    ranks = means.withColumn("segment", F.row_number().over(Window.orderBy(F.col("_m").desc(), F.col(cluster))))
    # K rows only: the ranking window is over the cluster table, not over customers.
    return assigned.join(F.broadcast(ranks.select(cluster, "segment")), cluster).drop(cluster)


def hierarchical_segments(points: DataFrame, k: int = S.KMEANS_CHOSEN_K, seed: int = 196,
                          features: str = "features") -> DataFrame:
    """ML-3 (re-aimed): divisive bisecting K-means on all customers instead of an
    agglomerative tree on a 300-row sample; a different algorithm, stated as such."""
    from pyspark.ml.clustering import BisectingKMeans
    model = BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="hc").fit(points)
    return model.transform(points)


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """ML-4 / AGG-6: agreement table in long form."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
