"""Gradient boosting with cross-validated number of rounds (ML-9, ML-7).

A round's tree is grown on the residuals of all earlier ones, so a thousand
rounds are a thousand steps one after the other however many machines there
are; as cluster jobs they would be nothing but scheduling. What can run side by
side are the fits: one per fold and one on all rows. Each is a group here, its
rows a row per trading day of one market (a century has 36,525), and its rounds
run in that group's task. What comes back is a table of trees, so the model is
stored, inspected and cut to its best round like any other table.

Trees have ``splits`` splits, grown best first, on a bernoulli loss: a random
``bag`` of the rows per round, at least ``min_rows`` bagged rows per leaf, leaf
values by one Newton step. Thresholds lie between the 256-quantiles of a feature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The model fitted on all rows; folds are numbered from 0.
FULL = -1
BINS = 256
TREES = ("model int, round int, feature array<int>, threshold array<double>, child array<int>, value array<double>, "
         "gain array<double>, held_loss double, held_rows long")


class _Binned:
    """Columns as bin numbers; bin b of a column holds the values below its edge b."""

    def __init__(self, x: np.ndarray):
        self.edges = []
        for column in x.T:
            values = np.unique(column)
            if len(values) > BINS:
                values = np.unique(np.quantile(values, np.linspace(0, 1, BINS), method="nearest"))
            self.edges.append((values[1:] + values[:-1]) / 2)
        self.codes = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], axis=1)
        self.flat = self.codes + BINS * np.arange(x.shape[1])

    def split(self, rows: np.ndarray, z: np.ndarray, least: int):
        """(gain, feature, bin): the cut that lowers the squared error of ``z`` most; the first of equals."""
        size, width = self.flat.shape[1], BINS * self.flat.shape[1]
        at = self.flat[rows].ravel()
        n = np.bincount(at, minlength=width).reshape(size, BINS).cumsum(1)
        s = np.bincount(at, np.repeat(z[rows], size), width).reshape(size, BINS).cumsum(1)
        right_n, right_s = n[:, -1:] - n, s[:, -1:] - s
        fits = (n >= least) & (right_n >= least)
        if not fits.any():
            return 0.0, -1, -1
        gap = s / np.maximum(n, 1) - right_s / np.maximum(right_n, 1)
        gain = np.where(fits, n * right_n / max(1, len(rows)) * gap ** 2, -1.0)
        best = int(gain.argmax())
        return float(gain.flat[best]), best // BINS, best % BINS


def _tree(data: _Binned, bag: np.ndarray, z: np.ndarray, splits: int, least: int):
    """(feature, threshold, child, gain, leaf of every row); ``child`` is the leaf that a later split divides."""
    leaf = np.zeros(len(z), np.int64)
    cuts = [data.split(bag, z, least)]
    feature, threshold, child, gains = [], [], [], []
    for made in range(splits):
        part = int(np.argmax([c[0] for c in cuts]))
        gain, f, b = cuts[part]
        if f < 0 or gain <= 0.0:
            break
        feature.append(f)
        threshold.append(float(data.edges[f][b]))
        child.append(part)
        gains.append(gain)
        leaf[(leaf == part) & (data.codes[:, f] > b)] = made + 1
        cuts[part] = data.split(bag[leaf[bag] == part], z, least)
        cuts.append(data.split(bag[leaf[bag] == made + 1], z, least))
    return feature, threshold, child, gains, leaf


def leaves(x: np.ndarray, feature: Sequence[int], threshold: Sequence[float], child: Sequence[int]) -> np.ndarray:
    """The leaf of each row of ``x``: each split sends the rows of its leaf that reach its threshold to a new one."""
    leaf = np.zeros(len(x), np.int64)
    for new, (f, t, part) in enumerate(zip(feature, threshold, child), 1):
        leaf[(leaf == part) & (x[:, f] >= t)] = new
    return leaf


def _deviance(y: np.ndarray, score: np.ndarray) -> float:
    return float(2 * (np.logaddexp(0.0, score) - y * score).sum())


def _fit(n_features: int, rounds: int, rate: float, splits: int, bag: float, least: int, seed: int):
    def fit(rows: pa.Table) -> pa.Table:
        """One model: rows are (model, order, held, label, features)."""
        rows = rows.sort_by("order")
        model = rows.column("model")[0].as_py()
        held = rows.column("held").to_numpy()
        y = rows.column("label").to_numpy().astype(float)
        x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(len(y), n_features)
        x_held, y_held, x, y = x[held], y[held], x[~held], y[~held]
        data, out = _Binned(x), []
        share = min(max(float(y.mean()), 1e-9), 1 - 1e-9)
        start = float(np.log(share / (1 - share)))
        score, score_held = np.full(len(y), start), np.full(len(y_held), start)
        out.append((model, 0, [], [], [], [start], [], _deviance(y_held, score_held), len(y_held)))
        for t in range(1, rounds + 1):
            p = 1.0 / (1.0 + np.exp(-score))
            z = y - p
            drawn = np.random.default_rng([seed, model + 1, t]).permutation(len(y))[:max(1, int(bag * len(y)))]
            feature, threshold, child, gain, leaf = _tree(data, drawn, z, splits, least)
            step = np.bincount(leaf[drawn], z[drawn], len(feature) + 1)
            curve = np.bincount(leaf[drawn], (p * (1 - p))[drawn], len(feature) + 1)
            value = rate * step / np.maximum(curve, 1e-12)
            score += value[leaf]
            score_held += value[leaves(x_held, feature, threshold, child)]
            out.append((model, t, feature, threshold, child, value.tolist(), gain, _deviance(y_held, score_held), len(y_held)))
        return pa.table([pa.array(c, type=t) for c, t in zip(zip(*out), (
            pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float64()),
            pa.list_(pa.float64()), pa.float64(), pa.int64()))],
            names=["model", "round", "feature", "threshold", "child", "value", "gain", "held_loss", "held_rows"])
    return fit


def boost(train: DataFrame, features: Sequence[str], label: str, key: str, rounds: int, rate: float, folds: int = 5,
          splits: int = 2, bag: float = 0.5, min_rows: int = 10, seed: int = 195) -> DataFrame:
    """ML-9: a row per model and round; model ``FULL`` is fitted on all rows, the others without their fold.

    A row's fold is a hash of ``key``, which orders the rows as well, so the
    trees do not depend on the partitioning."""
    rows = train.select(F.struct(F.col(key).cast("string").alias("key"), F.col(label).cast("double").alias("label")).alias("r"),
                        F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
                        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(folds)).cast("int").alias("fold"))
    every = rows.withColumn("model", F.explode(F.sequence(F.lit(FULL), F.lit(folds - 1)))).select(
        "model", F.col("r.key").alias("order"), (F.col("model") == F.col("fold")).alias("held"), "r.label", "features")
    return every.groupBy("model").applyInArrow(_fit(len(features), rounds, rate, splits, bag, min_rows, seed), TREES)


def cv_loss(trees: DataFrame) -> DataFrame:
    """DF[round, cv_loss]: the held-out deviance per row over all folds, after every round."""
    return trees.where(F.col("model") != FULL).groupBy("round").agg(
        (F.sum("held_loss") / F.sum("held_rows")).alias("cv_loss"))


def best_round(trees: DataFrame) -> int:
    """EVL-4: the round with the least cross-validated loss, the first of equals; at least 1."""
    row = cv_loss(trees).where(F.col("round") > 0).agg(F.min(F.struct("cv_loss", "round")).alias("b")).first()
    return int(row.b["round"]) if row.b is not None else 1


def probability(rows: DataFrame, trees: DataFrame, features: Sequence[str], best: int, out: str = "p_high") -> DataFrame:
    """``rows`` with the probability that the first ``best`` rounds give; the trees are bounded by the number of rounds."""
    model = [(r.feature, r.threshold, r.child, np.array(r.value)) for r in
             trees.where((F.col("model") == FULL) & (F.col("round") <= best)).orderBy("round").collect()]
    packed = rows.withColumn("_x", F.array(*[F.col(c).cast("double") for c in features]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(batch.num_rows, len(features))
            total = np.zeros(len(x))
            for feature, threshold, child, value in model:
                total += value[leaves(x, feature, threshold, child)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(1.0 / (1.0 + np.exp(-total)))],
                                             names=[*batch.schema.names[:-1], out])

    schema = rows.schema.add(out, "double") if out not in rows.columns else rows.schema
    return packed.mapInArrow(score, schema)


def relative_influence(trees: DataFrame, features: Sequence[str], best: int) -> DataFrame:
    """ML-7: DF[feature, importance]: each feature's share of the splits' gains, in hundredths; 0 for one never split on."""
    cuts = trees.where((F.col("model") == FULL) & (F.col("round") <= best)).select(
        F.explode(F.arrays_zip("feature", "gain")).alias("s"))
    names = F.array(*[F.lit(c) for c in features])
    gains = cuts.groupBy(F.element_at(names, F.col("s.feature") + 1).alias("feature")).agg(F.sum("s.gain").alias("gain"))
    every = trees.sparkSession.range(1).select(F.explode(names).alias("feature")).join(gains, "feature", "left").na.fill(0.0)
    total = every.select(F.sum("gain")).scalar()
    return every.select("feature", F.coalesce(100 * F.try_divide(F.col("gain"), total), F.lit(0.0)).alias("importance"))
