"""Forest regression over few features, from sums per cell of their bins (ML-10, ML-7).

As MLlib does, every feature is cut into at most ``BINS`` bins, so a tree only
sees which cell of the grid of bins a row lies in. A row's part in each tree's
bootstrap is a Poisson number drawn from the hash of its key; one pass over the rows adds
them and the labels up per tree and cell, after which a tree is grown from its
cells whatever the row count was, trees side by side. The result depends on
the rows and the seed, not on partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialize
from .order_stats import running

#: MLlib's default for ``maxBins``.
BINS = 32
#: A feature with more values is told by this many ranges of equal row counts when its cuts are chosen.
RANGES = 1024
#: The grid of all features' bins; a tree's sums are two numbers a cell.
MAX_CELLS = 1 << 16
_CELLS = "tree int, cells array<int>, rows array<double>, sums array<double>"
_TREE = "tree int, prediction array<double>, importance array<double>"


def _walk(values: list[tuple[float, float, int]], bins: int) -> list[float]:
    """MLlib's choice of cuts from (lowest, highest, rows) in order: all midpoints if they are few, else about equal rows a bin."""
    middle = [(values[i - 1][1] + values[i][0]) / 2 for i in range(1, len(values))]
    if len(middle) < bins:
        return middle
    stride = sum(n for *_, n in values) / bins
    cuts, so_far, target = [], values[0][2], stride
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + values[i][2]
        if abs(before - target) < abs(so_far - target) and len(cuts) < bins - 1:
            cuts.append(middle[i - 1])
            target += stride
    return cuts


def cut_points(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Per feature the ascending cuts of its bins, at most ``bins - 1``; a value equal to a cut lies below it."""
    long = rows.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "column", "value")
    counts = materialize(long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")),
                         "feature_values")
    size = F.broadcast(counts.groupBy("column").agg(F.count(F.lit(1)).alias("_values"), F.sum("n").alias("_total")))  # a row a feature
    ranked = running(counts, [F.col("value")], ["column"]).join(size, "column")
    part = F.when(F.col("_values") <= RANGES, F.col("value")).otherwise(F.floor(F.col("before") * RANGES / F.col("_total")))
    ranges = (ranked.groupBy("column", part.alias("_part"))
              .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n")).orderBy("low").collect())
    return {f: _walk([(r.low, r.high, r.n) for r in ranges if r.column == f], bins) for f in features}


def cell(cuts: dict[str, list[float]]) -> Column:
    """The number of a row's cell in the grid, the last feature running fastest."""
    at = F.lit(0)
    for f, points in cuts.items():
        # a comparison a cut, written out, makes a method too long for the JIT compiler
        x = F.col(f).cast("double")
        below = F.filter(F.array(*[F.lit(float(p)) for p in points]).cast("array<double>"), lambda p: p < x)
        at = at * F.lit(len(points) + 1) + F.size(below)
    return at


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Uniform 64-bit numbers from hashes and a salt (splitmix64)."""
    z = h + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


#: P(Poisson(1) <= k) in 64-bit steps.
_POISSON = np.array([min(int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2**64), 2**64 - 1) for k in range(16)],
                    dtype=np.uint64)


def bagged_cells(rows: DataFrame, n_trees: int, n_cells: int) -> DataFrame:
    """DF[tree, cells, rows, sums] of the rows (_cell, _y, _h): per partition and tree the cells that its bootstrap
    reaches, with their rows and the sum of their labels."""
    def add(batches) -> Iterator:
        import pandas as pd
        n, s = np.zeros((n_trees, n_cells)), np.zeros((n_trees, n_cells))
        for batch in batches:
            at, y, h = batch["_cell"].to_numpy(), batch["_y"].to_numpy(), batch["_h"].to_numpy().astype(np.uint64)
            for t in range(n_trees):
                drawn = np.searchsorted(_POISSON, _mixed(h, t + 1), side="right").astype(float)
                n[t] += np.bincount(at, drawn, n_cells)
                s[t] += np.bincount(at, drawn * y, n_cells)
        hit = [np.flatnonzero(row) for row in n]
        yield pd.DataFrame({"tree": np.arange(n_trees, dtype=np.int32), "cells": [i.astype(np.int32) for i in hit],
                            "rows": [row[i] for row, i in zip(n, hit)], "sums": [row[i] for row, i in zip(s, hit)]})
    return rows.select("_cell", "_y", "_h").mapInPandas(add, _CELLS)


def grow(n: np.ndarray, s: np.ndarray, mtry: int, depth: int, min_rows: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """One regression tree on a grid with ``n`` rows and label sum ``s`` a cell: (prediction per cell, drop of the
    squared error per feature). A node is a box of cells; ``mtry`` features are tried at each."""
    prediction, drop = np.zeros(n.shape), np.zeros(n.ndim)
    todo = [(tuple((0, k) for k in n.shape), 0)]
    while todo:
        box, level = todo.pop()
        inside = tuple(slice(*b) for b in box)
        rows, total = n[inside].sum(), s[inside].sum()
        prediction[inside] = total / rows if rows else 0.0
        best = None
        for j in rng.permutation(n.ndim)[:mtry] if level < depth else ():
            others = tuple(i for i in range(n.ndim) if i != j)
            left_n, left_s = n[inside].sum(axis=others).cumsum()[:-1], s[inside].sum(axis=others).cumsum()[:-1]
            fits = np.flatnonzero((left_n >= min_rows) & (rows - left_n >= min_rows))
            if not fits.size:
                continue
            a, b = left_n[fits], left_s[fits]
            gain = b * b / a + (total - b) ** 2 / (rows - a) - total * total / rows
            k = int(gain.argmax())
            if gain[k] > 1e-12 * total * total / rows and (best is None or gain[k] > best[0]):
                best = (gain[k], j, box[j][0] + int(fits[k]) + 1)
        if best is not None:
            gain, j, at = best
            drop[j] += gain
            todo += [(box[:j] + ((box[j][0], at),) + box[j + 1:], level + 1),
                     (box[:j] + ((at, box[j][1]),) + box[j + 1:], level + 1)]
    return prediction, drop


def fit_trees(train: DataFrame, y: str, cuts: dict[str, list[float]], key_cols: Sequence[str], n_trees: int, mtry: int,
              depth: int, min_rows: int, seed: int) -> DataFrame:
    """DF[tree, prediction, importance]: a row per tree, its prediction for every cell and, in shares of its total, the
    drop of the squared error by each feature. ``key_cols`` tell the rows apart."""
    shape = tuple(len(points) + 1 for points in cuts.values())
    n_cells = math.prod(shape)
    if n_cells > MAX_CELLS:
        raise ValueError(f"{n_cells} cells: too many features for a forest over cells")
    rows = train.select(cell(cuts).alias("_cell"), F.col(y).cast("double").alias("_y"),
                        F.xxhash64(*key_cols, F.lit(seed)).alias("_h"))

    def tree(parts):
        import pandas as pd
        t = int(parts["tree"].iloc[0])
        n, s = np.zeros(n_cells), np.zeros(n_cells)
        for at, rows_, sums in zip(parts["cells"], parts["rows"], parts["sums"]):
            n[at] += rows_
            s[at] += sums
        found, drop = grow(n.reshape(shape), s.reshape(shape), mtry, depth, min_rows, np.random.default_rng([seed, t]))
        return pd.DataFrame({"tree": np.array([t], dtype=np.int32), "prediction": [found.ravel()],
                             "importance": [drop / (drop.sum() or 1.0)]})

    # the number of partitions is given: a tree is little data and much work, its groups must not be put together
    return bagged_cells(rows, n_trees, n_cells).repartition(n_trees, "tree").groupBy("tree").applyInPandas(tree, _TREE)


def cell_predictions(trees: DataFrame) -> DataFrame:
    """DF[_cell, prediction]: the mean over the trees, a row per cell of the grid."""
    return trees.select(F.posexplode("prediction").alias("_cell", "_p")).groupBy("_cell").agg(F.avg("_p").alias("prediction"))


def importance(trees: DataFrame, features: Sequence[str]) -> DataFrame:
    """ML-7: DF[feature, impurity_importance], in hundredths of the total."""
    shares = trees.select(F.posexplode("importance").alias("_at", "_share")).groupBy("_at").agg(F.sum("_share").alias("_share"))
    total = trees.select(F.explode("importance").alias("_share")).agg(F.sum("_share").alias("_total"))
    name = F.array(*[F.lit(f) for f in features])[F.col("_at")]
    return shares.join(F.broadcast(total), F.lit(True)).select(
        name.alias("feature"), F.coalesce(F.try_divide(100.0 * F.col("_share"), F.col("_total")), F.lit(0.0)).alias("impurity_importance"))
