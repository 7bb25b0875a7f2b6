"""Least squares from executor-side sums (used by ML-11, ML-12, ML-14).

A linear model needs only X'X, X'y, y'y and n. These are sums over rows, so
they come from one aggregate (optionally per group, e.g. per CV fold) whatever
the row count; only the small p x p system is solved on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order_stats import quantiles


def spline_basis(x: Column, knots: Sequence[float], center: float, scale: float, prefix: str) -> list[Column]:
    """Cubic regression-spline columns (truncated power basis on the
    standardized value): z, z^2, z^3 and (z - k)_+^3 per interior knot; with
    d - 3 knots this spans the same space as a B-spline basis of d degrees of
    freedom."""
    z = (x.cast("double") - F.lit(center)) / F.lit(scale)
    cols = [z.alias(f"{prefix}_1"), (z * z).alias(f"{prefix}_2"), (z * z * z).alias(f"{prefix}_3")]
    for i, k in enumerate(knots):
        kz = (k - center) / scale
        cols.append(F.pow(F.greatest(z - F.lit(kz), F.lit(0.0)), 3).alias(f"{prefix}_k{i}"))
    return cols


def knots_for_all(df: DataFrame, cols: Sequence[str], dof: int) -> dict[str, tuple[list[float], float, float]]:
    """Per column the interior knots at the (1..d-3)/(d-2) quantiles, plus center and scale.
    The quantiles are exact, by rank (see ``order_stats``), of all columns at once."""
    n_knots = max(dof - 3, 0)
    probs = [(i + 1) / (n_knots + 1) for i in range(n_knots)]
    x = {c: F.col(c).cast("double") for c in cols}
    row = df.agg(*[F.avg(x[c]).alias(f"m_{c}") for c in cols], *[F.stddev_samp(x[c]).alias(f"s_{c}") for c in cols]).first()
    found = quantiles(df, cols, probs).orderBy("p").collect() if probs else []  # columns x knots
    out = {}
    for c in cols:
        scale = row[f"s_{c}"] if row[f"s_{c}"] and row[f"s_{c}"] > 0 else 1.0
        out[c] = ([float(r.value) for r in found if r.column == c], float(row[f"m_{c}"]), float(scale))
    return out


def knots_for(df: DataFrame, col: str, dof: int) -> tuple[list[float], float, float]:
    """``knots_for_all`` of one column."""
    return knots_for_all(df, [col], dof)[col]


def knots_of(x: np.ndarray, n: np.ndarray, dof: int) -> tuple[list[float], float, float]:
    """``knots_for`` of values ``x`` that occur ``n`` times each (a value may be listed more than once)."""
    order = np.argsort(x, kind="stable")
    x, ends = x[order], np.cumsum(n[order])
    total, n_knots = ends[-1], max(dof - 3, 0)
    rank = lambda r: x[np.searchsorted(ends, r, side="right")]
    at = (total - 1) * np.arange(1, n_knots + 1) / (n_knots + 1)
    low = np.floor(at)
    knots = rank(low) + (rank(np.ceil(at)) - rank(low)) * (at - low)
    mean = float((x * n[order]).sum() / total)
    sd = float(np.sqrt((n[order] * (x - mean) ** 2).sum() / max(total - 1, 1.0)))
    return knots.tolist(), mean, sd if sd > 0 else 1.0


def spline_values(x: np.ndarray, knots: Sequence[float], center: float, scale: float) -> np.ndarray:
    """The columns of ``spline_basis`` at the values ``x``."""
    z = (x - center) / scale
    return np.column_stack([z, z ** 2, z ** 3, *[np.maximum(z - (k - center) / scale, 0.0) ** 3 for k in knots]])


def gramian(df: DataFrame, x_cols: Sequence[str], y: str, group: str | None = None) -> dict:
    """Sums for least squares (intercept included), per ``group`` value.

    Returns {group_value: (XtX, Xty, yty, n)}; a single key None without group.
    """
    cols = ["_one", *x_cols]
    d = df.withColumn("_one", F.lit(1.0))
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"xx_{a}__{b}"))
        aggs.append(F.sum(F.col(a).cast("double") * F.col(y).cast("double")).alias(f"xy_{a}"))
    aggs += [F.sum(F.col(y).cast("double") ** 2).alias("yy"), F.count(F.lit(1)).alias("n")]
    rows = (d.groupBy(group).agg(*aggs) if group else d.agg(*aggs)).collect()
    p = len(cols)
    out = {}
    for r in rows:
        xtx = np.zeros((p, p))
        for i, a in enumerate(cols):
            for j in range(i, p):
                v = r[f"xx_{a}__{cols[j]}"] or 0.0
                xtx[i, j] = xtx[j, i] = v
        xty = np.array([r[f"xy_{a}"] or 0.0 for a in cols])
        out[r[group] if group else None] = (xtx, xty, float(r["yy"] or 0.0), int(r["n"]))
    return out


def solve(xtx: np.ndarray, xty: np.ndarray) -> np.ndarray:
    """Minimum-norm least-squares solution (handles collinear spline columns)."""
    return np.linalg.lstsq(xtx, xty, rcond=None)[0]


def sse(beta: np.ndarray, xtx: np.ndarray, xty: np.ndarray, yty: float) -> float:
    """Residual sum of squares from the sums alone."""
    return float(yty - 2 * beta @ xty + beta @ xtx @ beta)


def linear_column(beta: Sequence[float], x_cols: Sequence[str]) -> Column:
    """Prediction as a plain Column expression (stays in generated code)."""
    expr = F.lit(float(beta[0]))
    for b, c in zip(beta[1:], x_cols):
        expr = expr + F.lit(float(b)) * F.col(c).cast("double")
    return expr


def effective_df(g: np.ndarray, penalty: np.ndarray, lam: float) -> float:
    """trace((G + lam P)^-1 G): degrees of freedom of a penalized fit."""
    return float(np.trace(np.linalg.pinv(g + lam * penalty) @ g))


def lambda_for_df(g: np.ndarray, penalty: np.ndarray, target: float, lo: float = 1e-8, hi: float = 1e8,
                  steps: int = 80) -> float:
    """Bisect log(lambda) until the effective df equals ``target`` (df falls
    monotonically as the penalty grows)."""
    if effective_df(g, penalty, lo) <= target:
        return lo
    if effective_df(g, penalty, hi) >= target:
        return hi
    a, b = np.log(lo), np.log(hi)
    for _ in range(steps):
        m = 0.5 * (a + b)
        if effective_df(g, penalty, float(np.exp(m))) > target:
            a = m
        else:
            b = m
    return float(np.exp(0.5 * (a + b)))
