"""Splits and evaluation (SPL-*, EVL-*, JOI-8, SET-4, ML-7, ML-8).

Splits are hash predicates, not random draws: a row's side depends only on its
own content, so the split is the same on every run, partitioning and engine
(DuckDB reproduces it), and the complement is the negated predicate (JOI-8)
instead of an anti-join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def share_threshold(share: float) -> str:
    """First-4-hex-digit cut for a share: 0.8 -> 'cccd'."""
    return "%04x" % math.ceil(share * 65536)


def row_hash(cols, sep: str = "|") -> F.Column:
    """md5 of the '|'-joined text of the key columns (NULL as empty text)."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def hash_split(df: DataFrame, key_cols, share: float = S.TRAIN_SHARE, col: str = "is_train") -> DataFrame:
    """SPL-1: train when the key's hash prefix is below the share's cut."""
    return df.withColumn(col, F.substring(row_hash(key_cols), 1, 4) < F.lit(share_threshold(share)))


def stratified_split(df: DataFrame, label: str, key_cols, share: float = S.TRAIN_SHARE,
                     col: str = "is_train") -> DataFrame:
    """SPL-2: per label, the first ceil(share * n) rows by key hash go to train.

    The window is partitioned by the label (two values): meant for small
    aggregated tables such as the daily features; for line-level data use
    ``hash_split`` inside each label instead.
    """
    h = row_hash(key_cols)
    w = Window.partitionBy(label)
    ranked = (df.withColumn("_h", h)
                .withColumn("_rk", F.row_number().over(w.orderBy("_h", *key_cols)))
                .withColumn("_n", F.count(F.lit(1)).over(w)))
    return ranked.withColumn(col, F.col("_rk") <= F.ceil(F.col("_n") * share)).drop("_h", "_rk", "_n")


def confusion(pred: DataFrame, prediction: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """EVL-1: counts per (predicted, actual), per value of ``by``."""
    return pred.groupBy(*by, F.col(prediction).alias("predicted"), F.col(label).alias("actual")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, prediction: str, label: str, positive="High", by: tuple[str, ...] = (),
                           probability: str | None = None) -> DataFrame:
    """EVL-2: accuracy, precision, recall and error rate for one positive class, per value of ``by``;
    EVL-3: with the column of its probability also the Brier score. Empty denominators give NULL."""
    p, y = F.col(prediction) == positive, F.col(label) == positive
    tp, fp, fn = F.count_if(p & y), F.count_if(p & ~y), F.count_if(~p & y)
    correct = F.count_if(F.col(prediction) == F.col(label))
    n = F.count(F.lit(1))
    brier = [F.avg((y.cast("double") - F.col(probability)) ** 2).alias("brier")] if probability else []
    return pred.groupBy(*by).agg(n.alias("n"),
                                 F.try_divide(correct.cast("double"), n.cast("double")).alias("accuracy"),
                                 F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
                                 F.try_divide(tp.cast("double"), (tp + fn).cast("double")).alias("recall"),
                                 F.try_divide((n - correct).cast("double"), n.cast("double")).alias("error_rate"), *brier)


def mse(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """EVL-3: mean squared error (Brier score for probabilities), per value of ``by``."""
    d = F.col(y).cast("double") - F.col(p).cast("double")
    return df.groupBy(*by).agg(F.avg(d * d).alias("mse"), F.count(F.lit(1)).alias("n"))


def impurity_importance(model, feature_names) -> list[tuple[str, float]]:
    """ML-7: tree-ensemble impurity importance scaled to 100."""
    imp = model.featureImportances.toArray()
    total = float(sum(imp)) or 1.0
    return sorted(((n, 100.0 * float(v) / total) for n, v in zip(feature_names, imp)), key=lambda t: -t[1])


#: Rows that trade a feature's values among themselves.
PERMUTED_ROWS = 4096


def permuted(df: DataFrame, feature_cols, key_cols, seed: int = 1, bucket_rows: int = PERMUTED_ROWS) -> DataFrame:
    """``df`` once as it is and once per feature with that feature's values permuted; ``feature`` names the copy
    (NULL: as it is).

    Rows trade values inside hash buckets of about ``bucket_rows`` rows: a row
    takes them from the row of the same rank in another order of its bucket.
    Both orders are hashes of the key, which must be unique, so the result
    depends on the rows and the seed only. One join serves all features.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    h = lambda salt: F.xxhash64(F.concat_ws("\u0001", *key), F.lit(seed), F.lit(salt))
    buckets = max(1, -(-df.count() // bucket_rows))
    rows = df.withColumn("_bucket", F.pmod(h(0), F.lit(buckets)))

    def ranked(salt: int) -> F.Column:
        return F.row_number().over(Window.partitionBy("_bucket").orderBy(h(salt), *key_cols))

    takers = rows.withColumn("_rank", ranked(1))
    givers = rows.select("_bucket", ranked(2).alias("_rank"), F.struct(*feature_cols).alias("_given"))
    pairs = takers.join(givers, ["_bucket", "_rank"])
    copies = F.array(F.lit(None).cast("string"), *[F.lit(c) for c in feature_cols])
    long = pairs.withColumn("feature", F.explode(copies))
    return long.withColumns({c: F.when(F.col("feature") == c, F.col(f"_given.{c}")).otherwise(F.col(c)) for c in feature_cols}
                            ).drop("_bucket", "_rank", "_given")


def permutation_importance(transform, df: DataFrame, feature_cols, key_cols, loss: F.Column, seed: int = 1,
                           bucket_rows: int = PERMUTED_ROWS) -> DataFrame:
    """ML-8: DF[feature, increase]: how much ``loss``, an aggregate over the scored rows, grows when one feature's
    values are permuted. ``transform`` scores all copies of the rows in one pass."""
    losses = transform(permuted(df, feature_cols, key_cols, seed, bucket_rows)).groupBy("feature").agg(loss.alias("_loss"))
    losses = losses.persist()  # a row per feature
    base = losses.where(F.col("feature").isNull()).select("_loss").scalar()
    return losses.where(F.col("feature").isNotNull()).select("feature", (F.col("_loss") - base).alias("increase"))
