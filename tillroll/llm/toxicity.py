"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Training reads a bounded sample of the labelled rows (``max_train``, chosen by a
hash of the id). One pass counts in how many toxic and other texts each hashed
n-gram occurs; r = log of the ratio of its two rates. The ``features`` n-grams
that tell the classes apart best stay, a text is the vector of r over the ones
it holds, and a logistic regression is fitted to those vectors. The model is two
numbers per hash bucket at most, whatever the corpus holds; scoring is one pass
over whole texts without a shuffle.

Defined results: NULL text counts as empty; a text without a known n-gram gets
the intercept's score. A NULL or contradictory label takes no part (an id with
both labels is dropped from training). Without labels of both classes every
score is the share of toxic labels, 0 if there are none. Repeated rows are
scored each. Only id and text are read; lang, source and id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

#: n-gram lengths and hash buckets.
GRAMS, BUCKETS = (3, 4, 5), 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORDLIKE: list[np.ndarray] = []


def _wordlike() -> np.ndarray:
    if not _WORDLIKE:
        _WORDLIKE.append(np.fromiter((chr(c).isalnum() for c in range(0x10000)), bool, 0x10000))
    return _WORDLIKE[0]


def grams(text: str) -> np.ndarray:
    """Hash buckets of the text's n-grams, repeats included: lower case, every
    run of other characters one space, a space at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _wordlike()[np.minimum(codes, 0xFFFF)]
    keep = word.copy()
    keep[0] = True
    keep[1:] |= word[:-1]
    codes = np.where(word, codes, 32)[keep].astype(np.uint64)
    found = []
    for n in GRAMS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for j in range(n):
                h = (h ^ codes[j:len(codes) - n + 1 + j]) * _MIX
                h ^= h >> np.uint64(29)
            found.append(h >> np.uint64(64 - 18))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """``weight`` per hash bucket (coefficient times r; zero outside the features), and the intercept."""
    weight: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        held = grams(text)
        held = np.unique(held[self.weight[held] != 0.0])
        z = self.intercept + float(self.weight[held].sum())
        return float(1.0 / (1.0 + np.exp(-min(700.0, max(-700.0, z)))))


def held_out(id_col: str = "doc_id"):
    """Rows that no label may be learnt from: crc32 of the id's digits is 1 modulo 3."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    totals = [0, 0]
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic, np.unique(grams(text))] += 1
            totals[toxic] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch([pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(counts[0, seen], totals[0])),
                           pa.array(np.append(counts[1, seen], totals[1]))], names=["bucket", "clean", "toxic"])


def _features(chosen: np.ndarray):
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.unique(x[x >= 0]) for x in (place[grams(t)] for t in batch.column(1).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(held, pa.list_(pa.int32()))], names=["toxic", "held"])
    return extract


def _logistic(rows: pa.Table, r: np.ndarray, l2: float, rounds: int) -> pa.Table:
    """Logistic regression on the sample's sparse 0/r vectors: Nesterov steps scaled per feature."""
    lists = rows.column("held").combine_chunks()
    y = rows.column("toxic").to_numpy().astype(float)
    sizes = np.diff(lists.offsets.to_numpy())
    col = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(y)), sizes)
    x, n, m = r[col], len(y), len(r)
    step = 1.0 / (0.25 * np.bincount(col, np.abs(x) * np.bincount(row, np.abs(x), n)[row], m) / n + l2)
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    ahead, lead = w, b
    b_step = 1.0 / (0.25 * (1.0 + np.bincount(row, np.abs(x), n).mean()))
    for t in range(rounds):
        z = np.bincount(row, x * ahead[col], n) + lead
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))) - y
        new = ahead - step * (np.bincount(col, x * error[row], m) / n + l2 * ahead)
        new_b = lead - b_step * error.mean()
        pace = t / (t + 3.0)
        ahead, lead, w, b = new + pace * (new - w), new_b + pace * (new_b - b), new, new_b
    return pa.table({"place": pa.array(np.arange(-1, m), pa.int32()), "value": pa.array(np.append([b], w * r))})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_train: int = 20_000, features: int = 4096, l2: float = 1e-4, rounds: int = 150) -> Model:
    """Fit on at most ``max_train`` labelled rows outside the held-out third."""
    flat = Model(np.zeros(BUCKETS), -700.0)
    rows = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi"))
            .filter("lo = hi").select("label_id", F.col("hi").cast("int").alias("toxic_label"))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(max_train))
    sample = stage(docs.select(F.col(id_col).alias("label_id"), text_of(text_col).alias("body"))
                   .join(F.broadcast(rows), "label_id").select("toxic_label", "body"), "toxicity-sample")
    counts = (sample.mapInArrow(_count, "bucket int, clean long, toxic long")
              .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    table = counts.toArrow()  # one row per hash bucket at most
    bucket, clean, toxic = (table.column(c).to_numpy() for c in ("bucket", "clean", "toxic"))
    n0, n1 = (int(x[bucket == -1].sum()) for x in (clean, toxic))
    if not n0 or not n1:
        flat.intercept = 700.0 if n1 else -700.0
        return flat
    bucket, clean, toxic = (x[bucket >= 0] for x in (bucket, clean, toxic))
    p, q = (toxic + 1.0) / (n1 + 2.0), (clean + 1.0) / (n0 + 2.0)
    ratio = np.log(p / q)
    gain = n1 * (p * ratio + (1 - p) * np.log((1 - p) / (1 - q)))  # how unlikely these counts are at equal rates
    top = np.lexsort((bucket, -gain))[:features]
    chosen, r = bucket[top].astype(np.int64), ratio[top]
    held = stage(sample.mapInArrow(_features(chosen), "toxic int, held array<int>"), "toxicity-held")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _logistic(pa.Table.from_batches(batches), r, l2, rounds).to_batches()

    fitted = held.coalesce(1).mapInArrow(solve, "place int, value double").toArrow()  # the bounded sample, narrow
    place, value = fitted.column("place").to_numpy(), fitted.column("value").to_numpy()
    flat.intercept = float(value[place == -1][0])
    flat.weight[chosen[place[place >= 0]]] = value[place >= 0]
    return flat


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the corpus

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(
                [shared.value.score(t) for t in batch.column(2).to_pylist()], pa.float64())],
                names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       text_of(text_col).alias("text"))
    return rows.mapInArrow(scores, "doc_id long, held_out boolean, score double")


def keep_rows(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    names = docs.columns
    at = names.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([shared.value.score(t or "") < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
