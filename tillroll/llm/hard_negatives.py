"""Hard-negative mining by rotated one-bit codes and a deterministic residual interval.

Every vector o is turned by one random rotation and kept as a one-bit code: the
signs s of its turned components, of which x = s / sqrt(d) is a unit vector. Beside the
code stands its alignment a = <o, x>, so that o = a x + r with r at right
angles to x and |r| = sqrt(|o|^2 - a^2). For an anchor q, <o, q> = a <x, q> + <r, q>, and
by Cauchy and Schwarz |<r, q>| <= |r| sqrt(|q|^2 - <x, q>^2). <x, q> is estimated by popcounts of
the code with the bit planes of the turned, quantised anchor; the quantisation
error, at most its own length, widens the interval. Nothing in it is random, so a
row whose interval misses what an anchor looks for can be left out for good;
all others are scored in whole numbers.

Anchors are dealt to blocks of bounded size and rows to slices. A task holds one
block and streams one slice: per anchor it keeps the best places so far, whose
last one is the floor that later rows' upper bounds must reach. What a task
puts out depends on its anchors only. Pass one finds each anchor's positives,
pass two the negatives in each positive's band.

Defined results: a row with a NULL id or label, a NULL vector, or a NULL or
non-finite component takes no part. Rows that repeat an id count once, with the
largest vector, then label. Vectors of different lengths are not compared. Ties
go to the smaller id. A positive whose score is below 0 has no negatives, one
of score 0 only those of score 0. Scores beyond 64 bits are held at the largest
value. An empty table gives an empty result. Only the three columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage

#: Anchors of a block; bits of a quantised anchor component; seed of the rotation; (anchor, row) pairs at a time.
BLOCK_ROWS, QUERY_BITS, SEED, PAIRS = 4096, 6, 13, 1 << 20
#: A negative's least score, in hundredths of its positive's.
SHARE = 80
NONE = np.iinfo(np.int64).min
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """The random rotation of ``dim`` dimensions; the same in every task."""
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code bits packed into bytes, alignment, length) of each row."""
    turned = vectors @ rotation(vectors.shape[1])
    align = np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), align, np.sqrt((vectors ** 2).sum(1))


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bytes as 64-bit words, the last one filled with zeros."""
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class Anchors:
    """A block's anchors: whole numbers for scoring, bit planes for estimates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        floats = vectors.astype(float)
        self.length = np.sqrt((floats ** 2).sum(1))
        turned = floats @ rotation(vectors.shape[1])
        self.low = turned.min(1)
        self.step = (turned.max(1) - self.low) / (2 ** QUERY_BITS - 1)
        self.step[self.step == 0] = 1.0
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [_words(np.packbits((levels >> j) & 1, axis=1)) for j in range(QUERY_BITS)]
        near = self.low[:, None] + self.step[:, None] * levels
        self.sum = near.sum(1)
        self.error = np.sqrt(((turned - near) ** 2).sum(1))

    def interval(self, words: np.ndarray, align: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products, anchors ``at`` by rows."""
        ones = np.bitwise_count(words).sum(1, dtype=np.int32)
        held = np.zeros((len(at), len(words)), np.int32)
        for j, plane in enumerate(self.planes):
            for w in range(words.shape[1]):
                held += np.left_shift(np.bitwise_count(plane[at, w, None] & words[None, :, w]), j, dtype=np.int32)
        step, low, total, error, own = (x[at, None] for x in (self.step, self.low, self.sum, self.error, self.length))
        dot = (2 * (low * ones + step * held) - total) / np.sqrt(self.vectors.shape[1])
        rest = np.sqrt(np.maximum(length ** 2 - align ** 2, 0.0))
        least = np.maximum(np.abs(dot) - error, 0.0)
        wide = align * error + rest * np.sqrt(np.maximum(own ** 2 - least ** 2, 0.0)) + 1e-9 * length * own + 1e-6  # rounding
        return align * dot - wide, align * dot + wide


def scores(anchors: np.ndarray, rows: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Whole-number inner products where ``live``; NONE elsewhere. Many live pairs go as one product, few one by one."""
    out = np.full(live.shape, NONE, np.int64)
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * rows.shape[1]
    kind = float if most < 2.0 ** 53 else object
    i, j = np.nonzero(live)
    if kind is float and len(i) * 16 < live.size:
        out[i, j] = np.einsum("ij,ij->i", anchors[i], rows[j])
        return out
    some = live.any(0)
    got = anchors.astype(kind) @ rows[some].astype(kind).T
    if kind is object:
        got = np.clip(got, -2 ** 63 + 1, 2 ** 63 - 1)
    out[:, some] = got.astype(np.int64)
    out[~live] = NONE
    return out


class Places:
    """The ``k`` best (score, id) of each of ``n`` searches, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), NONE, np.int64), np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def floor(self, searches: np.ndarray) -> np.ndarray:
        return self.score[searches, -1]

    def offer(self, searches: np.ndarray, got: np.ndarray, ids: np.ndarray) -> None:
        """``got``: scores of ``searches`` by rows; NONE is no offer."""
        i, j = np.nonzero((got >= self.floor(searches)[:, None]) & (got != NONE))
        if not len(i):
            return
        hit, k = np.unique(searches[i]), self.score.shape[1]
        search = np.concatenate([np.repeat(hit, k), searches[i]])
        score = np.concatenate([self.score[hit].ravel(), got[i, j]])
        who = np.concatenate([self.id[hit].ravel(), ids[j]])
        order = np.lexsort((who, ~score, search))  # ~x falls as x rises, without overflow
        take = order[np.searchsorted(search[order], hit)[:, None] + np.arange(k)]
        self.score[hit], self.id[hit] = score[take], who[take]

    def batch(self, anchors: np.ndarray) -> pa.RecordBatch:
        """(anchor_id, goal, vec_id, score): the places filled; search s is anchor s // g for goal s % g."""
        goals = len(self.score) // max(1, len(anchors))
        search, place = np.nonzero(self.score != NONE)
        return pa.record_batch([pa.array(anchors[search // max(1, goals)]), pa.array((search % max(1, goals)).astype(np.int32)),
                                pa.array(self.id[search, place]), pa.array(self.score[search, place])],
                               names=["anchor_id", "goal", "vec_id", "score"])


class _Positives:
    """Best rows of the anchor's own label."""

    def __init__(self, anchors: Anchors, goals: list, k: int):
        self.anchors, self.places = anchors, Places(len(anchors.ids), k)
        self.of = {label: np.flatnonzero(anchors.labels == label) for label in np.unique(anchors.labels)}

    def take(self, ids, labels, vectors, words, align, length) -> None:
        own = self.anchors
        for label in np.unique(labels):
            at = self.of.get(label)
            if at is None:
                continue
            mine = np.flatnonzero(labels == label)
            _, upper = own.interval(words[mine], align[mine], length[mine], at)
            live = (upper >= self.places.floor(at)[:, None]) & (own.ids[at][:, None] != ids[mine][None, :])
            self.places.offer(at, scores(own.vectors[at], vectors[mine], live), ids[mine])


class _Negatives:
    """Best rows of other labels in each positive's band, from 0.8 of its score (``low``, exact) up to it."""

    def __init__(self, anchors: Anchors, goals: list, k: int):
        self.anchors, most = anchors, max(1, max(map(len, goals)))
        self.high = np.array([list(g) + [NONE] * (most - len(g)) for g in goals], np.int64)
        self.low = np.array([[-(-SHARE * p // 100) for p in row] for row in self.high.tolist()], object)
        self.low = np.clip(self.low, NONE, np.iinfo(np.int64).max).astype(np.int64)
        self.places = Places(self.high.size, k)
        self.search = np.arange(self.high.size).reshape(self.high.shape)

    def take(self, ids, labels, vectors, words, align, length) -> None:
        own, at = self.anchors, np.arange(len(self.anchors.ids))
        lower, upper = own.interval(words, align, length, at)
        possible = (self.high >= self.low) & (self.high >= 0)
        least = np.where(possible, np.maximum(self.low, self.places.score[:, -1].reshape(self.high.shape)), np.iinfo(np.int64).max)
        most = self.high.max(1)
        live = (upper >= least.min(1)[:, None]) & ((lower <= most[:, None]) | (most == np.iinfo(np.int64).max)[:, None])
        live &= own.labels[:, None] != labels[None, :]
        got = scores(own.vectors, vectors, live)
        for goal in range(self.high.shape[1]):
            inside = (got <= self.high[:, goal, None]) & (got >= least[:, goal, None])
            self.places.offer(self.search[:, goal], np.where(inside, got, NONE), ids)


def _stream(search, k: int):
    """Rows come sorted by task and length, anchors (kind 0) before the slice's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            task, dim, kind, ids, labels, align, length = (batch.column(c).to_numpy() for c in range(7))
            edges = np.flatnonzero(np.diff(task, prepend=task[:1] - 1) | np.diff(dim, prepend=dim[:1] - 1)
                                   | np.diff(kind, prepend=kind[:1] - 1)).tolist() + [batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if key != (int(task[a]), int(dim[a])):
                    if block is not None:
                        yield block.places.batch(block.anchors.ids)
                    key, held, block = (int(task[a]), int(dim[a])), [], None
                vectors = batch.column(7).slice(a, b - a).flatten().to_numpy().reshape(b - a, key[1])
                if kind[a] == 0:
                    held.append((ids[a:b], labels[a:b], vectors, batch.column(9).slice(a, b - a).to_pylist()))
                    continue
                if block is None:
                    if not held:
                        continue
                    own = [np.concatenate(x) for x in list(zip(*held))[:3]]
                    block = search(Anchors(*own), [g for x in held for g in x[3]], k)
                    chunk = max(64, PAIRS // len(own[0]))
                code = np.frombuffer(b"".join(batch.column(8).slice(a, b - a).to_pylist()), np.uint8)
                words = _words(code.reshape(b - a, -(-key[1] // 8)))
                for x in range(0, b - a, chunk):
                    cut = slice(a + x, min(b, a + x + chunk))
                    mine = slice(x, x + chunk)
                    block.take(ids[cut], labels[cut], vectors[mine], words[mine], align[cut], length[cut])
        if block is not None:
            yield block.places.batch(block.anchors.ids)
    return run


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims):
            own = batch.filter(pa.array(dims == dim))
            vectors = own.column(3).flatten().to_numpy().reshape(own.num_rows, dim).astype(float)
            code, align, length = encode(vectors)
            yield pa.record_batch([*own.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(align),
                                   pa.array(length)], names=["vec_id", "label", "dim", "v", "code", "align", "length"])


def coded_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(vec_id, label, dim, v, code, align, length) of every valid row, one per id; a written table."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    valid = rows.filter(F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    one = (valid.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(whole.alias("v"), label.cast("long").alias("label")).alias("row"))
           .groupBy("vec_id").agg(F.max("row").alias("row")).select("vec_id", "row.label", F.size("row.v").alias("dim"), "row.v"))
    return stage(one.mapInArrow(_codes, "vec_id long, label long, dim int, v array<long>, code binary, align double, length double"),
                 "negatives-codes")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, scale: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a predicate on ``vec_id``; ``label`` a whole number per row of ``rows``."""
    spark = rows.sparkSession
    vectors = coded_vectors(rows, scale, id_col, vector_col, F.col("label") if label is None else label)
    anchors = vectors.filter(is_anchor)
    blocks = max(1, -(-anchors.count() // BLOCK_ROWS))
    slices = max(1, partitions(spark) // blocks)
    columns = ("task", "dim", "kind", "vec_id", "label", "align", "length", "v", "code", "goals")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = (vectors.withColumns({"kind": F.lit(1), "goals": F.lit(None).cast("array<long>"),
                                 "slice": F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(slices)).cast("int")})
            .withColumn("block", each(blocks)).withColumn("task", F.col("block") * slices + F.col("slice")).select(*columns))

    def searched(asked: DataFrame, search, k: int, order: list[str]) -> DataFrame:
        asked = (asked.withColumns({"kind": F.lit(0), "block": block}).withColumn("slice", each(slices))
                 .withColumn("task", F.col("block") * slices + F.col("slice")).select(*columns))
        return (asked.unionByName(sent).repartition(blocks * slices, "task").sortWithinPartitions("task", "dim", "kind", *order)
                .mapInArrow(_stream(search, k), "anchor_id long, goal int, vec_id long, score long"))

    best = Window.partitionBy("anchor_id", "goal").orderBy(F.col("score").desc(), "vec_id")
    found = (searched(anchors.withColumn("goals", F.array().cast("array<long>")), _Positives, positives, ["label"])
             .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
             .select("anchor_id", (F.col("rank") - 1).alias("goal"), F.col("vec_id").alias("positive_id"),
                     F.col("score").alias("positive_score")))
    found = stage(found, "negatives-positives")
    goals = found.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("goal", "positive_score"))),
                                                       lambda x: x.positive_score).alias("goals"))
    asked = anchors.join(goals, F.col("vec_id") == F.col("anchor_id"))
    return (searched(asked, _Negatives, negatives, []).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= negatives).join(found, ["anchor_id", "goal"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
