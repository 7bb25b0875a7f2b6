"""Exact top-k inner products: shards by locality, ball-tree branch and bound in each, floors shared on the way.

1. A bounded sample is split at medians into cells; every row is dealt to its
   cell, and a cell to shards of bounded size by a hash (a vector that fills a
   third of the table fills many shards). A shard is one row: its vectors, in the
   order of a balanced ball tree, and the tree's centres and radii.
2. Each query searches its own shard. Its k-th score there is its floor.
3. Per cell one centre and radius is known, a table bounded by the sample. A
   query can do without a cell if <q, centre> + |q| * radius is below its floor.
   Queries of near cells form blocks of bounded size; a shard is sent to the
   blocks that have a query which its cell could serve, and to no other.
4. A task holds a block and streams a slice of its shards. Tree nodes are visited
   from the best bound down and dropped below the query's k-th score so far, in
   whichever shard it was found. A task puts out k rows per query at most, so the
   result grows with the queries, not with queries times shards.

Defined results: a row whose id or vector is NULL or whose vector holds a NULL
or non-finite component takes no part. Rows that repeat an id count once, with
the largest vector (in array order). Vectors of different lengths are not
compared. Ties go to the smaller id. With fewer than k candidates all are
returned. Scores beyond 64 bits are held at the largest value. Only the id and
vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage
from .hard_negatives import Places

#: Most vectors and numbers of a shard, vectors of a leaf, queries of a block.
SHARD_ROWS, SHARD_VALUES, LEAF_ROWS, BLOCK_ROWS = 2048, 1 << 18, 256, 4096
#: Numbers in the sample that cells are fitted on, and sample rows per cell at least.
SAMPLE_VALUES, CELL_ROWS = 1 << 20, 8
NONE = np.iinfo(np.int64).min


def shard_rows(dim: int) -> int:
    return max(1, min(SHARD_ROWS, SHARD_VALUES // max(1, dim)))


def _line(points: np.ndarray) -> np.ndarray:
    """The line between two far points."""
    far = points[np.argmax(((points - points.mean(0)) ** 2).sum(1))]
    return points[np.argmax(((points - far) ** 2).sum(1))] - far


class Cells:
    """A complete tree of ``depth`` median splits, fitted on ``sample``; ``centres`` are the sample's means."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, dim = depth, sample.shape[1]
        self.lines, self.cuts = np.zeros((2 ** depth - 1, dim)), np.full(2 ** depth - 1, np.inf)
        held = [np.arange(len(sample))]
        for node in range(2 ** depth - 1):
            own = sample[held[node]]
            side = np.zeros(len(own), bool)
            if len(own) > 1:
                self.lines[node] = _line(own)
                along = own @ self.lines[node]
                self.cuts[node] = np.median(along)
                side = along >= self.cuts[node]
            held += [held[node][~side], held[node][side]]
        self.centres = np.array([sample[x].mean(0) if len(x) else np.zeros(dim) for x in held[2 ** depth - 1:]])

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.einsum("ij,ij->i", points, self.lines[node]) >= self.cuts[node])
        return node - (2 ** self.depth - 1)


class BallTree:
    """Complete binary tree over ``points``; node j of a level has children 2j and 2j + 1 below."""

    def __init__(self, points: np.ndarray):
        self.order, self.levels = np.arange(len(points)), []
        levels = self.slices(len(points))
        for depth, slices in enumerate(levels, 1):
            self.levels.append(self._balls(points, slices))
            for a, b in slices if depth < len(levels) else ():
                if b - a > 1:
                    own = points[self.order[a:b]]
                    self.order[a:b] = self.order[a:b][np.argsort(own @ _line(own), kind="stable")]
        self.leaves = levels[-1]

    @staticmethod
    def slices(n: int) -> list[list[tuple[int, int]]]:
        out = [[(0, n)]]
        while max(b - a for a, b in out[-1]) > LEAF_ROWS:
            out.append([x for a, b in out[-1] for x in ((a, (a + b) // 2), ((a + b) // 2, b))])
        return out

    def _balls(self, points, slices):
        centres = np.array([points[self.order[a:b]].mean(0) if b > a else np.zeros(points.shape[1]) for a, b in slices])
        radii = np.array([np.sqrt(((points[self.order[a:b]] - c) ** 2).sum(1).max()) if b > a else -np.inf
                          for (a, b), c in zip(slices, centres)])
        return centres, radii

    def pack(self) -> bytes:
        return np.concatenate([x.ravel() for level in self.levels for x in level]).tobytes()

    @classmethod
    def unpack(cls, n: int, dim: int, data: bytes) -> "BallTree":
        """The tree of points that stand in its order."""
        tree, at, values = cls.__new__(cls), 0, np.frombuffer(data)
        tree.order, tree.levels = np.arange(n), []
        for slices in cls.slices(n):
            m = len(slices)
            tree.levels.append((values[at:at + m * dim].reshape(m, dim), values[at + m * dim:at + m * (dim + 1)]))
            at += m * (dim + 1)
        tree.leaves = cls.slices(n)[-1]
        return tree

    def bounds(self, queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Upper bound of every (query, leaf); -inf below a node that ``floor`` rules out."""
        norms = np.sqrt((queries ** 2).sum(1))
        best = np.full((len(queries), 1), np.inf)
        for level, (centres, radii) in enumerate(self.levels):
            if level:
                best = np.repeat(best, 2, axis=1)
            best = np.minimum(best, reach(queries, norms, centres, radii))
            best[best < floor[:, None]] = -np.inf
        return best


def reach(queries: np.ndarray, norms: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product of each query with any point of each ball; rounded up."""
    with np.errstate(invalid="ignore"):
        out = queries @ centres.T + norms[:, None] * radii[None, :]
    out = np.where(np.isnan(out), -np.inf, out)
    return out + 1e-9 * np.abs(out) + 1e-9 * norms[:, None] * np.sqrt((centres ** 2).sum(1))[None, :] + 1e-6


def search(tree: BallTree, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           floor: np.ndarray, places: Places) -> None:
    """Offer ``places`` every point that reaches its query's ``floor`` and k-th score; ``points`` stand in tree order."""
    n = len(queries)
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(1, points.shape[1]) < 2.0**53
    kind = float if exact else object
    points_k, queries_k, everyone = points.astype(kind), queries.astype(kind), np.arange(n)
    least = lambda rows: np.maximum(floor[rows], places.floor(rows))
    bounds = tree.bounds(queries.astype(float), least(everyone).astype(float))
    visit = np.argsort(-bounds, axis=1, kind="stable")
    for turn in range(bounds.shape[1]):
        leaf = visit[:, turn]
        bound = bounds[everyone, leaf]
        live = np.flatnonzero((bound > -np.inf) & (bound >= least(everyone).astype(float)))
        if not len(live):
            break
        live = live[np.argsort(leaf[live], kind="stable")]
        cuts = np.flatnonzero(np.diff(leaf[live], prepend=-1))
        for rows in np.split(live, cuts[1:]):
            a, b = tree.leaves[leaf[rows[0]]]
            got = queries_k[rows] @ points_k[a:b].T
            got = got.astype(np.int64) if exact else np.clip(got, -2**63 + 1, 2**63 - 1).astype(np.int64)
            got[(query_ids[rows][:, None] == ids[a:b][None, :]) | (got < floor[rows][:, None])] = NONE
            places.offer(rows, got, ids[a:b])


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    if not len(columns[0]):
        return []
    edge = np.zeros(len(columns[0]), bool)
    edge[0] = True
    for c in columns:
        edge[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(edge).tolist()
    return list(zip(starts, [*starts[1:], len(columns[0])]))


def _vectors(batch: pa.RecordBatch, column: str, a: int, b: int, dim: int) -> np.ndarray:
    return batch.column(column).slice(a, b - a).flatten().to_numpy().reshape(b - a, dim)


def _assign(cells: dict[int, Cells]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                points = _vectors(own, "v", 0, own.num_rows, dim).astype(float)
                at = cells[dim].of(points)
                away = np.sqrt(((points - cells[dim].centres[at]) ** 2).sum(1))
                yield pa.record_batch([*own.columns, pa.array(at.astype(np.int32)), pa.array(away)],
                                      names=["vec_id", "dim", "v", "cell", "away"])
    return assign


SHARD = "dim int, cell int, sub int, ids binary, points binary, tree binary"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shard, from rows sorted by shard."""
    key, held = None, []

    def shard():
        ids, points = (np.concatenate(x) for x in zip(*held))
        tree = BallTree(points.astype(float))
        values = (*key, ids[tree.order].tobytes(), points[tree.order].tobytes(), tree.pack())
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, [pa.int32()] * 3 + [pa.binary()] * 3)],
                               names=["dim", "cell", "sub", "ids", "points", "tree"])

    for batch in batches:
        dim, cell, sub = (batch.column(c).to_numpy() for c in ("dim", "cell", "sub"))
        for a, b in _runs(dim, cell, sub):
            if key != (int(dim[a]), int(cell[a]), int(sub[a])):
                if held:
                    yield shard()
                key, held = (int(dim[a]), int(cell[a]), int(sub[a])), []
            held.append((batch.column("vec_id").slice(a, b - a).to_numpy(), _vectors(batch, "v", a, b, key[0])))
    if held:
        yield shard()


def _load(batch: pa.RecordBatch, row: int, dim: int):
    """(tree, points, ids) of a shard row."""
    ids = np.frombuffer(batch.column("ids")[row].as_py(), np.int64)
    points = np.frombuffer(batch.column("points")[row].as_py(), np.int64).reshape(len(ids), dim)
    return BallTree.unpack(len(ids), dim, batch.column("tree")[row].as_py()), points, ids


def _home(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, the shard before its queries: (query, k-th score in its own shard, its cell)."""
        held = None
        for batch in batches:
            dim, kind = batch.column("dim").to_numpy(), batch.column("kind").to_numpy()
            for a, b in _runs(*(batch.column(c).to_numpy() for c in ("dim", "cell", "sub")), kind):
                if kind[a] == 0:
                    held = _load(batch, a, int(dim[a]))
                    continue
                ids, queries = batch.column("vec_id").slice(a, b - a).to_numpy(), _vectors(batch, "v", a, b, int(dim[a]))
                places = Places(b - a, k)
                search(*held, queries, ids, np.full(b - a, NONE), places)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("vec_id", "dim", "v", "cell")),
                                                  pa.array(places.floor(np.arange(b - a)))], names=["vec_id", "dim", "v", "cell", "floor"])
    return run


def _needs(cells: dict[int, Cells], radii: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, dim, cell) that some query of the batch can't do without."""
        for batch in batches:
            dims, blocks, floors = (batch.column(c).to_numpy() for c in ("dim", "block", "floor"))
            found = []
            for a, b in _runs(dims, blocks):
                dim = int(dims[a])
                queries = _vectors(batch, "v", a, b, dim).astype(float)
                bound = reach(queries, np.sqrt((queries ** 2).sum(1)), cells[dim].centres, radii[dim])
                hit = np.flatnonzero(((bound >= floors[a:b, None].astype(float)) & (radii[dim] >= 0)[None, :]).any(0))
                found += [(int(blocks[a]), dim, int(c)) for c in hit]
            found = list(zip(*sorted(set(found)))) or [(), (), ()]
            yield pa.record_batch([pa.array(x, pa.int32()) for x in found], names=["block", "dim", "cell"])
    return run


def _grid(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task and length, a block's queries before the shards of the slice."""
        key, held, block = None, [], None

        def answer():
            ids, _, _, places = block
            search_at, place = np.nonzero(places.score != NONE)
            return pa.record_batch([pa.array(ids[search_at]), pa.array(places.id[search_at, place]), pa.array(places.score[search_at, place])],
                                   names=["query_id", "vec_id", "score"])

        for batch in batches:
            task, dim, kind = (batch.column(c).to_numpy() for c in ("task", "dim", "kind"))
            for a, b in _runs(task, dim, kind):
                if key != (int(task[a]), int(dim[a])):
                    if block is not None:
                        yield answer()
                    key, held, block = (int(task[a]), int(dim[a])), [], None
                if kind[a] == 0:
                    held.append((batch.column("vec_id").slice(a, b - a).to_numpy(), _vectors(batch, "v", a, b, key[1]),
                                 batch.column("floor").slice(a, b - a).to_numpy()))
                    continue
                if block is None:
                    if not held:
                        continue
                    own = [np.concatenate(x) for x in zip(*held)]
                    block = (*own, Places(len(own[0]), k))
                for row in range(a, b):
                    search(*_load(batch, row, key[1]), block[1], block[0], block[2], block[3])
        if block is not None:
            yield answer()
    return run


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every valid vector, one row per id."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return (rows.filter(F.col(id_col).isNotNull() & v.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
            .groupBy("vec_id").agg(F.max("v").alias("v")))


def _fit_cells(vectors: DataFrame) -> dict[int, Cells]:
    """Cells per vector length, fitted on at most SAMPLE_VALUES numbers; at most one cell per CELL_ROWS sample rows."""
    sizes = {r.dim: r.n for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    rows = max(1, SAMPLE_VALUES // max(1, *sizes))
    sample = vectors.select("vec_id", "dim", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).toArrow()
    dims, out = sample.column("dim").to_numpy(), {}
    for dim, n in sizes.items():
        own = sample.filter(pa.array(dims == dim)).column("v").combine_chunks()
        points = own.flatten().to_numpy().reshape(len(own), dim).astype(float) if len(own) else np.zeros((0, dim))
        depth = max(0, min(math.ceil(math.log2(n / shard_rows(dim))), int(math.log2(max(1, len(points) // CELL_ROWS)))))
        out[dim] = Cells(points, depth)
    return out


def top_k(rows: DataFrame, is_query, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a predicate on ``vec_id``."""
    spark = rows.sparkSession
    vectors = stage(integer_vectors(rows, id_col, vector_col, scale).withColumn("dim", F.size("v")).select("vec_id", "dim", "v"), "topk-vectors")
    cells = _fit_cells(vectors)
    dealt = stage(vectors.mapInArrow(_assign(cells), "vec_id long, dim int, v array<long>, cell int, away double"), "topk-cells")
    # a row per cell: the sample bounds their number
    table = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.count_if(is_query).alias("asked")).collect()
    radii = {dim: np.full(2 ** c.depth, -np.inf) for dim, c in cells.items()}
    for r in table:
        radii[r.dim][r.cell] = r.radius * (1 + 1e-9) + 1e-9
    plan, block, filled = [], 0, 0
    for r in sorted(table, key=lambda r: (r.dim, r.cell)):  # near cells share a block; a cell with many queries has several
        if filled and filled + r.asked > BLOCK_ROWS:
            block, filled = block + 1, 0
        many = max(1, -(-r.asked // BLOCK_ROWS))
        plan.append((r.dim, r.cell, -(-r.n // shard_rows(r.dim)), block, many))
        block, filled = (block + many, 0) if many > 1 else (block, filled + r.asked)
    blocks = block + 1
    placed = spark.createDataFrame(plan, "dim int, cell int, subs int, first_block int, blocks int")
    dealt = dealt.drop("away").join(F.broadcast(placed), ["dim", "cell"])
    dealt = dealt.withColumn("sub", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("subs")).cast("int"))
    shard = ("dim", "cell", "sub")
    shards = stage(dealt.select(*shard, "vec_id", "v").repartition(partitions(spark), *shard).sortWithinPartitions(*shard, "vec_id")
                   .mapInArrow(_build, SHARD), "topk-shards")

    def empty(*columns: str):
        types = {"vec_id": "long", "v": "array<long>", "floor": "long", "ids": "binary", "points": "binary", "tree": "binary"}
        return [F.lit(None).cast(types[c]).alias(c) for c in columns]

    blobs = ("ids", "points", "tree")
    asked = dealt.filter(is_query)
    home = (shards.select(*shard, F.lit(0).alias("kind"), *empty("vec_id", "v"), *blobs)
            .unionByName(asked.select(*shard, F.lit(1).alias("kind"), "vec_id", "v", *empty(*blobs)))
            .repartition(partitions(spark), *shard).sortWithinPartitions(*shard, "kind", "vec_id"))
    floors = home.mapInArrow(_home(k), "vec_id long, dim int, v array<long>, cell int, floor long")
    block_of = (F.col("first_block") + F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("blocks"))).cast("int")
    queries = stage(floors.join(F.broadcast(placed), ["dim", "cell"]).select("vec_id", "dim", "v", "floor", block_of.alias("block")), "topk-queries")

    needs = queries.mapInArrow(_needs(cells, radii), "block int, dim int, cell int").distinct()
    slices = max(1, partitions(spark) // blocks)
    task = lambda at: (F.col("block") * slices + at).cast("int").alias("task")
    sent = shards.join(needs, ["dim", "cell"]).select(
        task(F.pmod(F.xxhash64("cell", "sub"), F.lit(slices))), "dim", F.lit(1).alias("kind"), *empty("vec_id", "v", "floor"), *blobs)
    asking = queries.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select(
        task(F.col("at")), "dim", F.lit(0).alias("kind"), "vec_id", "v", "floor", *empty(*blobs))
    found = (asking.unionByName(sent).repartition(blocks * slices, "task").sortWithinPartitions("task", "dim", "kind")
             .mapInArrow(_grid(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
