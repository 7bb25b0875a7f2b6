import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import topk
from tillroll.llm.hard_negatives import Places


def brute(held, k, queries):
    out = set()
    for q in queries:
        best = sorted((-sum(a * b for a, b in zip(held[q], v)), i) for i, v in held.items() if i != q and len(v) == len(held[q]))[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


def clustered(n, dim, seed=1, spread=0.05):
    rnd = np.random.default_rng(seed)
    centres = 3 * rnd.standard_normal((16, dim))
    return centres[rnd.integers(0, 16, n)] + spread * rnd.standard_normal((n, dim))


@pytest.mark.parametrize("shard, leaf, block", [(40, 8, 7), (2048, 256, 4096), (16, 4, 1)])
def test_shards_leaves_and_blocks_change_nothing(spark, monkeypatch, shard, leaf, block):
    for name, value in (("SHARD_ROWS", shard), ("LEAF_ROWS", leaf), ("BLOCK_ROWS", block)):
        monkeypatch.setattr(topk, name, value)
    points = clustered(500, 6)
    points[300:420] = points[0]  # one vector in a quarter of the rows
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()}
    held = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    assert got == brute(held, 5, [i for i in held if i % 20 == 0])


def test_cells_that_no_query_can_use_are_not_sent():
    """Clustered vectors: each block needs few cells, and every cell that holds one of its results is among them."""
    points = np.floor(64 * clustered(4000, 16)).astype(np.int64)
    cells = topk.Cells(points[:2000].astype(float), 5)
    at = cells.of(points.astype(float))
    away = np.sqrt(((points - cells.centres[at]) ** 2).sum(1))
    radii = np.array([away[at == c].max() if (at == c).any() else -np.inf for c in range(32)])
    queries = np.arange(0, 4000, 40)
    score = points[queries] @ points.T
    score[np.arange(len(queries)), queries] = topk.NONE
    floor = []
    for row, q in enumerate(queries):  # the k-th score in the query's own cell
        own = np.sort(score[row][at == at[q]])[::-1]
        floor.append(int(own[9]) if len(own) > 9 else topk.NONE)
    order = np.argsort(at[queries], kind="stable")
    batch = pa.record_batch([pa.array(queries[order]), pa.array([16] * len(queries), pa.int32()), pa.array(points[queries[order]].tolist(), pa.list_(pa.int64())),
                             pa.array(np.array(floor)[order]), pa.array(at[queries[order]].astype(np.int32))],
                            names=["vec_id", "dim", "v", "floor", "block"])
    needs = {(r["block"], r["cell"]) for out in topk._needs({16: cells}, {16: radii})([batch]) for r in out.to_pylist()}
    blocks = set(at[queries].tolist())
    assert len(needs) < 0.5 * len(blocks) * len(set(at.tolist()))
    for row, q in enumerate(queries):
        best = np.argsort(-score[row], kind="stable")[:10]
        assert {(int(at[q]), int(at[x])) for x in best} <= needs


def test_tree_bounds_hold_and_survive_packing(monkeypatch):
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    points = np.floor(64 * clustered(300, 5)).astype(np.int64)
    tree = topk.BallTree(points.astype(float))
    ordered = points[tree.order]
    packed = topk.BallTree.unpack(len(points), 5, tree.pack())
    queries = points[:20]
    bounds = packed.bounds(queries.astype(float), np.full(20, -np.inf))
    for leaf, (a, b) in enumerate(packed.leaves):
        assert (bounds[:, leaf, None] >= queries @ ordered[a:b].T).all()
    assert np.array_equal(bounds, tree.bounds(queries.astype(float), np.full(20, -np.inf)))
    places = Places(20, 3)
    topk.search(packed, ordered, tree.order, queries, np.arange(20), np.full(20, topk.NONE), places)
    for q in range(20):
        want = sorted((-int(queries[q] @ points[i]), i) for i in range(300) if i != q)[:3]
        assert list(zip((-places.score[q]).tolist(), places.id[q].tolist())) == want
