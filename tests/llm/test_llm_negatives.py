import numpy as np
from oracle_harness import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.llm import hard_negatives as H

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, align string, dim string, task string, goal int"


def floors(vector, scale=256):
    return [int(np.floor(float(np.float32(x)) * scale)) for x in vector]


def brute(rows, anchor=lambda i: i % 10 == 0):
    """(anchor, positive, rank, negative, positive score, negative score); rows: id -> (vector, label)."""
    out = []
    for a, (q, label) in rows.items():
        if not anchor(a):
            continue
        got = sorted((-sum(x * y for x, y in zip(q, v)), i, m) for i, (v, m) in rows.items() if i != a and len(v) == len(q))
        for p, i, _ in [g for g in got if g[2] == label][:5]:
            band = [(n, j) for n, j, m in got if m != label and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(band, 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "t", 1) for r in rows], SCHEMA)


def mined(spark, rows):
    return sorted(map(tuple, H.mine(frame(spark, rows).repartition(5), F.col("vec_id") % 10 == 0).collect()))


def test_matches_brute_force_with_ties_repeats_and_bad_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.integers(-2, 3, 7).astype(float).tolist(), int(rnd.integers(0, 3))) for i in range(150)]  # few values: many ties
    rows += [(i, rnd.standard_normal(100).tolist(), i % 2) for i in range(200, 320)]  # another length
    rows += [(i, [0.0] * 7, 1) for i in range(400, 420)] + [(i, [-1.0] * 7, 5) for i in (430, 431, 440)]
    good = {i: (floors(v), m) for i, v, m in rows}
    rows += rows[:20] + [(500, None, 1), (510, [1.0, None], 1), (520, [float("nan")] * 7, 1), (530, [float("inf")] * 7, 1), (None, [1.0] * 7, 1),
                         (540, [1.0] * 7, None), (550, [], 1), (560, [], 2)]
    rows.append((0, [-9.0] * 7, 2))  # a smaller vector under a known id
    good[0] = (max(good[0][0], floors([-9.0] * 7)), good[0][1])
    assert mined(spark, rows) == sorted(brute(good))


def test_blocks_slices_and_chunks_change_nothing(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.standard_normal(12).tolist(), int(i % 3 == 0)) for i in range(300)]
    expected = sorted(brute({i: (floors(v), m) for i, v, m in rows}))
    assert expected and mined(spark, rows) == expected
    monkeypatch.setattr(H, "BLOCK_ROWS", 7)
    assert mined(spark, rows) == expected


def test_intervals_hold_and_rule_rows_out():
    rnd = np.random.default_rng(5)
    for dim, spread in ((3, 1.0), (64, 0.1), (130, 0.1)):
        centres = rnd.standard_normal((8, dim))
        at = rnd.integers(0, 8, 600)
        points = np.floor(256 * (centres[at] + spread * rnd.standard_normal((600, dim)))).astype(np.int64)
        code, align, length = H.encode(points.astype(float))
        anchors = H.Anchors(np.arange(20), at[:20], points[:20])
        low, high = anchors.interval(H._words(code), align, length, np.arange(20))
        true = points[:20] @ points.T
        assert (low <= true).all() and (true <= high).all()
    best = np.sort(np.where(at[:20, None] == at[None, :], true, H.NONE), axis=1)[:, -6]
    assert (high < 0.8 * best[:, None]).mean() > 0.5  # clustered vectors: most rows are ruled out unscored


def test_huge_values_are_held(spark):
    rows = [(0, [3e15, 3e15], 1), (1, [3e15, 3e15], 1), (2, [2e15, 3e15], 2), (3, [1.0, -1.0], 2)]
    out = mined(spark, rows)
    assert [(r[1], r[3]) for r in out] == [(1, 2)] and out[0][4] == 2 ** 63 - 1


def test_empty_tables(spark):
    assert H.mine(frame(spark, [(1, [1.0], 1)]).limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(10, [1.0], 1)]) == []


def test_oracle_agrees(spark):
    name = "op13_one_bit_negatives"
    assert compare(spark, SMALL, name, E.queries()[name], E.oracle_sql()[name], duck(SMALL))["status"] == "match"
