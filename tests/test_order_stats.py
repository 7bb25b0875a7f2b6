import numpy as np
from pyspark.sql import functions as F

from tillroll.operators.order_stats import first_rows, quantiles, running


def test_quantiles_match_numpy_with_hot_values_and_nulls(spark):
    rnd = np.random.default_rng(1)
    a = np.concatenate([np.full(300, 7.0), rnd.normal(size=600)])
    rows = [(float(x), None if i % 3 else int(i % 11), None) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b long, c double").repartition(6)
    probs = (0.0, 0.1, 0.25, 0.5, 0.77, 1.0)
    got = {(r.column, r.p): r.value for r in quantiles(df, ["a", "b", "c"], probs).collect()}
    want = {("a", p): float(np.quantile(a, p)) for p in probs}
    want |= {("b", p): float(np.quantile([r[1] for r in rows if r[1] is not None], p)) for p in probs}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert quantiles(df.limit(0), ["a"], (0.5,)).collect() == []


def test_running_sums_match_brute_force(spark):
    rnd = np.random.default_rng(2)
    rows = [("k" if i % 3 else f"k{i % 5}", i, int(n)) for i, n in enumerate(rnd.integers(1, 9, 500))]
    out = running(spark.createDataFrame(rows, "key string, at long, n long").repartition(5), [F.col("at").desc()], ["key"]).collect()
    for r in out:
        assert r.before == sum(n for k, at, n in rows if k == r.key and at > r["at"])
    assert len(out) == len(rows)


def test_first_rows_match_a_sort(spark):
    rnd = np.random.default_rng(3)
    rows = [("hot" if i % 3 == 0 else None if i % 17 == 0 else f"c{int(rnd.integers(0, 40)):02}", int(rnd.integers(0, 6)), i % 4) for i in range(900)]
    df = spark.createDataFrame(rows, "code string, day int, x int").repartition(7)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], r[2]))
    for n in (0, 1, 37, 400, 895, 5000):
        assert [tuple(r) for r in first_rows(df, ["code", "day", "x"], n).collect()] == ordered[:n]


def test_describe_matches_numpy(spark):
    from tillroll.operators.profile import describe
    x = [1.0, 2.0, 2.0, 10.0, None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(x)], "x double, i int")
    r = {r.column: r for r in describe(df, ["x", "i"]).collect()}
    v = np.array(x[:4])
    assert (r["x"]["count"], r["i"]["count"], r["x"]["min"], r["x"]["max"]) == (4, 5, 1.0, 10.0)
    assert [r["x"][c] for c in ("q25", "q50", "q75")] == np.quantile(v, (0.25, 0.5, 0.75)).tolist() and r["x"]["std"] == round(v.std(ddof=1), 6)


def test_first_rows_sort_only_what_the_cut_leaves(spark):
    """The sort above the semi join is all that a task merges; the counts under it combine before their exchange."""
    import io
    from contextlib import redirect_stdout
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("code"), F.col("id").alias("day"), F.lit("w").alias("wide"))
    text = io.StringIO()
    with redirect_stdout(text):
        first_rows(df, ["code", "day"], 20).explain()
    plan = text.getvalue()
    assert plan.index("TakeOrderedAndProject") < plan.index("LeftSemi")
