import hashlib
import random
from collections import Counter

import numpy as np
from helpers import edge_docs, edge_texts, empty_docs

from tillroll.llm import exact_dedup, golomb, near_dedup


def test_golomb_round_trip():
    rnd = np.random.RandomState(1)
    for n, low, span in ((1, 0, 1 << 64), (700, 1 << 63, 1 << 60), (3, 5, 40), (0, 9, 10)):
        hashes = np.unique(np.uint64(low) + (rnd.randint(0, 1 << 62, n).astype(np.uint64) % np.uint64(min(span, (1 << 64) - 1))))
        k = golomb.parameter(span, len(hashes))
        code = golomb.encode(hashes, low, k)
        assert (golomb.decode(code, len(hashes), low, k) == hashes).all()
        if n == 700:
            assert len(code) < 8.5 * n


def test_exact_dedup_matches_brute_force(spark):
    texts = [(i, t or "") for i, t in edge_texts()]
    sizes, keep = Counter(t for _, t in texts), {}
    for i, t in texts:
        keep[t] = max((x for x in (keep.get(t), i) if x is not None), default=None)
    want = Counter((i, keep[t], sizes[t], i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(edge_docs(spark)).collect())
    assert got == want
    stay = exact_dedup.keep_rows(edge_docs(spark))
    assert Counter((r.doc_id, r.text or "") for r in stay.collect()) == Counter((i, t) for t, i in keep.items())
    assert stay.columns == edge_docs(spark).columns


def test_dedup_of_empty_tables(spark):
    assert exact_dedup.exact_dedup(empty_docs(spark)).count() == 0
    assert exact_dedup.keep_rows(empty_docs(spark)).count() == 0
    assert near_dedup.near_duplicates(empty_docs(spark)).count() == 0


def shingle_set(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_classes(texts, words, percent):
    sets = [(i, shingle_set(t, words)) for i, t in texts]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets[:x]):
            if a and b and None not in (i, j) and 100 * len(a & b) >= percent * len(a | b):
                up[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return Counter((i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets))


def test_near_duplicates_match_brute_force(spark):
    got = near_dedup.near_duplicates(edge_docs(spark), words=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(edge_texts(), 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chain_of_edits_is_one_class(spark):
    """Neighbours are similar, ends are not: only the links between copies join them."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(24):
        words = list(words)
        words[rnd.randrange(100)] = f"new{i}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, words=4).collect())
    assert got == brute_classes(texts, 4, 80)


def test_estimate_is_close_and_registers_follow_sets():
    rnd = np.random.RandomState(2)
    for n, shared in ((40, 36), (400, 300), (5000, 4500)):
        pool = np.unique(rnd.randint(0, 1 << 62, 2 * n).astype(np.uint64) * np.uint64(3))
        a, b = np.sort(pool[:n]), np.sort(pool[n - shared:2 * n - shared])
        j, error = near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(b)[None], np.array([float(n)]), np.array([float(n)]))
        assert abs(j[0] - shared / (2 * n - shared)) < 6 * error[0]
        assert (near_dedup.registers(a) == near_dedup.registers(a.copy())).all()


def test_near_dedup_sends_python_bounded_batches(spark, tmp_path):
    """Full sets go to Python in small batches, in every step; the session's own number of rows stands afterwards."""
    from unittest import mock

    from tillroll.llm import near_dedup
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stage = spark.conf.get(key), [], near_dedup.stage

    def watched(df, name):
        seen.append(int(spark.conf.get(key)))
        return stage(df, name)

    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"end{i}"])) for i in range(40)] + [(99, "alone")], "doc_id long, text string")
    with mock.patch.object(near_dedup, "stage", watched):
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert seen and max(seen) <= 256 and spark.conf.get(key) == before
    assert got == {**dict.fromkeys(range(40), 0), 99: 99}
