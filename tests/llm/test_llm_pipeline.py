from collections import Counter

import pytest
from test_llm_dedup import brute_classes

import __spark_entry__ as E
import corpus_pipeline
from tillroll.llm import toxicity
from tillroll.llm.common import stage, table

SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_pipeline_stages_match_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    seen = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(step(spark, docs, SMALL), f"test-{name}")
        assert out.columns == docs.columns
        seen[name] = (before, [(r.doc_id, r.text) for r in out.collect()])
        docs = out
    model = toxicity.fit(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    before, after = seen["toxicity"]
    assert Counter(after) == Counter((i, t) for i, t in before if model.score(t or "") < 0.7)
    before, after = seen["exact_dedup"]
    keep = {}
    for i, t in before:
        keep[t] = max(keep.get(t, i), i)
    assert Counter(after) == Counter((i, t) for t, i in keep.items())
    before, after = seen["near_dedup"]
    classes = {i: c for (i, _, c) in brute_classes(before, 5, 80)}
    assert Counter(after) == Counter((i, t) for i, t in before if classes[i] == i)
    before, after = seen["mix"]
    assert set(after) <= set(before) and len(after) == len(set(after)) > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in after}


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_ball_tree"])
def test_oracles_agree(spark, name):
    from oracle_harness import compare, duck
    assert compare(spark, SMALL, name, E.queries()[name], E.oracle_sql()[name], duck(SMALL))["status"] == "match"
