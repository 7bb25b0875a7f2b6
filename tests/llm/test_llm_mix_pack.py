import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import edge_docs, edge_texts, empty_docs
from tokenizers import Tokenizer

import corpus_pipeline
from tillroll.llm import mixing, packing, sharding

BPE = public_tokenizers.path("byte_bpe_50k.json")


def brute_schedule(weight, slots):
    """Slot by slot: the released block with the earliest deadline."""
    total, done, out = sum(weight), [0] * len(weight), []
    for t in range(slots):
        ready = [(-(-(done[s] + 1) * total // w), s) for s, w in enumerate(weight) if done[s] * total // w <= t]
        out.append(min(ready)[1])
        done[out[-1]] += 1
    return out


def one_phase(weight, slots):
    total = sum(weight)
    return [{"phase": 0, "start": 0, "slots": slots, "total": total, "first": [0] * len(weight), "weight": weight,
             "taken": [slots] * len(weight)}]


ZIPF = list(mixing.whole_weights({f"{k:02}": 1 / k for k in range(1, 31)}).values())


@pytest.mark.parametrize("weight, slots", [([1, 1, 1], 2500), ([5, 3, 2], 1700), ([997, 1, 1, 1], 3100), ([7], 10), (ZIPF, 3300), ([90] + [1] * 30, 2100)])
def test_schedule_is_earliest_deadline_first_and_within_a_block(spark, weight, slots):
    rows = mixing.schedule(spark, one_phase(weight, slots)).orderBy("slot").collect()
    got = [r.pos for r in rows]
    assert got == brute_schedule(weight, slots) and all(r.release <= r.slot < r.deadline for r in rows)
    seen = [0] * len(weight)
    for t, s in enumerate(got, 1):
        assert rows[t - 1].block == seen[s]
        seen[s] += 1
        assert all(abs(n * sum(weight) - w * t) < sum(weight) for n, w in zip(seen, weight))


def test_zipf_weights_hold_over_fifty_thousand_blocks(spark):
    """Against the weights 1/k themselves, not their whole parts."""
    harmonic = sum(1 / k for k in range(1, 31))
    got = [r.pos for r in mixing.schedule(spark, one_phase(ZIPF, 50_000)).orderBy("slot").collect()]
    counts = np.cumsum(np.eye(30, dtype=int)[got], axis=0)
    line = np.outer(np.arange(1, 50_001), [1 / k / harmonic for k in range(1, 31)])
    assert np.abs(counts - line).max() < 1.01  # rounding to PARTS adds at most 0.003 here


def test_cycles_with_a_short_start_are_made_again(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CYCLE", 50)
    weight = [31, 17, 5, 3]
    got = [r.pos for r in mixing.schedule(spark, one_phase(weight, 400), warm=1).orderBy("slot").collect()]
    assert got == brute_schedule(weight, 400)


def test_weights_become_whole_numbers():
    assert mixing.whole_weights({"a": 1, "b": 1.0, "c": 0}) == {"a": 1, "b": 1}
    assert mixing.whole_weights({"a": 0.5, "b": 0.3, "c": 0.2}) == {"a": 5, "b": 3, "c": 2}
    odd = mixing.whole_weights({"a": 2 ** 0.5, "b": 1e-12})
    assert odd["b"] == 1 and abs(odd["a"] - mixing.PARTS) <= 1 and mixing.whole_weights({}) == {}


def test_phases_use_every_block_once():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randint(1, 12)
        blocks, weight = [rnd.randint(1, 60) for _ in range(n)], [rnd.randint(1, 40) for _ in range(n)]
        out = mixing.phases(blocks, weight)
        assert len(out) <= n and [sum(p["taken"][s] for p in out) for s in range(n)] == blocks
        for p in out:
            assert all(t <= w * p["slots"] / p["total"] for t, w in zip(p["taken"], p["weight"]))


def test_mix_follows_its_weights(spark):
    docs = spark.createDataFrame([(i, "t", "abc"[min(2, i % 6)]) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, {"a": 5, "b": 3, "c": 2}, block_rows=4).collect()
    assert len(rows) == 3000 and len({r.place for r in rows}) == 3000
    assert all(r.release <= r.slot < r.deadline for r in rows)
    plan = defaultdict(Counter)
    for r in rows:
        if r.scheduled:
            plan[r.slot][r.source] += 1
    assert sorted(plan) == list(range(len(plan))) and all(len(x) == 1 for x in plan.values())
    assert len(plan) >= 125 / 0.5 - 2  # source a has 125 blocks
    seen = Counter()
    for t in range(len(plan)):
        seen[next(iter(plan[t]))] += 1
        assert all(abs(seen[s] - w * (t + 1)) < 1 for s, w in (("a", .5), ("b", .3), ("c", .2)))
    order = [r.doc_id for r in mixing.mixed_rows(docs, {"a": 5, "b": 3, "c": 2}).collect()]
    assert order == [r.id for r in sorted((r for r in rows if r.scheduled), key=lambda r: r.place)]


def test_pipeline_mix_keeps_every_document(spark):
    sources = ["hot"] * 400 + [f"s{i % 19}" for i in range(380)] + [f"s{i % 19}" for i in range(200)] + ["rare"] * 2 + [None] * 5
    docs = spark.createDataFrame(list(enumerate(sources)), "doc_id long, source string").repartition(3)
    got = [r.doc_id for r in corpus_pipeline.mix_stage(spark, docs, "").collect()]
    assert sorted(got) == list(range(len(sources)))
    plan = sorted(mixing.mix(docs, power=corpus_pipeline.MIX_POWER).collect(), key=lambda r: r.place)
    ended = [r.scheduled for r in plan].index(False)  # the hot source goes on after the first one that ran out
    assert got == [r.id for r in plan] and not any(r.scheduled for r in plan[ended:])
    assert sum(sources[i] == "hot" for i in got[ended:]) > 100


def test_first_sequences_follow_the_mix(spark):
    """Whatever the documents' stored order, the sequences' sources follow the target from the first one on."""
    from tillroll.llm.common import stage
    rnd = random.Random(6)
    sources = ["hot"] * 6000 + ["b"] * 3000 + ["c"] * 3000
    docs = spark.createDataFrame([(i, " ".join("word" for _ in range(rnd.randint(150, 250))), s) for i, s in enumerate(sources)],
                                 "doc_id long, text string, source string")
    mixed = stage(corpus_pipeline.mix_stage(spark, docs.orderBy("source"), ""), "test-mixed")
    packed = corpus_pipeline.pack_stage(spark, mixed, "").collect()
    assert sorted(r.doc_id for r in packed) == list(range(12_000))
    order = [r.doc_id for r in mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()]
    place = {d: k for k, d in enumerate(order)}
    by_sequence = [place[r.doc_id] for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset))]
    assert max(abs(a - b) for a, b in enumerate(by_sequence)) <= 2 * 4096
    total = 6000 ** 0.7 + 2 * 3000 ** 0.7
    ids = sorted({r.sequence_id for r in packed})
    head = set(ids[:800])
    first = Counter(sources[r.doc_id] for r in packed if r.sequence_id in head)
    n = sum(first.values())
    assert abs(first["hot"] / n - 6000 ** 0.7 / total) < 0.03 and abs(first["b"] / n - 3000 ** 0.7 / total) < 0.03


def test_mix_edge_cases(spark):
    rows = mixing.mix(edge_docs(spark)).collect()
    assert len(rows) == len(edge_texts())
    assert {r.source for r in rows} == {"a", "b", None}
    none = mixing.mix(edge_docs(spark), {"zzz": 1.0}).collect()
    assert len(none) == len(rows) and not any(r.scheduled for r in none)
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.mixed_rows(empty_docs(spark)).count() == 0


def test_tokens_are_those_of_the_tokenizer(spark):
    whole = Tokenizer.from_file(BPE)
    assert whole.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    odd = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n y", "<|endoftext| >", "", "  a\n\n b  ", "naïve café — “quote” 中文 <|endoftext|> I'll x\x1cy\xa0\x85 ½²³ ʼn ΑΒΓ 😀", "don't WE'RE 've \r\n\r\n x", "\x1c\x1c a  b　c"]
    texts = list(enumerate(odd)) + [(100 + k, t) for k, (_, t) in enumerate(edge_texts())]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    pieces = packing.tokenise(docs, BPE, 1024, 2, with_ids=True).collect()
    got = defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and r.start == len(got[r.doc_id]) and zlib.crc32(r.ids) == r.ids_crc32
        got[r.doc_id] += ids.tolist()
    for i, t in texts:
        assert got[i] == whole.encode(t or "", add_special_tokens=False).ids + [2]


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_best_two_fit_fills_bins():
    rnd = random.Random(4)
    for size, n in ((10, 60), (1024, 3000), (1024, 1)):
        lengths = np.array([rnd.randint(1, size) for _ in range(n)])
        bins, offset = packing.best_two_fit(lengths, size)
        held = defaultdict(list)
        for b, o, x in zip(bins, offset, lengths):
            held[b].append((o, x))
        for places in held.values():
            at = 0
            for o, x in sorted(places):
                assert o == at
                at += x
            assert at <= size
        assert len(held) <= -(-lengths.sum() // size) * 1.02 + 1


def test_swap_of_one_for_two():
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)  # 6+3 leaves 1; 6+2+2 leaves none
    assert sorted(Counter(bins.tolist()).values()) == [1, 3]


def test_pack_edge_cases(spark):
    rows = packing.pack_documents(edge_docs(spark), BPE).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    assert all([o for o, _ in sorted(p)] == list(np.cumsum([0] + [x for _, x in sorted(p)])[:-1]) for p in places.values())
    assert len(places) <= -(-sum(r.length for r in rows) // 1024) + 2
    assert packing.pack_documents(empty_docs(spark), BPE).count() == 0


def test_sharding_balances_and_keeps_copies_together(spark):
    texts = edge_texts() + [(1000 + i, f"pair {i // 2}") for i in range(400)] + [(5000 + i, "hot") for i in range(250)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = sharding.shard_rows(docs, shards=7).collect()
    assert Counter((r.id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    where = defaultdict(set)
    for r in rows:
        if 1000 <= (r.id or 0) < 1400:
            where[(r.id - 1000) // 2].add(r.shard)
    assert sum(len(x) > 1 for x in where.values()) <= 20  # by a hash alone about 171
    assert sharding.shard_rows(empty_docs(spark)).count() == 0
