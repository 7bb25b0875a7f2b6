import math
import zlib
from collections import Counter

import numpy as np
from helpers import edge_docs, empty_docs

import __spark_entry__ as E
from tillroll.llm import langid
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string"


def lower(c):
    return c.lower() if len(c.lower()) == 1 else c


def brute_grams(text):
    """Buckets of a text's grams, word by word."""
    word, words = "", []
    for c in text + " ":
        if c.isalpha():
            word += lower(c)
        elif word:
            words.append(f" {word} ")
            word = ""
    out = Counter()
    for w in words:
        for n in (1, 2, 3):
            for gram in (w[i:i + n] for i in range(len(w) - n + 1)):
                if gram != " ":
                    h = n
                    for c in gram:
                        h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) % 2 ** 64
                        h ^= h >> 29
                    out[h >> 48] += 1
    return out


def brute(rows):
    """(doc_id, held_out, lang, score) of (doc_id, text, lang) rows."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    counts, texts = {}, Counter()
    for i, text, lang in rows:
        if lang is not None and i is not None and not held(i):
            counts.setdefault(lang, Counter()).update(brute_grams(text or ""))
            texts[lang] += 1
    out = []
    for i, text, _ in rows:
        grams, best = brute_grams(text or ""), {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
            best[lang] = math.log(texts[lang] / sum(texts.values())) + sum(
                n * math.log((counts[lang][b] + 0.5) / total) for b, n in grams.items())
        if not grams or not best:
            out.append((i, held(i), "und", 0.0))
            continue
        lang = max(sorted(best), key=best.get)
        out.append((i, held(i), lang, 1 / sum(math.exp(max(-700, v - best[lang])) for v in best.values())))
    return out


def agree(got, expected):
    key = lambda r: (str(r[0]), r[2], round(r[3], 4))
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], atol=1e-7)


def test_predictions_match_brute_force(spark):
    texts = {"xx": ["Alpha beta gamma", "beta beta İstanbul", "ßharp"], "yy": ["дом и сад", "Сад дом", None], "zz": ["κόσμος 12", "étude"]}
    rows = [(10 * k + j + 40, t, lang) for k, lang in enumerate(texts) for j, t in enumerate(texts[lang] * 3)]
    rows += [(1, "beta дом", None), (2, None, "xx"), (3, "12 -- !", "yy"), (None, "sad beta", "zz"), (4, "", None), (5, "a", None), (5, "a", None),
             (6, "\U0001d400\U0001f600 \x00ab", ""), (7, "word " * 30_000, "xx")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], COLUMNS).repartition(3)
    agree(langid.predict(docs, langid.fit(docs)).collect(), brute(rows))


def test_edge_tables(spark):
    docs = edge_docs(spark)
    got = langid.predict(docs, langid.fit(docs)).collect()
    agree(got, brute([(r.doc_id, r.text, r.lang) for r in docs.collect()]))
    assert {r.lang_pred for r in got} == {"en", "und"}
    assert langid.predict(empty_docs(spark), langid.fit(empty_docs(spark))).collect() == []
    unlabelled = spark.createDataFrame([(1, "some words", None, "s")], COLUMNS)
    assert [tuple(r) for r in langid.predict(unlabelled, langid.fit(unlabelled)).collect()] == [(1, False, "und", 0.0)]


def test_slabs_cut_between_words_and_change_nothing(monkeypatch):
    text = "ab cde\nf" * 50 + "g" * 40
    whole = Counter(langid.grams([text])[1].tolist())
    monkeypatch.setattr(langid, "SLAB", 16)
    places, parts = zip(*[(p, q) for at, pieces in langid.slabs([None, text, ""]) for p, q in zip(at, pieces)])
    assert set(places) == {1} and "".join(parts) == text and len(parts) > 20
    cut = Counter(b for p in parts[:20] for b in langid.grams([p])[1].tolist())
    assert not cut - whole


def test_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    out = E.queries()["op11_naive_bayes_langid"](spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and len(held) > 250
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in out)
