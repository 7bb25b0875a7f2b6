import itertools

from pyspark.sql import functions as F

from tillroll.operators.recommend import browse_products, exact_or_substring, recommend, rule_products, similar_match
from tillroll.operators.rules import association_rules, baskets, rule_holdout_confidence


def _lines(spark, baskets_):
    rows = [(f"{i}", item) for i, items in enumerate(baskets_) for item in items]
    return spark.createDataFrame(rows, "invoice_no string, item string")


def dice(a, b):
    """Dice coefficient of the distinct character pairs of the padded, upper-cased names."""
    pairs = lambda t: {f" {t.upper()} "[i:i + 2] for i in range(len(t) + 1)}
    x, y = pairs(a), pairs(b)
    return 2.0 * len(x & y) / (len(x) + len(y))


def best_similar(term, names):
    """(name, score) of the most similar name at 0.5 or more, ties by name."""
    scored = sorted((-dice(term, n), n) for n in names)
    return (scored[0][1], -scored[0][0]) if scored and scored[0][0] <= -0.5 else None


TRAIN = [["A", "B", "C"], ["A", "B", "C"], ["A", "B"], ["A", "C"], ["B", "C"], ["D"], ["A", "B", "C", "D"]]


def test_fpgrowth_pairs_match_brute_force(spark):
    rules = association_rules(baskets(_lines(spark, TRAIN)), 0.2, 0.3).collect()
    n = len(TRAIN)
    sup = lambda s: sum(1 for b in TRAIN if set(s) <= set(b)) / n
    expect = {}
    for a, b in itertools.permutations("ABCD", 2):
        s = sup([a, b])
        if s >= 0.2 and s / sup([a]) >= 0.3:
            expect[(a, b)] = (s, s / sup([a]), s / sup([a]) / sup([b]))
    got = {(r["LHS"], r["RHS"]): (r["support"], r["confidence"], r["lift"]) for r in rules if "," not in r["LHS"]}
    assert got.keys() == expect.keys()
    for k, v in expect.items():
        assert all(abs(x - y) < 1e-12 for x, y in zip(got[k], v))
    # three-item rule exists: {A,B} => C
    assert any(r["LHS"] == "A,B" and r["RHS"] == "C" for r in rules)


def test_holdout_confidence(spark):
    rules = association_rules(baskets(_lines(spark, TRAIN)), 0.2, 0.3)
    hold = _lines(spark, [["A", "B"], ["A"], ["B", "C"], ["E"]])
    strict = {(r["LHS"], r["RHS"]): r["nouk_confidence"] for r in rule_holdout_confidence(rules, hold).collect()}
    assert strict[("A", "B")] == 0.5
    assert strict[("A,B", "C")] is None                 # multi-item LHS is NULL in strict mode
    assert strict[("A", "D")] is None if ("A", "D") in strict else True   # D unknown in holdout
    loose = {(r["LHS"], r["RHS"]): r["nouk_confidence"]
             for r in rule_holdout_confidence(rules, hold, strict=False).collect()}
    assert loose[("A,B", "C")] == 0.0


def test_matching_against_brute_force(spark):
    products = spark.createDataFrame([("RED MUG",), ("RED MUG LARGE",), ("blue bowl",), ("GREEN TEAPOT",)],
                                     "product string")
    terms = spark.createDataFrame([("red mug",), ("MUG",), ("bowl",), ("gren teapott",), ("zzzz",)], "term string")
    direct = {r["term"]: (r["product"], r["match_type"]) for r in exact_or_substring(terms, products).collect()}
    assert direct["red mug"] == ("RED MUG", "exact")
    assert direct["MUG"] == ("RED MUG", "substring")      # shortest product containing the term
    assert direct["bowl"] == ("blue bowl", "substring")
    names = [r[0] for r in products.collect()]
    fz = {r["term"]: (r["product"], r["score"]) for r in similar_match(terms, products).collect()}
    assert fz == {t: best for t in ("red mug", "MUG", "bowl", "gren teapott", "zzzz") if (best := best_similar(t, names))}
    assert fz["gren teapott"][0] == "GREEN TEAPOT" and "zzzz" not in fz


def test_lookup_in_long_and_repeated_names(spark):
    """A 350-character composite name, names that repeat a gram, names in several spellings, short and empty keys."""
    long = ",".join(f"PART {i:02} OF SET" for i in range(25))
    assert len(long) > 350
    names = [long, "Red Mug", "RED MUG", "AAAA", "aaa", "x", "%", "50% OFF", "É", ""]
    keys = ["part 22 of", "set,part", "red mug", "AAA", "aa", "X", "%", "é", "0%", "", " ", "nothing here", "PART 05 OF SET,PART 07"]
    products = spark.createDataFrame([(n,) for n in names] * 2 + [(None,)], "product string")
    terms = spark.createDataFrame([(k,) for k in keys] * 2 + [(None,)], "term string")
    want = {}
    for k in keys:
        hits = sorted((n.upper() != k.upper(), len(n), n) for n in names if k and k.upper() in n.upper())
        if hits:
            want[k] = (hits[0][2], "substring" if hits[0][0] else "exact")
    assert {r.term: (r.product, r.match_type) for r in exact_or_substring(terms, products).collect()} == want
    found = [tuple(r) for r in browse_products(products, terms.withColumnRenamed("term", "keyword")).collect()]
    assert found == sorted({(k, n) for k in keys for n in names if k.strip(" ") and k.strip(" ").upper() in n.upper()})


def test_posting_rows_are_linear_in_the_name(spark):
    from tillroll.operators.recommend import gram_postings
    name = "".join(chr(0x4E00 + i) for i in range(350))
    assert gram_postings(spark.createDataFrame([(name,)], "product string")).count() <= 3 * len(name)


def test_similar_names_match_brute_force(spark):
    import random
    rnd = random.Random(2)
    names = ["".join(rnd.choice("ABCD ") for _ in range(rnd.randint(1, 14))) for _ in range(120)]
    terms = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(1, 14))) for _ in range(120)] + ["", "a"]
    frame = lambda values, c: spark.createDataFrame([(v,) for v in values], f"{c} string").repartition(3)
    for cutoff in (0.5, 0.8):
        got = {r.term: (r.product, r.score) for r in similar_match(frame(terms, "term"), frame(names, "product"), cutoff).collect()}
        want = {}
        for t in set(terms):
            best = min((-dice(t, n), n) for n in names)
            if -best[0] >= cutoff:
                want[t] = (best[1], -best[0])
        assert got == want


def test_recommend_falls_back_to_rhs(spark):
    rules = spark.createDataFrame([("A", "B", 0.1, 0.5, 2.0), ("C", "A", 0.1, 0.4, 3.0)],
                                  "LHS string, RHS string, support double, confidence double, lift double")
    matches = spark.createDataFrame([("a", "A", "exact"), ("b", "B", "exact")],
                                    "term string, product string, match_type string")
    recs = {r["term"]: r for r in recommend(matches, rules).collect()}
    assert recs["a"]["direction"] == "lhs" and recs["a"]["recommended"] == "B"
    assert recs["b"]["direction"] == "rhs" and recs["b"]["recommended"] == "A"
    assert recs["a"]["rank"] == 1 and F is not None


def test_recommend_keeps_unmatched_terms(spark):
    rules = spark.createDataFrame([("A", "B", 0.1, 0.5, 2.0)],
                                  "LHS string, RHS string, support double, confidence double, lift double")
    matches = spark.createDataFrame([("a", "A", "exact"), ("zz", None, "no_match")],
                                    "term string, product string, match_type string")
    got = {r["term"]: (r["match_type"], r["recommended"], r["rank"]) for r in recommend(matches, rules).collect()}
    assert got == {"a": ("exact", "B", 1), "zz": ("no_match", None, None)}


def test_fuzzy_recommendations_try_every_term(spark):
    from tillroll.plans import catalog
    from tillroll.plans.baskets import rules, search_terms
    catalog.load_all()
    sf = "/root/testdata/sf0.001"
    names = [r[0] for r in rule_products(rules(spark, sf)).collect()]
    terms = {r[0] for r in search_terms(spark, sf).collect() if r[0] is not None}
    rows = catalog.QUERIES["recommend_fuzzy"](spark, sf).collect()
    legend = catalog.QUERIES["recommend_legend_fuzzy"](spark, sf).collect()
    assert {r.term for r in rows} == {r.term for r in legend} == terms
    missed = {r.term for r in rows if r.match_type == "no_match"}
    assert missed == {t for t in terms if not any(t.upper() in n.upper() for n in names) and not best_similar(t, names)}
    assert any(r.match_type == "fuzzy" and r.rank == 1 for r in rows)


def test_itemsets_count_without_a_tree_and_are_mined_once(spark):
    """Wide and copied baskets, empty ones too: every rule up to the longest set, read from stored itemsets."""
    import random
    from unittest import mock

    from pyspark.ml.fpm import FPGrowth
    rnd = random.Random(4)
    rows = [rnd.sample("ABCDEFGHIJ", rnd.randint(1, 7)) for _ in range(150)] * 2
    frame = spark.createDataFrame([(b,) for b in rows] + [([],), (None,)], "items array<string>").repartition(5)
    n = len(rows) + 1
    sup = lambda s: sum(1 for b in rows if set(s) <= set(b))
    want = {}
    for size in range(2, 6):
        for items in itertools.combinations("ABCDEFGHIJ", size):
            for rhs in items if sup(items) >= 0.05 * n else ():
                lhs = [i for i in items if i != rhs]
                if sup(items) / sup(lhs) >= 0.4:
                    want[",".join(lhs), rhs] = (sup(items) / n, sup(items) / sup(lhs), sup(items) / sup(lhs) / (sup([rhs]) / n))
    with mock.patch.object(FPGrowth, "fit", side_effect=AssertionError("a tree of baskets")):
        rules = association_rules(frame, 0.05, 0.4, max_len=5)
    got = {(r.LHS, r.RHS): (r.support, r.confidence, r.lift) for r in rules.collect()}
    assert got.keys() == want.keys() and any(k[0].count(",") > 1 for k in want)
    assert all(abs(x - y) < 1e-12 for k in want for x, y in zip(got[k], want[k]))
    # the rules read the stored itemsets, not the baskets
    assert all("/stages/itemsets-" in f for f in rules.inputFiles()) and rules.inputFiles()
