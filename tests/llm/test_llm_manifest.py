import hashlib
import zlib

import pytest
from helpers import edge_docs, empty_docs
from oracle_harness import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.llm import merkle

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    """(root, [(left, right) per level] per leaf)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + fanout] for k in range(0, len(nodes), fanout)]
        for q, place in enumerate(at):
            run = runs[place // fanout]
            paths[q].append(("".join(run[:place % fanout]), "".join(run[place % fanout + 1:])))
            at[q] = place // fanout
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], paths


def brute(rows, tamper, fanout=3):
    """(id, leaf, subroot, root, proof, folded root, verified) per (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], leaf(row), leaf((*row[:4], tamper(row)))))
    trees = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(groups[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((own, *tree([x[1] for x in own], fanout)))
    if not trees:
        return []
    root, crown = tree([t[1] for t in trees], fanout)
    out = []
    for (own, sub, paths), above in zip(trees, crown):
        for (i, original, found), path in zip(own, paths):
            for left, right in path + above:
                found = sha(left + found + right)
            out.append((i, original, sub, root, sha("".join(a + b for a, b in path + above)), found, found == root))
    return out


def cut(row):
    odd = row[4] is None or row[0] is None or zlib.crc32(str(row[0]).encode()) % 2
    return row[4] if odd else row[4].replace("\n", "")


def checked(docs):
    text = F.col("text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    rows = merkle.verify(docs, tampered)
    return rows.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_matches_brute_force_on_edge_rows(spark):
    docs = edge_docs(spark)
    extra = docs.limit(4).withColumn("source", F.lit("é")).unionByName(docs.limit(3).withColumn("source", F.lit("z\n"))).unionByName(
        docs.limit(1).withColumn("source", F.lit("")).withColumn("text", F.lit("a\nb\n")).withColumn("lang", F.lit(None).cast("string")))
    docs = docs.unionByName(extra)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, checked(docs).collect()), key=str) == sorted(brute(rows, cut), key=str)


def test_sizes_around_whole_levels(spark):
    """1 to 244 leaves per source: lone leaves, lone last children, full and just overflowing blocks."""
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 80, 81, 82, 243, 244]
    rows = [(1000 * k + j, f"s{k:02}", "en", j, f"t {k}\n{j}") for k, n in enumerate(sizes) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    got = sorted(map(tuple, checked(docs).collect()))
    assert got == sorted(brute(rows, cut))
    assert {r[0] for r in got if not r[-1]} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 2 == 0}


def test_one_row_and_no_rows(spark):
    docs = spark.createDataFrame([(7, "a", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    own = leaf((7, "a", "en", 3, "abc"))
    assert [tuple(r) for r in checked(docs).collect()] == [(7, own, own, own, sha(""), own, True)]
    assert checked(empty_docs(spark)).collect() == []


def test_another_fanout(spark):
    rows = [(j, "ab"[j % 2], "en", j, f"t{j}") for j in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    out = merkle.manifest(docs, F.col("source"), F.col("doc_id"), merkle.digest([F.col(c) for c in docs.columns]), {"id": F.col("doc_id")}, fanout=2)
    got = sorted((r.id, r.leaf, r.subroot, r.root) for r in out.collect())
    assert got == sorted(x[:4] for x in brute(rows, lambda r: r[4], fanout=2))


def test_oracle_agrees(spark):
    pytest.importorskip("duckdb")
    assert compare(spark, SMALL, "op12_merkle", E.queries()["op12_merkle"], E.oracle_sql()["op12_merkle"], duck(SMALL))["status"] == "match"
