import os
import tempfile

from pyspark.sql import functions as F

from tillroll.operators.clean import code_description_map, normalize_description
from tillroll.operators.splits import split_counts
from tillroll.plans.stages import build_cleaned
from tillroll.sources import fixtures
from tillroll.sources.io import read_raw, read_rules, write_rules
from tillroll.streaming.labeling import label_stream

SF = "/root/testdata/sf0.001"


def test_stream_labels_equal_batch(spark):
    raw = fixtures.build_retail_lines(spark, SF)
    work = tempfile.mkdtemp(prefix="tillroll-test-", dir="/tmp")
    src = os.path.join(work, "in")
    raw.where(F.col("invoice_no") < "101000").write.parquet(os.path.join(src, "part1"))
    raw.where(F.col("invoice_no") >= "101000").write.parquet(os.path.join(src, "part2"))
    code_map = code_description_map(normalize_description(raw)).persist()
    q = label_stream(spark, os.path.join(src, "*"), code_map, os.path.join(work, "out"),
                     checkpoint=os.path.join(work, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(work, "out", "splits")).groupBy("split").count()
    want = {r["split"]: r["n"] for r in split_counts(build_cleaned(raw)).collect() if r["n"]}
    assert {r["split"]: r["count"] for r in got.collect()} == want


def test_read_raw_stacks_extracts(spark):
    raw = fixtures.source_lines(spark, SF)
    work = tempfile.mkdtemp(prefix="tillroll-test-", dir="/tmp")
    a, b = os.path.join(work, "a"), os.path.join(work, "b")
    raw.limit(100).write.parquet(a)
    raw.write.parquet(b)
    df = read_raw(spark, [a, b])
    assert df.count() == 100 + raw.count()
    assert df.where("extract = 0").count() == 100


def test_rules_csv_roundtrip(spark):
    rules = spark.createDataFrame([("A,B", "C", 0.1, 0.5, 2.0), ("A", "B", 0.2, 0.4, 3.0)],
                                  "LHS string, RHS string, support double, confidence double, lift double")
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-test-", dir="/tmp"), "rules")
    write_rules(rules, path)
    back = read_rules(spark, path)
    assert [r["LHS"] for r in back.orderBy(F.col("lift").desc()).collect()] == ["A", "A,B"]
    assert back.where("LHS = 'A,B'").first()["antecedent"] == ["A", "B"]


def test_write_splits_partitions_by_table(spark):
    from tillroll.operators.splits import read_split, write_splits
    from tillroll.plans.stages import cleaned
    df = cleaned(spark, SF)
    base = tempfile.mkdtemp(prefix="tillroll-test-", dir="/tmp")
    write_splits(df, base)
    want = {r["split"]: r["n"] for r in split_counts(df).collect() if r["n"]} | {"cleaned_retail_all": df.count()}
    back = spark.read.parquet(base)
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == want
    assert sorted(map(str, read_split(spark, base, "cleaned_retail_all").select(*df.columns).collect())) == sorted(map(str, df.collect()))
    assert read_split(spark, base, "free_items").count() == want["free_items"]
    assert all(len(os.listdir(os.path.join(base, d))) <= 4 for d in os.listdir(base) if d.startswith("split="))  # with checksum files


def test_extracts_are_compressed_files_of_bounded_length(spark, tmp_path, monkeypatch):
    """Both extracts hold every line; a compressed file goes to one task, so its rows are bounded."""
    from rows import lines

    from tillroll.sources import extracts
    monkeypatch.setattr(extracts, "FILE_ROWS", 50)
    raw = lines(spark, [(str(536365 + i), f"{10000 + i}", ' a "quoted", name ' if i % 2 else None, i, "1.25") for i in range(220)]).coalesce(1)
    folders = extracts.write_extracts(raw, str(tmp_path / "x"))
    files = [f for folder in folders for f in (tmp_path / "x" / folder.rsplit("/", 1)[1]).glob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files) and len(files) >= 5
    back = extracts._clean_names(extracts.read_raw(spark, folders, extracts.TEXT_SCHEMA, "csv"))
    want = extracts.extract_rows(raw)
    assert back.count() == 220 and back.select(*want.columns).exceptAll(want).isEmpty()
