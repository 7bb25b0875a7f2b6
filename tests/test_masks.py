from rows import lines
from pyspark.sql import functions as F

from tillroll.functions.text import is_noise, normalize_description, strip_ws
from tillroll.operators.splits import add_masks, split_counts, split_long, split_overlap


def test_mask_truth_table(spark):
    df = add_masks(lines(spark, [
        ("A100001", "B", "Adjust bad debt", 1, -5.0),      # admin
        ("C100002", "20001", "X", -2, 1.0),                # cancellation
        ("C100003", "20001", "X", 3, 1.0),                 # positive-quantity C row: still a cancellation
        ("100004", "20001", "X", -2, 0.0),                 # inventory adjustment
        ("100005", "20001", "X", 2, 0.0),                  # free item
        ("100006", "gift_0001_20", "X", 1, 10.0),          # gift (case-blind)
        ("C100007", "GIFT_0001_10", "X", -1, 10.0),        # cancelled gift: in two splits
        ("100008", "DCGS0003", "X", 1, 2.0),               # dcgs
        ("100009", "POST", "X", 1, 2.0),                   # shipping
        ("100010", "M", "X", 1, 2.0),                      # manual product-like
        ("100011", "m", "X", 1, 2.0),                      # lower-case m is not manual -> clean sale
        ("100012", "BANK CHARGES", "X", 1, 2.0),           # other special
        ("100013", "20002", "X", 1, 2.0),                  # clean sale
        ("100014", "20002", "X", 0, 2.0),                  # zero quantity: in no split
        ("100015", "20002", "X", 1, -1.0),                 # negative price, not A: in no split
        (None, None, None, None, None),                    # all NULL: every mask false
        ("100016", "M", "X", -1, 0.0),                     # manual but adjustment: not product-like
    ]))
    got = {r["invoice_no"]: r for r in df.collect()}
    assert got["A100001"]["is_admin_invoice"] and not got["A100001"]["is_clean_product_sale_candidate"]
    assert got["C100002"]["is_cancellation_invoice"]
    assert got["C100003"]["is_cancellation_invoice"] and not got["C100003"]["is_clean_product_sale_candidate"]
    assert got["100004"]["is_inventory_adjustment"] and not got["100004"]["is_free_item"]
    assert got["100005"]["is_free_item"]
    assert got["100006"]["is_gift_voucher"]
    assert got["C100007"]["is_gift_voucher"] and got["C100007"]["is_cancellation_invoice"]
    assert got["100008"]["is_dcgs"]
    assert got["100009"]["is_shipping_fee"]
    assert got["100010"]["is_manual"] and got["100010"]["is_manual_product_like_sale"]
    assert not got["100010"]["is_clean_product_sale_candidate"]
    assert not got["100011"]["is_manual"] and got["100011"]["is_clean_product_sale_candidate"]
    assert got["100012"]["is_other_special_code"]
    assert got["100013"]["is_clean_product_sale_candidate"]
    for k in ("100014", "100015"):
        assert not any(got[k][m] for m in ("is_clean_product_sale_candidate", "is_manual_product_like_sale"))
    assert not got["100016"]["is_manual_product_like_sale"] and got["100016"]["is_inventory_adjustment"]
    null_row = got[None]
    assert all(null_row[c] is False for c in df.columns if c.startswith("is_"))
    long = split_long(df)
    assert long.where(F.col("invoice_no") == "C100007").count() == 2
    counts = {r["split"]: r["n"] for r in split_counts(df).collect()}
    assert sum(counts.values()) == long.count()
    assert split_overlap(df.where("is_clean_product_sale_candidate"),
                         df.where("is_manual_product_like_sale")).first()[0] == 0


def test_noise_and_strip(spark):
    df = spark.createDataFrame([("found",), (" LOST ",), ("amazon fee",), ("damaged?",), (None,), (" x ",)],
                               "d string")
    out = df.select("d", is_noise("d").alias("n"), strip_ws("d").alias("s"),
                    normalize_description("d").alias("nd")).collect()
    flags = {r["d"]: r["n"] for r in out}
    assert flags["found"] and flags[" LOST "] and flags["damaged?"]
    assert not flags["amazon fee"]          # equality only, not contained
    assert flags[None] is False
    assert [r["s"] for r in out if r["d"] == " x "] == ["x"]   # Python-style strip


def test_overlap_counts_pairs(spark):
    a = spark.createDataFrame([("1", "X"), ("1", "X"), ("2", "Y")], "invoice_no string, stock_code string")
    b = spark.createDataFrame([("1", "X"), ("1", "X"), ("1", "X")], "invoice_no string, stock_code string")
    assert split_overlap(a, b).first()[0] == 6
