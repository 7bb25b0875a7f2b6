"""Hot keys: one customer / item holding a third of the rows gives the same
answers as a brute-force computation."""
import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.operators.segments import customer_lines, rfm


def _sales(spark, n=1500, seed=11):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        cust = 19999.0 if i % 3 == 0 else float(10000 + rng.integers(0, 40))
        rows.append((f"{100000 + i // 4}", f"{20000 + rng.integers(0, 30)}", f"ITEM {rng.integers(0, 30)}",
                     int(rng.integers(1, 20)), dt.datetime(2011, 1, 1) + dt.timedelta(days=int(rng.integers(0, 300))),
                     Decimal(f"{rng.integers(1, 5000) / 100:.2f}"), cust, "United Kingdom"))
    df = spark.createDataFrame(rows, S.RAW_SCHEMA)
    flags = {m: F.lit(False) for m in ("is_cancellation_invoice", "is_gift_voucher", "is_free_item",
                                        "is_shipping_fee", "is_admin_invoice", "is_inventory_adjustment")}
    return df.withColumns(flags), rows


def test_rfm_with_a_hot_customer(spark):
    df, rows = _sales(spark)
    got = {r["customer_id"]: r for r in rfm(customer_lines(df)).collect()}
    pdf = pd.DataFrame(rows, columns=list(S.RAW_COLUMNS))
    pdf["rev"] = pdf["price"].apply(Decimal) * pdf["quantity"]
    pdf["d"] = pdf["invoice_date"].dt.date
    ref = max(pdf["d"]) + dt.timedelta(days=1)
    for cust, g in pdf.groupby("customer_id"):
        r = got[int(cust)]
        assert r["recency"] == (ref - max(g["d"])).days
        assert r["frequency"] == g["invoice_no"].nunique()
        assert r["monetary"] == sum(g["rev"])
        assert r["n_products"] == g["description"].nunique()
    assert got[19999]["frequency"] > 100      # the hot customer is really hot
