import datetime as dt

from rows import lines
from pyspark.sql import functions as F

from tillroll.functions.dates import week_of_year_simple
from tillroll.operators.demand import daily_demand, demand_features, spike_label


def _days(n):
    return [(f"1{i:05d}", "20001", "X", i + 1, 2.0, 1.0, "United Kingdom",
             dt.datetime(2011, 1, 1, 10) + dt.timedelta(days=i)) for i in range(n)]


def test_fewer_than_seven_days_gives_no_features(spark):
    feats = demand_features(spike_label(daily_demand(lines(spark, _days(6)))))
    assert feats.count() == 0


def test_lags_rolls_and_lead_brute_force(spark):
    feats = demand_features(spike_label(daily_demand(lines(spark, _days(12))))).orderBy("date").collect()
    qty = list(range(1, 13))
    # first feature row is day 7 (index 6); last day has no tomorrow
    assert [r["lag1_quantity"] for r in feats] == qty[5:10]
    assert [r["day7_roll_quantity"] for r in feats] == [sum(qty[i - 6:i + 1]) / 7.0 for i in range(6, 11)]
    thr = sorted(qty)[8] + (sorted(qty)[9] - sorted(qty)[8]) * 0.25   # type-7 quantile of 12 values
    labels = ["High" if q >= thr else "Normal" for q in qty]
    assert [r["next_day_spike"] for r in feats] == labels[7:12]


def test_simple_week_number(spark):
    df = spark.createDataFrame([(dt.date(2011, 1, 1),), (dt.date(2011, 1, 7),), (dt.date(2011, 1, 8),),
                                (dt.date(2011, 12, 31),)], "d date")
    assert [r[0] for r in df.select(week_of_year_simple("d")).collect()] == [1, 1, 2, 53]


def test_market_thresholds_are_separate(spark):
    rows = _days(8) + [(f"2{i:05d}", "20001", "X", 100 * (i + 1), 2.0, 1.0, "France",
                        dt.datetime(2011, 1, 1, 10) + dt.timedelta(days=i)) for i in range(8)]
    lab = spike_label(daily_demand(lines(spark, rows)))
    thr = {r["market"]: r["spike_threshold"] for r in lab.select("market", "spike_threshold").distinct().collect()}
    assert thr["UK"] < thr["Non-UK"]
    assert lab.where(F.col("demand_spike") == "High").count() == 4


def test_revenue_switch(spark):
    rows = [("100001", "20001", "X", 3, 2.0), ("100001", "20002", "Y", 2, 5.0)]
    by_price = daily_demand(lines(spark, rows)).first()
    by_line = daily_demand(lines(spark, rows), revenue="line").first()
    assert float(by_price["total_revenue"]) == 7.0        # sum of unit prices, as the workflow does
    assert float(by_line["total_revenue"]) == 16.0        # price x quantity


def test_peak_split_by_invoice_has_no_leak(spark):
    from tillroll.operators.hours import peak_split, shopping_lines
    rows = [(f"{100000 + i // 5}", f"{20000 + i}", "X", 1 + i % 3, 2.0) for i in range(500)]
    s = peak_split(shopping_lines(lines(spark, rows)), unit="invoice")
    sides = s.groupBy("invoice_no").agg(F.countDistinct("part").alias("k"))
    assert sides.where("k > 1").count() == 0
    row_level = peak_split(shopping_lines(lines(spark, rows)), unit="row")
    assert row_level.groupBy("invoice_no").agg(F.countDistinct("part").alias("k")).where("k > 1").count() > 0
