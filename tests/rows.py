"""Hand-made input rows."""

import datetime as dt
from decimal import Decimal

from tillroll import schema as S


def lines(spark, rows):
    """Raw lines from (invoice, code, description, quantity, price, customer, country) tuples."""
    data = []
    for i, r in enumerate(rows):
        inv, code, desc, qty, price = r[:5]
        cust = r[5] if len(r) > 5 else 12345.0
        country = r[6] if len(r) > 6 else "United Kingdom"
        ts = r[7] if len(r) > 7 else dt.datetime(2011, 1, 3, 10, 0) + dt.timedelta(minutes=i)
        data.append((inv, code, desc, qty, ts, None if price is None else Decimal(str(price)), cust, country))
    return spark.createDataFrame(data, S.RAW_SCHEMA)
