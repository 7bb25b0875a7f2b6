"""Date and calendar column functions (DAT-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_timestamp(c) -> Column:
    """DAT-1: parse text to timestamp, bad -> NULL. Timestamps pass through."""
    return F.try_to_timestamp(_col(c).cast("string"))


def to_day(c="invoice_date") -> Column:
    """DAT-2: timestamp -> date."""
    return F.to_date(_col(c))


def weekday_sun1(c) -> Column:
    """Weekday number with Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(_col(c))


def weekday_mon1(c) -> Column:
    """Weekday number with Monday = 1 .. Sunday = 7."""
    return F.weekday(_col(c)) + 1


def is_weekend(c) -> Column:
    return F.dayofweek(_col(c)).isin(1, 7)


def week_of_year_simple(c) -> Column:
    """(day of year - 1) div 7 + 1: counts 7-day blocks from Jan 1, not ISO weeks."""
    return (F.floor((F.dayofyear(_col(c)) - 1) / 7) + 1).cast("int")


def calendar_parts(c="invoice_date", prefix: str = "") -> dict[str, Column]:
    """DAT-3: month, quarter, hour, both weekday numberings, weekend, week."""
    x = _col(c)
    return {
        f"{prefix}month": F.month(x),
        f"{prefix}quarter": F.quarter(x),
        f"{prefix}hour": F.hour(x),
        f"{prefix}weekday_sun1": weekday_sun1(x),
        f"{prefix}weekday_mon1": weekday_mon1(x),
        f"{prefix}is_weekend": is_weekend(x),
        f"{prefix}week": week_of_year_simple(x),
    }


def days_between(later, earlier) -> Column:
    """DAT-4: whole days between two dates."""
    return F.datediff(_col(later), _col(earlier))
