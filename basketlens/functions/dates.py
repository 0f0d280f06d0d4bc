"""Date helpers for the two day-count conventions of the reference.

* elapsed days: whole 24-hour periods between two datetimes (pandas
  ``Timedelta.days``, floor), used by the pandas flavour;
* calendar days: difference of the calendar dates (MySQL ``DATEDIFF``),
  used by the SQL flavour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AS_OF_DELIVERED_PLUS_1D = "delivered_plus_1d"   # max delivered timestamp + 1 day (pandas flavour)
AS_OF_ALL_ORDERS = "all_orders"                 # max calendar date over every order (SQL flavour)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(ts) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_c(ts).cast("date"), "month")


def to_day(ts) -> Column:
    return _c(ts).cast("date")


def _seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight with microseconds (DECIMAL); read from the NTZ fields, no zone involved."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(12,6)") + F.date_part(F.lit("SECOND"), ts)


def elapsed_days(end, start) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (floor), for NTZ timestamps.

    Computed from calendar days plus the difference in time of day, so the
    session time zone (and its DST shifts) never enters.
    """
    e, s = _c(end), _c(start)
    secs = (F.datediff(e.cast("date"), s.cast("date")).cast("decimal(20,6)") * 86400
            + _seconds_of_day(e) - _seconds_of_day(s))
    return F.floor(secs / 86400).cast("long")


def calendar_days(end, start) -> Column:
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def month_diff(later_month, earlier_month) -> Column:
    """Whole calendar months between two month starts (MySQL TIMESTAMPDIFF(MONTH) on month starts)."""
    a, b = _c(earlier_month), _c(later_month)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def as_of_date(orders: DataFrame, mode: str = AS_OF_DELIVERED_PLUS_1D,
               status_col: str = "order_status", delivered: str = "delivered",
               ts_col: str = "order_purchase_timestamp") -> Column:
    """Analysis date of divergence D1 as a scalar-subquery Column.

    Spark evaluates it once (partial max per task, one row shuffled) and
    substitutes the value; no join or cross product is planned.
    """
    if mode == AS_OF_DELIVERED_PLUS_1D:
        return (orders.filter(F.col(status_col) == delivered)
                .agg(F.timestamp_add("DAY", F.lit(1), F.max(ts_col))).scalar())
    if mode == AS_OF_ALL_ORDERS:
        return orders.agg(F.max(F.col(ts_col).cast("date"))).scalar()
    raise ValueError(f"unknown as_of mode {mode!r}")
