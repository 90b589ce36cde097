"""Date expressions. Bounds are literals so Catalyst folds and pushes them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DATE_FORMAT, ZONE_OFFSET_HOURS


def as_date(col: Column) -> Column:
    """``DATE(x)`` for DATE, TIMESTAMP or TIMESTAMP_NTZ sources."""
    return F.to_date(col)


def on_or_after(col: Column, bound: dt.date) -> Column:
    """Open upper bound: ``DATE(col) >= bound``. Spark unwraps the cast into a
    range on the raw column, so the predicate reaches the Parquet scan."""
    return as_date(col) >= F.lit(bound)


def within(col: Column, start: dt.date, end_exclusive: dt.date) -> Column:
    """Closed calendar range. Written as a range, not ``trunc(col) = m``,
    because only the range is pushed down."""
    d = as_date(col)
    return (d >= F.lit(start)) & (d < F.lit(end_exclusive))


def week_start(col: Column) -> Column:
    """Monday of the week (``trunc`` returns DATE; ``date_trunc`` a timestamp)."""
    return F.trunc(as_date(col), "week")


def week_label(col: Column) -> Column:
    return F.date_format(week_start(col), "yyyy-MM-dd")


def zone_date(ts: Column, offset_hours: float = ZONE_OFFSET_HOURS) -> Column:
    """The date at a fixed UTC offset of a TIMESTAMP_NTZ that holds UTC (for a
    whole column what ``params.today_in_zone`` is for the current moment)."""
    return F.to_date(ts + F.make_dt_interval(mins=F.lit(int(offset_hours * 60))))


def stamp(ts: dt.datetime, offset_hours: float = ZONE_OFFSET_HOURS, fmt: str = DATE_FORMAT) -> Column:
    """Refresh stamp text: the wall time of ``ts`` at a fixed UTC offset,
    formatted by Spark. A naive ``ts`` is taken as UTC; the literal is a
    TIMESTAMP_NTZ, so the session time zone plays no part."""
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    local = ts.astimezone(dt.timezone(dt.timedelta(hours=offset_hours))).replace(tzinfo=None)
    return F.date_format(F.lit(local.isoformat(sep=" ")).cast("timestamp_ntz"), fmt)
