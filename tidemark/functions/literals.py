"""Time literals that do not depend on any time zone.

A naive Python ``datetime`` passed to ``F.lit`` becomes a TIMESTAMP through
the Python process's zone and is then compared with TIMESTAMP_NTZ columns
through the session zone; when the two differ, filters silently shift by
hours. These helpers go through ISO text instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(v) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO string."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(v, _dt.date):
        return F.lit(v.isoformat()).cast("timestamp_ntz")
    return F.lit(v).cast("timestamp_ntz")


def date_lit(v) -> Column:
    """A DATE literal from a date, datetime or ISO string."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.date().isoformat()).cast("date")
    if isinstance(v, _dt.date):
        return F.lit(v.isoformat()).cast("date")
    return F.lit(v).cast("date")


def value_lit(v) -> Column:
    """Datetimes as NTZ timestamps, dates as dates, anything else as is."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return ts_lit(v)
    if isinstance(v, _dt.date):
        return date_lit(v)
    return F.lit(v)
