"""Calendar column functions for month-end snapshot work.

All are ``Column -> Column`` (or ``DataFrame -> DataFrame`` wrappers) built from
Spark built-ins, so they stay inside whole-stage codegen. No function reads the
wall clock: a reporting date is always a parameter.
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quarter_end_of(c) -> Column:
    """Quarter end for a date: the date itself when it lies in the quarter's
    last month, else the last day of that quarter.

    So 2024-03-15 -> 2024-03-15, 2024-02-29 -> 2024-03-31.
    """
    d = _c(c)
    q = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    return F.when(F.last_day(d) == q, d).otherwise(q)


def quarter_end(df: DataFrame, col: str = "MONTH_END", out: str = "QUARTER_END") -> DataFrame:
    return df.withColumn(out, quarter_end_of(col))


def month_spine(spark: SparkSession, start_year: int, year: int, month: int,
                out: str = "MONTH_END") -> DataFrame:
    """Month ends from January of ``start_year`` through (year, month), inclusive."""
    start = _dt.date(start_year, 1, 1)
    end = _dt.date(year, month, 1)
    seq = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 MONTH"))).alias("d"))
    return seq.select(F.last_day("d").alias(out))


def month_spine_between(df: DataFrame, lo: str, hi: str, out: str = "MONTH_END") -> DataFrame:
    """One row per month end between two date columns of a one-row frame."""
    return (df.select(F.explode(F.sequence(F.trunc(_c(lo), "month"), F.trunc(_c(hi), "month"),
                                           F.expr("INTERVAL 1 MONTH"))).alias("d"))
            .select(F.last_day("d").alias(out)))


def prev_month(c) -> Column:
    """First day of the previous calendar month (January -> December before)."""
    return F.add_months(F.trunc(_c(c), "month"), -1)


def prev_month_end(c) -> Column:
    return F.date_sub(F.trunc(_c(c), "month"), 1)


def prev_month_is_quarter_end(c) -> Column:
    """1 when the month before ``c`` is March, June, September or December."""
    return F.when(F.month(prev_month(c)) % 3 == 0, 1).otherwise(0).cast("int")


@F.pandas_udf(IntegerType())
def prev_month_is_quarter_end_udf(s: pd.Series) -> pd.Series:
    """Vectorised (Arrow-batched) form of :func:`prev_month_is_quarter_end`."""
    month = pd.to_datetime(s).dt.month                    # NaN for NULL
    return (month - 1).mod(3).eq(0).astype("Int32").mask(month.isna())
