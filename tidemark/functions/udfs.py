"""The UDF surface: a row-wise Python UDF (Arrow-batched), a scalar pandas UDF,
a SQL scalar function and a struct-argument pandas UDF returning an array.

The native column expressions elsewhere in the library are the default; these
exist for logic that must live in Python, and each is a small per-row helper.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType

from tidemark.operators.privacy import EMAIL_PATTERN

_EMAIL_RE = re.compile(EMAIL_PATTERN, re.ASCII)


@F.udf(returnType=BooleanType(), useArrow=True)
def contains_email(text):
    """Row-wise Python UDF (Arrow transport)."""
    if text is None:
        return False
    return _EMAIL_RE.search(text) is not None


@F.pandas_udf(LongType())
def token_count(s: pd.Series) -> pd.Series:
    """Scalar pandas UDF: number of space-separated tokens per text."""
    return (s.astype("string").str.count(" ") + 1).astype("Int64")


@F.pandas_udf(ArrayType(StringType()))
def recommend(features: pd.DataFrame) -> pd.Series:
    """Struct-argument pandas UDF (a pd.DataFrame per batch) returning
    ``array<string>``: a rule model recommending offers from segment and
    balance."""
    seg = features["segment"].fillna("NONE")
    bal = features["balance"].fillna(0.0)
    tier = pd.Series("basic", index=features.index).where(bal < 5000, "premium")
    return pd.Series([[f"segment:{s.lower()}", f"tier:{t}"] for s, t in zip(seg, tier)], index=features.index)


MASK_FUNCTION = "tm_mask_email"


def register_sql_functions(spark: SparkSession) -> None:
    """SQL scalar function (``CREATE TEMPORARY FUNCTION ... RETURN``)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {MASK_FUNCTION}(email STRING)
        RETURNS STRING
        RETURN concat(left(split(email, '@')[0], 2), '***@', split(email, '@')[1])""")
