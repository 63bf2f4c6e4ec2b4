"""Privacy operators: row filters, column mask tiers, pseudonymisation,
tokenisation, suppression, generalisation, PII detection and masking.

Detection and masking are native regular expressions (``rlike``,
``regexp_replace``, ``regexp_extract_all``) evaluated in the JVM over whole
texts; no Python UDF sits in the hot path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# PII patterns and masks.
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_PATTERN = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SSN_PATTERN = r"\b\d{3}-\d{2}-\d{4}\b"
EMAIL_MASK_PATTERN = r"\b([A-Za-z0-9._%+-]{2})[A-Za-z0-9._%+-]*@([A-Za-z0-9.-]+)\.[A-Za-z]{2,}\b"
EMAIL_MASK = "$1***@$2.***"
PHONE_MASK_PATTERN = r"\b(\d{3})[-.]?\d{3}[-.]?(\d{4})\b"
PHONE_MASK = "$1-***-$2"
SSN_MASK = "***-**-****"
REDACTED = "***REDACTED***"

PII_PATTERNS = {"email": EMAIL_PATTERN, "phone": PHONE_PATTERN, "ssn": SSN_PATTERN}


def row_filter(df: DataFrame, column: str, policy: Mapping[str, object], groups: Sequence[str],
               all_value: object = "*") -> DataFrame:
    """Keep rows whose ``column`` the caller's groups may see.

    ``policy`` maps group -> allowed value (or ``all_value`` for everything).
    Unknown groups grant nothing (default deny). The predicate is a literal
    IN-list, so it pushes down to the scan like any filter.
    """
    granted = [policy[g] for g in groups if g in policy]
    if any(v == all_value for v in granted):
        return df
    allowed = sorted({v for v in granted})
    if not allowed:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(allowed))


def email_mask_tier(email: Column, groups: Sequence[str], full_group: str = "pii_access",
                    partial_group: str = "masked_access") -> Column:
    """Full value, partial mask (first 2 characters + domain) or redacted."""
    if full_group in groups:
        return email
    if partial_group in groups:
        parts = F.split(email, "@")
        return F.concat(F.left(parts.getItem(0), F.lit(2)), F.lit("***@"), parts.getItem(1))
    return F.lit(REDACTED)


def hash_ids(df: DataFrame, cols: Sequence[str], groups: Sequence[str] = (),
             full_group: str = "full_access", suffix: str = "_hash") -> DataFrame:
    """SHA-256 of the id as text, unless the caller holds ``full_group``."""
    keep = full_group in groups
    return df.withColumns({f"{c}{suffix}": (F.col(c).cast("string") if keep
                                            else F.sha2(F.col(c).cast("string"), 256)) for c in cols})


def tokenize(df: DataFrame, col: str, salt: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Salted SHA-256 token for ``col`` and the token map (token -> value)
    that makes the pseudonym reversible for holders of the map."""
    out = out or f"{col}_token"
    token = F.sha2(F.concat(F.col(col), F.lit(salt)), 256)
    tokens = df.withColumn(out, token)
    mapping = df.select(token.alias("token"), F.col(col).alias("value")).distinct()
    return tokens, mapping


def detokenize(df: DataFrame, mapping: DataFrame, token_col: str, out: str) -> DataFrame:
    return (df.join(mapping.withColumnRenamed("token", token_col), on=token_col, how="left")
            .withColumnRenamed("value", out))


def suppress(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace PII columns by typed NULLs."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in cols})


def band(col: str | Column, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """Generalise a number into labelled bands: first edge it is below wins."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for limit, label in edges:
        expr = F.when(c < limit, label) if expr is None else expr.when(c < limit, label)
    return expr.otherwise(top) if expr is not None else F.lit(top)


def generalize(df: DataFrame, bands: Mapping[str, tuple[str, Sequence[tuple[float, str]], str]] = (),
               prefixes: Mapping[str, tuple[str, int]] = (), months: Mapping[str, str] = (),
               domains: Mapping[str, str] = ()) -> DataFrame:
    """Bands for numbers, prefixes for codes, month truncation for dates, and
    of e-mail addresses the domain (NULL for text without one)."""
    out = {}
    for name, (col, edges, top) in dict(bands).items():
        out[name] = band(col, edges, top)
    for name, (col, n) in dict(prefixes).items():
        out[name] = F.substring(F.col(col), 1, n)
    for name, col in dict(months).items():
        out[name] = F.trunc(F.col(col), "month")
    for name, col in dict(domains).items():
        out[name] = F.when(F.instr(F.col(col), "@") > 0, F.lower(F.substring_index(F.col(col), "@", -1)))
    return df.withColumns(out)


def detect_pii(df: DataFrame, cols: Sequence[str], patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """``<col>_has_<kind>`` booleans per column and PII kind (NULL -> false)."""
    return df.withColumns({f"{c}_has_{k}": F.coalesce(F.col(c).rlike(p), F.lit(False))
                           for c in cols for k, p in patterns.items()})


def mask_text(c: Column) -> Column:
    """Mask every SSN, e-mail and phone number inside a text."""
    c = F.regexp_replace(c, SSN_PATTERN, SSN_MASK)
    c = F.regexp_replace(c, EMAIL_MASK_PATTERN, EMAIL_MASK)
    return F.regexp_replace(c, PHONE_MASK_PATTERN, PHONE_MASK)


def mask_pii(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: mask_text(F.col(c)) for c in cols})


def extract_emails(df: DataFrame, col: str, out: str = "email") -> DataFrame:
    """One row per e-mail address found anywhere in ``col``."""
    return df.withColumn(out, F.explode(F.regexp_extract_all(F.col(col), F.lit(EMAIL_PATTERN), 0)))


def pii_profile(df: DataFrame, cols: Sequence[str] | None = None,
                patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Match rate of every PII pattern in every string column: one scan,
    unpivoted to (column_name, pii_kind, rows, matches, match_rate)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    aggs, parts = [F.count(F.lit(1)).alias("_n")], []
    i = 0
    for c in cols:
        for k, p in patterns.items():
            aggs.append(F.count_if(F.coalesce(F.col(c).rlike(p), F.lit(False))).alias(f"_m{i}"))
            parts.append(f"'{c}', '{k}', _m{i}")
            i += 1
    wide = df.agg(*aggs)
    return (wide.selectExpr("_n AS rows", f"stack({i}, {', '.join(parts)}) AS (column_name, pii_kind, matches)")
            .withColumn("match_rate", F.try_divide(F.col("matches").cast("double"), F.col("rows")))
            .select("column_name", "pii_kind", "rows", "matches", "match_rate"))
