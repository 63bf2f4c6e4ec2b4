"""Data-quality expectations, quarantine and monitoring checks.

Rules are ``{name: SQL predicate}``. A NULL predicate result is a violation,
so a row the rule cannot judge never passes a drop or fail rule. Everything is
evaluated in the plan: violation counts ride along as observed metrics (no
second pass), fail rules use ``raise_error`` in the executors (valid on
streams), quarantine makes one reasons column and two filters.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.literals import ts_lit


FAILED = "expectation failed:"


def _ok(pred: str | Column) -> Column:
    c = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(c, F.lit(False))


def expect(df: DataFrame, rules: Mapping[str, str], name: str = "expectations"):
    """Keep every row; count violations per rule as observed metrics.

    Returns ``(df, Observation)``; ``observation.get`` is filled after the
    first action on the returned frame.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.sum(F.when(_ok(p), 0).otherwise(1)).alias(n) for n, p in rules.items()]
    return df.observe(obs, *metrics), obs


def violation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rule name, rows checked, violations (one scan)."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.when(_ok(p), 0).otherwise(1)).cast("bigint").alias(f"_v{i}")
                   for i, p in enumerate(rules.values())])
    names = list(rules)
    stack = ", ".join(f"'{n}', _v{i}" for i, n in enumerate(names))
    return agg.selectExpr("_rows AS rows_checked",
                          f"stack({len(names)}, {stack}) AS (rule, violations)") \
        .select("rule", "rows_checked", "violations")


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Drop rows that violate any rule (NULL counts as a violation)."""
    cond = F.lit(True)
    for p in rules.values():
        cond = cond & _ok(p)
    return df.where(cond)


def expect_or_fail(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Abort the job on the first violating row, from inside the executor."""
    cols = df.columns
    checks = []
    for n, p in rules.items():
        checks.append(F.when(~_ok(p), F.raise_error(F.lit(f"{FAILED} {n}"))))
    if not checks:
        return df
    guard = F.coalesce(*checks, F.lit(None)) if len(checks) > 1 else checks[0]
    # The guard column is referenced by a filter so the optimizer cannot prune it.
    return df.withColumn("_guard", guard).where(F.col("_guard").isNull()).select(*cols)


def expect_or_fail_counted(df: DataFrame, rules: Mapping[str, str], name: str = "guard") -> tuple[DataFrame, Observation]:
    """``expect_or_fail`` that also counts, in the same pass: the observation
    holds ``rows`` and the violations of every rule once a job has gone through
    (all 0 then), and nothing after a job that the guard has ended. Works on
    streams, whose progress has the counts under ``name``."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.sum(F.when(_ok(p), 0).otherwise(1)).alias(n) for n, p in rules.items()]
    counted = df.observe(name, *metrics) if df.isStreaming else df.observe(obs, *metrics)
    return expect_or_fail(counted, rules), obs


def guarded_write(df: DataFrame, rules: Mapping[str, str], path: str, name: str = "guard") -> tuple[str, int | None, str | None]:
    """Write ``df`` if all rules hold: ``(outcome, rows, rule)``, outcome
    ``passed`` with the rows written, or ``failed`` with the first rule that the
    job met a violation of. Other errors are raised."""
    guarded, obs = expect_or_fail_counted(df, rules, name)
    try:
        guarded.write.mode("overwrite").parquet(path)
    except PySparkException as e:
        broken = re.search(re.escape(FAILED) + r" ([^\n\]]*?)(?: SQLSTATE| ==|$)", str(e), re.M)
        if not broken:
            raise
        return "failed", None, next((n for n in sorted(rules, key=len, reverse=True) if broken[1].startswith(n)), broken[1])
    return "passed", int(obs.get["rows"]), None


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad). ``bad`` carries ``reasons: array<string>``.

    One reasons column is computed; both outputs are filters of it, so a
    caller that writes both from one ``foreachBatch`` or a persisted input
    scans the source once.
    """
    reasons = F.filter(F.array(*[F.when(~_ok(p), F.lit(n)) for n, p in rules.items()]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    bad = tagged.where(F.size("reasons") > 0)
    return good, bad


def check_rules(df: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Apply a declarative rule list ``(name, predicate, action)`` where action
    is ``warn`` (keep the row, name the rule in ``warnings``), ``drop`` or
    ``fail``. Without ``warn`` rules there is no ``warnings`` column."""
    unknown = {a for _, _, a in rules} - {"warn", "drop", "fail"}
    if unknown:
        raise ValueError(f"unknown actions: {sorted(unknown)}")
    warns = [F.when(~_ok(p), F.lit(n)) for n, p, a in rules if a == "warn"]
    if warns:
        df = df.withColumn("warnings", F.array_compact(F.array(*warns)))
    drops = {n: p for n, p, a in rules if a == "drop"}
    fails = {n: p for n, p, a in rules if a == "fail"}
    return df.transform(expect_or_fail, fails).transform(expect_or_drop, drops)


def with_generated(df: DataFrame, exprs: Mapping[str, str | Column],
                   defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Generated columns (computed from other columns) and column defaults."""
    out = df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()})
    if defaults:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})
    return out


def quality_score(df: DataFrame, cols: Sequence[str], full: float = 1.0,
                  partial: float = 0.5, out: str = "quality_score") -> DataFrame:
    """``full`` when every listed field is present, else ``partial``."""
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return df.withColumn(out, F.when(present, F.lit(full)).otherwise(F.lit(partial)))


def quality_report(df: DataFrame, key: str, ts: str, as_of, by: Sequence[str] = ()) -> DataFrame:
    """Totals, distinct keys, missing keys and future timestamps (one pass)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("missing_keys"),
        F.count_if(F.col(ts) > ts_lit(as_of)).alias("future_rows"),
    )


def null_rate(df: DataFrame, col: str, by: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """Share of NULLs in ``col`` per group and whether it breaches ``threshold``."""
    return (df.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.avg(F.col(col).isNull().cast("int")).alias("null_rate"))
            .withColumn("breach", F.col("null_rate") > threshold))


def freshness(df: DataFrame, ts: str, as_of, max_hours: float, by: Sequence[str] = ()) -> DataFrame:
    """Hours between the newest timestamp and ``as_of``; stale when over the limit."""
    return (df.groupBy(*by).agg(F.max(ts).alias("last_ts"))
            .withColumn("_as_of", ts_lit(as_of))
            .withColumn("hours_since", F.expr("timestampdiff(HOUR, last_ts, _as_of)"))
            .drop("_as_of")
            .withColumn("is_stale", F.col("hours_since") > max_hours))


def daily_counts(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


def volume_anomaly(df: DataFrame, ts: str, z: float = 2.0, by: Sequence[str] = ()) -> DataFrame:
    """Score each day's row count against all earlier days of its group.

    Pre-aggregates to the day grain first, so the window runs over days, not
    rows. ``z_score`` is NULL where there is no usable history.
    """
    days = daily_counts(df, ts, by)
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.avg("row_count").over(w)
    sd = F.stddev_samp("row_count").over(w)
    return (days.withColumns({"mean_prior": mean, "stddev_prior": sd})
            .withColumn("z_score", F.try_divide(F.abs(F.col("row_count") - F.col("mean_prior")),
                                                F.col("stddev_prior")))
            .withColumn("is_anomaly", F.coalesce(F.col("z_score") > z, F.lit(False))))


def _problems(tables: Mapping[str, DataFrame], required: Mapping[str, Mapping[str, str]]) -> list[tuple[str, str, str | None]]:
    rows: list[tuple[str, str, str | None]] = []
    for name, columns in required.items():
        df = tables.get(name)
        if df is None:
            rows.append((name, "missing table", None))
            continue
        have = dict(df.dtypes)
        rows += [(name, "missing column", c) for c in columns if c not in have]
        rows += [(name, "other type", f"{c} {have[c]}") for c, t in columns.items() if c in have and t and have[c] != t]
        if df.isEmpty():
            rows.append((name, "empty", None))
    return rows


def input_report(spark: SparkSession, tables: Mapping[str, DataFrame], required: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``table_name, problem, detail``: a row for every problem of the required
    tables (name -> column -> type), none if there is nothing to say. Names and
    types come from the schemas; whether there are rows from a probe of one, so
    no table is scanned. Problems: ``missing table``, ``missing column``,
    ``other type``, ``empty``."""
    return spark.createDataFrame(_problems(tables, required), "table_name string, problem string, detail string")


def validate_inputs(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> list[str]:
    """The problems of ``input_report`` as text, one a table and kind, for columns of any type."""
    out = []
    for name, columns in required.items():
        found = _problems(tables, {name: dict.fromkeys(columns, "")})
        missing = [detail for _, problem, detail in found if problem == "missing column"]
        if any(problem == "missing table" for _, problem, _ in found):
            out.append(f"{name}: missing")
        if missing:
            out.append(f"{name}: missing columns {missing}")
        if any(problem == "empty" for _, problem, _ in found):
            out.append(f"{name}: empty")
    return out
