"""Change data and table mutation, as DataFrame -> DataFrame operators.

Plain parquet has no MERGE/UPDATE/DELETE, so each mutation returns the new
table state (or a change feed) as a DataFrame: one shuffle join or one keyed
de-duplication, never a driver-side loop. Versions are rows of a change feed
(``_version`` and an in-version sequence), so time travel is a filter plus a
latest-per-key pick.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit, ts_lit, value_lit
from tidemark.operators.joins import compare_by_key

INSERT, DELETE = "insert", "delete"
PRE, POST = "update_preimage", "update_postimage"


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # row_number = 1 gets a partial WindowGroupLimit before the shuffle:
    # a hot key forwards at most one row per map task.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


Values = Sequence[str] | Mapping[str, str | Column]


def _values(spec: Values, source: DataFrame) -> dict[str, Column]:
    """Target column -> expression over the source."""
    items = spec.items() if isinstance(spec, Mapping) else ((c, c) for c in spec)
    return {c: F.col(e) if isinstance(e, str) else e for c, e in items if not isinstance(e, str) or e in source.columns}


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Values | None = None,
          insert: bool | Values = True) -> DataFrame:
    """MERGE INTO target USING source ON keys. Matched rows take the ``update``
    columns, unmatched source rows are inserted with the ``insert`` columns
    (the others NULL), other target rows are kept. Both are lists of columns,
    or ``{target column: source column or expression over the source}``; by
    default all non-key columns. ``insert=False`` inserts nothing.

    A key that appears more than once in ``source`` aborts the job from the
    executor (``raise_error``), as a SQL MERGE does. Source rows are counted by
    a grouped aggregate, so a hot key is combined before the shuffle.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    new = _values(cols if update is None else update, source)
    added = _values(cols if insert is True or insert is False else insert, source)
    src = source.select(*keys, F.struct(F.lit(True).alias("_"), *(e.alias(c) for c, e in new.items())).alias("_u"),
                        F.struct(F.lit(True).alias("_"), *(e.alias(c) for c, e in added.items())).alias("_i")) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first("_u").alias("_u"), F.first("_i").alias("_i")) \
        .withColumn("_chk", F.when(F.col("_n") > 1, F.raise_error(F.lit("merge: duplicate source key")))) \
        .where(F.col("_chk").isNull()).select(*keys, "_u", "_i")
    tgt = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    j = tgt.join(src, on=keys, how="full_outer")
    if insert is False:
        j = j.where(F.col("_in_t").isNotNull())
    out = []
    for c in cols:
        old = F.col(f"_t_{c}")
        fresh = F.col(f"_i.{c}") if c in added else F.lit(None)
        kept = F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(old) if c in new else old
        out.append(F.when(F.col("_in_t").isNull(), fresh).otherwise(kept).cast(target.schema[c].dataType).alias(c))
    return j.select(*keys, *out)


def apply_changes(source: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                  deletes: str | Column | None = None, except_columns: Sequence[str] = ()) -> DataFrame:
    """SCD type 1: the latest row per key by ``sequence_by``; a key whose
    latest change is a delete disappears. Control columns are dropped."""
    order = [F.col(c).desc() for c in sequence_by]
    latest = _latest(source, keys, order)
    if deletes is not None:
        pred = F.expr(deletes) if isinstance(deletes, str) else deletes
        latest = latest.where(~F.coalesce(pred, F.lit(False)))
    return latest.drop(*except_columns)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that turn ``before`` into ``after``: insert, delete and
    update_preimage/update_postimage pairs, with ``_change_type``.

    One full outer join; each compared row is expanded with ``inline`` into
    zero, one or two images (no second scan, no union).
    """
    keys = list(keys)
    cols = [c for c in before.columns if c not in keys]
    c = compare_by_key(before, after, keys, cols)
    diff = F.col("_diff")

    def img(side: str, kind: Column) -> Column:
        return F.struct(*[F.col(k) for k in keys], *[F.col(f"_{side}_{x}").alias(x) for x in cols],
                        kind.alias("_change_type"))

    old = F.when(diff.isin("delete", "update"),
                 img("b", F.when(diff == "delete", F.lit(DELETE)).otherwise(F.lit(PRE))))
    new = F.when(diff.isin("insert", "update"),
                 img("a", F.when(diff == "insert", F.lit(INSERT)).otherwise(F.lit(POST))))
    images = F.filter(F.array(old, new), lambda x: x.isNotNull())
    return c.select(F.inline(images))


def changes_between(feed: DataFrame, lo, hi, version_col: str = "_version",
                    types: Sequence[str] | None = None) -> DataFrame:
    """Feed rows with ``lo <= version <= hi`` (inclusive), optionally of some
    change types only. Versions may be numbers or timestamps."""
    out = feed.where(F.col(version_col).between(value_lit(lo), value_lit(hi)))
    if types:
        out = out.where(F.col("_change_type").isin(list(types)))
    return out


def as_of(feed: DataFrame, keys: Sequence[str], version, version_col: str = "_version",
          sequence_col: str | None = None) -> DataFrame:
    """Table state at ``version``: the newest change per key up to it, with
    deleted keys removed and pre-images ignored."""
    f = feed.where((F.col(version_col) <= value_lit(version)) & (F.col("_change_type") != PRE))
    order = [F.col(version_col).desc()] + ([F.col(sequence_col).desc()] if sequence_col else [])
    return _latest(f, keys, order).where(F.col("_change_type") != DELETE)


def restore_diff(feed: DataFrame, keys: Sequence[str], version, data_cols: Sequence[str],
                 version_col: str = "_version", sequence_col: str | None = None) -> DataFrame:
    """The change feed that turns the current state back into the state at
    ``version`` (RESTORE ... TO VERSION AS OF)."""
    cols = list(keys) + list(data_cols)
    latest_version = feed.agg(F.max(version_col)).scalar()
    current = as_of(feed, keys, latest_version, version_col, sequence_col).select(*cols)
    past = as_of(feed, keys, version, version_col, sequence_col).select(*cols)
    return change_feed(current, past, keys)


def update_where(df: DataFrame, pred: str | Column, values: Mapping[str, object]) -> DataFrame:
    """UPDATE df SET col = value WHERE pred (values are literals or Columns)."""
    p = F.coalesce(F.expr(pred) if isinstance(pred, str) else pred, F.lit(False))
    return df.withColumns({c: F.when(p, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
                           .cast(df.schema[c].dataType) for c, v in values.items()})


def purge(df: DataFrame, date_col: str, days: int | Column, as_of) -> DataFrame:
    """Rows kept by a retention rule: younger than ``days`` before ``as_of``
    (a NULL date is kept: a retention rule deletes only what it can date)."""
    d = days if isinstance(days, Column) else F.lit(days)
    cutoff = F.date_sub(date_lit(as_of), d)
    return df.where(~F.coalesce(F.to_date(date_col) < cutoff, F.lit(False)))


def purge_report(df: DataFrame, date_col: str, days: int | Column, as_of, by: Sequence[str]) -> DataFrame:
    """Kept and purged row counts per group for a retention rule (one pass)."""
    d = days if isinstance(days, Column) else F.lit(days)
    cutoff = F.date_sub(date_lit(as_of), d)
    old = F.coalesce(F.to_date(date_col) < cutoff, F.lit(False))
    return df.groupBy(*by).agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("purged"))


def erase(df: DataFrame, requests: DataFrame, key: str, columns: Sequence[str], mark: str = "[ERASED]",
          request_key: str | None = None, erased_at=None) -> DataFrame:
    """Right to erasure for many subjects at once: rows whose key is in
    ``requests`` get ``columns`` replaced by ``mark``, ``is_erased`` and
    ``erased_at``. One left join against the distinct request keys."""
    rk = request_key or key
    req = requests.select(F.col(rk).alias("_rk")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(req, df[key] == F.col("_rk"), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = j.withColumns({c: F.when(hit, F.lit(mark)).otherwise(F.col(c)) for c in columns})
    out = out.withColumn("is_erased", hit)
    if erased_at is not None:
        out = out.withColumn("erased_at", F.when(hit, ts_lit(erased_at)))
    return out.drop("_rk", "_hit")


def change_ratio(feed: DataFrame, threshold: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """Share of non-insert changes; ``triggered`` when above ``threshold``."""
    return (feed.groupBy(*by).agg(F.count(F.lit(1)).alias("total_changes"),
                                  F.count_if(F.col("_change_type") != INSERT).alias("non_insert"))
            .withColumn("change_ratio", F.col("non_insert").cast("double") / F.col("total_changes"))
            .withColumn("triggered", F.col("change_ratio") > threshold))
