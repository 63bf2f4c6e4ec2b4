"""Periodic-snapshot trend operators: cumulative month-end claim snapshots ->
quarterly totals and period-over-period emergence.

Every function is ``DataFrame -> DataFrame``. Lookups are joined with a size
checked broadcast; the grouping work is hash aggregation (partial + final, so a
hot group is pre-aggregated map-side); the differencing window runs on the
already-aggregated period grain, never on raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import quarter_end
from tidemark.operators.quality import expect_or_fail
from tidemark.session import broadcast_if_small, materialize

# Fixed values of the claims model.
REAL_CLAIM_CATEGORIES = [2, 4, 5, 6, 7]
CLAIM_CATEGORY_LIMIT = 9          # category < 9 is a claim
OPEN_CATEGORY = 2                 # CL01: category 2 with status Open
OPEN_STATUS = "Open"
PRIMARY_LOB = 1                   # LOB_SK 1 = primary line
PRIMARY_LOB_NAME = "LPL"          # the same when only a LOB name is present
SUPPLEMENTAL_LOB = 4              # supplemental lines collapse to 4
NOT_APPLICABLE = -2               # sentinel for "does not apply"

GOLD_COLUMNS = ["QUARTER_END", "LOB_SK", "AOP_SK", "PRIMARY_CAUSE_OF_LOSS_SK",
                "CLAIMANT_TYPE_SK", "FIRM_PAID", "PAID_LOSS", "INCURRED_LOSS",
                "GROUND_UP_PAID"]
MONEY_OUT = ["FIRM_PAID", "PAID_LOSS", "INCURRED_LOSS", "GROUND_UP_PAID"]


def add_indicators(df: DataFrame) -> DataFrame:
    """IS_CLAIM, IS_REAL_CLAIM and IS_SUPPLEMENTAL as 0/1 integers.

    IS_SUPPLEMENTAL is 0 only for the primary line: ``LOB_SK = 1`` when that
    column exists, else ``LOB = 'LPL'``. NULL category gives 0/0, NULL LOB 1.
    """
    cat = F.col("MATTER_CATEGORY_SK")
    if "LOB_SK" in df.columns:
        primary = F.col("LOB_SK") == PRIMARY_LOB
    else:
        primary = F.col("LOB") == PRIMARY_LOB_NAME
    return df.withColumns({
        "IS_CLAIM": F.when(cat < CLAIM_CATEGORY_LIMIT, 1).otherwise(0),
        "IS_REAL_CLAIM": F.when(cat.isin(REAL_CLAIM_CATEGORIES), 1).otherwise(0),
        "IS_SUPPLEMENTAL": F.when(primary, 0).otherwise(1),
    })


def open_flag() -> Column:
    return F.when((F.col("MATTER_CATEGORY_SK") == OPEN_CATEGORY)
                  & (F.col("MATTER_STATUS_CODE") == OPEN_STATUS), 1).otherwise(0)


# The columns that add up to each reported total, and those that
# gross-of-coinsurance totals add to them.
NET_OF = {"FIRM_PAID": ["FIRM_PAID"], "PAID_LOSS": ["ALAS_PAID"], "INCURRED_LOSS": ["TOTAL_INCURRED"], "GROUND_UP_PAID": ["GROUND_UP_PAID"]}
COINSURANCE_OF = {"PAID_LOSS": ["COINS_PAID"], "INCURRED_LOSS": ["COINS_PAID", "COINS_RESERVE"], "GROUND_UP_PAID": ["COINS_PAID"]}


def money(gross: bool = False) -> dict[str, Column]:
    """The money measures by name, net or gross of coinsurance."""
    out = {}
    for name, parts in NET_OF.items():
        total = None
        for c in [*parts, *(COINSURANCE_OF.get(name, []) if gross else [])]:
            total = F.col(c) if total is None else total + F.col(c)
        out[name] = total
    return out


def totals(rows: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per combination of ``by`` with the sum of every measure."""
    return rows.groupBy(*by).agg(*(F.sum(expr).alias(name) for name, expr in measures.items()))


def period_change(df: DataFrame, mcols: Sequence[str], grpcols: Sequence[str],
                  aggcols: Sequence[str]) -> DataFrame:
    """Replace each measure by ``x - lag(x)`` within its group, ordered by the
    period columns. The first period of a group is NULL; a missing period is
    not filled (the difference is to the previous *present* row).

    Without group columns the window is global (one task): only use that on
    period-grain data, whose size does not grow with the fact table.
    """
    w = Window.partitionBy(*grpcols).orderBy(*mcols) if grpcols else Window.orderBy(*mcols)
    aggset = set(aggcols)
    return df.select(*[
        (F.col(c) - F.lag(c).over(w)).alias(c) if c in aggset else F.col(c)
        for c in df.columns
    ])


def dedupe_keyed(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """Keep the first row per key under a stated order.

    ``row_number() = 1`` lets Spark put a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most one row per key: a key holding a
    third of all rows costs no more shuffle than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def raw_snapshots(snapshots: DataFrame, raw_matters: DataFrame) -> DataFrame:
    """Raw layer: indicators, matter attributes, MONTH_END and QUARTER_END.

    Fails inside the executors if a month or quarter end is NULL.
    """
    return (snapshots
            .transform(add_indicators)
            .join(raw_matters.select("MATTER_SK", "DATE_REPORTED", "CLAIMANT_TYPE_SK"),
                  on="MATTER_SK", how="left")
            .withColumnRenamed("AS_OF_DATE", "MONTH_END")
            .transform(quarter_end)
            .transform(expect_or_fail, {"no null dates":
                                        "MONTH_END IS NOT NULL AND QUARTER_END IS NOT NULL"}))


def code_map(lookup: DataFrame, code: str, group: str) -> DataFrame:
    """``code, _rep``: code -> representative (smallest) code of its group, one
    row per code; a code of several groups belongs to the smallest one. The
    lookup is read once."""
    rep = F.min(code).over(Window.partitionBy(group))
    pairs = lookup.select(code, group).distinct().withColumn("_rep", rep)
    return pairs.groupBy(code).agg(F.min_by("_rep", group).alias("_rep"))


def conform(df: DataFrame, code: str, lookup: DataFrame, group: str,
            choose=None) -> DataFrame:
    """Remap ``code`` to the representative code of its group.

    ``lookup`` maps code -> group. ``choose(rep)`` turns the representative
    column into the final value (default: the representative itself). The
    lookup, which may be derived from a large table, is read once: the code map
    is written to the shared folder and broadcast if its files are small. It is
    unique per code, so the left join cannot fan out. NULL codes have no group.
    """
    mapping = broadcast_if_small(materialize(code_map(lookup.where(F.col(code).isNotNull()), code, group), "code-map"))
    out = df.join(mapping, on=code, how="left")
    new = choose(F.col("_rep")) if choose else F.col("_rep")
    return out.select(*[new.alias(code) if c == code else F.col(c) for c in df.columns])


def conform_aop(df: DataFrame, aop_lookup: DataFrame) -> DataFrame:
    """AOP -> representative of its AOP group; supplemental rows get -2."""
    return conform(df, "AOP_SK", aop_lookup, "AOP_GROUP_2",
                   choose=lambda rep: F.when(F.col("IS_SUPPLEMENTAL") == 1,
                                             F.lit(NOT_APPLICABLE).cast("bigint")).otherwise(rep))


def conform_cause(df: DataFrame, cause_lookup: DataFrame) -> DataFrame:
    """Primary line: cause -> representative of its cause type. Supplemental
    lines keep their cause; a row with no usable LOB gets NULL."""
    lob = F.col("LOB_SK")
    return conform(df, "PRIMARY_CAUSE_OF_LOSS_SK", cause_lookup, "CAUSE_TYPE",
                   choose=lambda rep: F.when(lob == PRIMARY_LOB, rep)
                   .when(lob > PRIMARY_LOB, F.col("PRIMARY_CAUSE_OF_LOSS_SK")))


BRONZE_ORDER = ["SRC_LINE", "SRC_PART", "SRC_SUPP", "SRC_SHIPDATE"]


def bronze_snapshots(raw: DataFrame, aop_lookup: DataFrame, cause_lookup: DataFrame,
                     order_by: Sequence[str] = BRONZE_ORDER) -> DataFrame:
    """One row per (MATTER_SK, MONTH_END) with conformed AOP and cause.

    The de-duplication keeps the first row in ``order_by`` order, then both
    conformations are applied to the kept row itself (no re-join by matter, so
    a cause that changes over time cannot fan out).
    """
    return (dedupe_keyed(raw, ["MATTER_SK", "MONTH_END"], order_by)
            .transform(conform_aop, aop_lookup)
            .transform(conform_cause, cause_lookup))


def select_periods(df: DataFrame, month_end=None, newest: DataFrame | None = None) -> DataFrame:
    """Quarter-end rows plus the rows of one open month.

    ``month_end`` is a date/ISO string, ``"latest"`` (the newest MONTH_END, as
    a scalar subquery over ``newest``, which defaults to ``df``), or None for
    quarter ends only. A month that is itself a quarter end is counted once.
    """
    cond = F.col("MONTH_END") == F.col("QUARTER_END")
    if month_end is not None:
        if month_end == "latest":
            target = (df if newest is None else newest).agg(F.max("MONTH_END")).scalar()
        else:
            target = F.lit(month_end).cast("date")
        cond = cond | (F.col("MONTH_END") == target)
    return df.where(cond)


GOLD_KEYS = ["LOB_SK", "AOP_SK", "PRIMARY_CAUSE_OF_LOSS_SK", "CLAIMANT_TYPE_SK"]
_MONEY_SUMS = list(NET_OF)


def month_totals(bronze: DataFrame) -> DataFrame:
    """Money totals per month and reporting keys, of both lines in one pass.

    Every row gets its keys first (primary line: LOB 1, its AOP, claimant -2;
    supplemental lines: LOB 4, AOP -2, its claimant; rows of no line have NULL
    keys and only tell their month). Months x keys is small however many
    snapshots there are, so periods are chosen here and not on the facts."""
    lob, na = F.col("LOB_SK"), F.lit(NOT_APPLICABLE).cast("bigint")
    primary, other = lob == PRIMARY_LOB, lob > PRIMARY_LOB
    keys = {"LOB_SK": F.when(primary, F.lit(PRIMARY_LOB)).when(other, F.lit(SUPPLEMENTAL_LOB)).cast("bigint"),
            "AOP_SK": F.when(primary, F.col("AOP_SK")).when(other, na),
            "PRIMARY_CAUSE_OF_LOSS_SK": F.when(primary | other, F.col("PRIMARY_CAUSE_OF_LOSS_SK")),
            "CLAIMANT_TYPE_SK": F.when(primary, na).when(other, F.col("CLAIMANT_TYPE_SK"))}
    rows = bronze.select("MONTH_END", "QUARTER_END", *(e.alias(k) for k, e in keys.items()), *dict.fromkeys(c for cols in NET_OF.values() for c in cols))
    return totals(rows, ["MONTH_END", "QUARTER_END", *GOLD_KEYS], money())


def gold_aggregate(bronze: DataFrame, month_end=None) -> DataFrame:
    """Quarterly totals of both lines from one pass over ``bronze``. For the
    latest month the month totals are written once, as they are read for the
    newest month and for the totals."""
    months = month_totals(bronze)
    if month_end == "latest":
        months = materialize(months, "month-totals")
    chosen = select_periods(months, month_end).where("LOB_SK IS NOT NULL")
    out = totals(chosen, ["QUARTER_END", *GOLD_KEYS], {c: F.col(c) for c in _MONEY_SUMS})
    return expect_or_fail(out, {"no null dates": "QUARTER_END IS NOT NULL"})


def silver_aggregate(bronze: DataFrame, primary: bool, month_end=None) -> DataFrame:
    """Quarterly money totals for the primary line or the supplemental lines."""
    return gold_aggregate(bronze, month_end).where(F.col("LOB_SK") == (PRIMARY_LOB if primary else SUPPLEMENTAL_LOB))


def silver_emergence(silver_agg: DataFrame, primary: bool) -> DataFrame:
    """Quarter-over-quarter emergence of the quarterly totals, per group."""
    grp = ["PRIMARY_CAUSE_OF_LOSS_SK", "AOP_SK"] if primary else \
        ["PRIMARY_CAUSE_OF_LOSS_SK", "CLAIMANT_TYPE_SK"]
    return period_change(silver_agg, ["QUARTER_END"], grp, _MONEY_SUMS)


def open_counts(bronze: DataFrame, primary: bool) -> DataFrame:
    """Open CL01 matters per MONTH_END and group (a stock, never differenced)."""
    if primary:
        df = bronze.where(F.col("LOB_SK") == PRIMARY_LOB)
        grp = ["PRIMARY_CAUSE_OF_LOSS_SK", "AOP_SK"]
        consts = {"LOB_SK": F.lit(PRIMARY_LOB).cast("bigint"),
                  "CLAIMANT_TYPE_SK": F.lit(NOT_APPLICABLE).cast("bigint")}
    else:
        df = bronze.where(F.col("LOB_SK") > PRIMARY_LOB)
        grp = ["PRIMARY_CAUSE_OF_LOSS_SK", "CLAIMANT_TYPE_SK"]
        consts = {"LOB_SK": F.lit(SUPPLEMENTAL_LOB).cast("bigint"),
                  "AOP_SK": F.lit(NOT_APPLICABLE).cast("bigint")}
    return (df.groupBy("MONTH_END", *grp)
            .agg(F.sum(open_flag()).cast("bigint").alias("CL01_COUNT"))
            .withColumns(consts))


def gold_cumulative(bronze: DataFrame, month_end=None) -> DataFrame:
    """Quarterly cumulative totals of the primary and supplemental lines."""
    return gold_aggregate(bronze, month_end).select(*GOLD_COLUMNS)


def gold_emergence(bronze: DataFrame, month_end=None) -> DataFrame:
    """Quarter-over-quarter emergence of both lines. The window partitions
    include LOB_SK, so each line is differenced within its own groups exactly
    as the per-line silver emergence tables are."""
    return period_change(gold_aggregate(bronze, month_end), ["QUARTER_END"], GOLD_KEYS,
                         _MONEY_SUMS).select(*GOLD_COLUMNS)


def money_to_double(df: DataFrame, cols: Sequence[str] = MONEY_OUT) -> DataFrame:
    """Present exact decimal money as DOUBLE at the edge of a report."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})
