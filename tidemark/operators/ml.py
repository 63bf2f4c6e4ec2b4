"""Machine-learning data work: feature tables, point-in-time training sets,
distributed training and scoring with ``pyspark.ml``, closed-form metrics,
drift, A/B assignment and decision rules.

Training and scoring run on executors (``pyspark.ml`` estimators and
``transform``); metrics are single aggregations, so nothing is pulled to the
driver except a fitted model's parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit, ts_lit
from tidemark.operators.joins import asof_join
from tidemark.operators.layout import partitions_for


def feature_table(events: DataFrame, key: str, ts: str, value: str, as_of, days: int = 30) -> DataFrame:
    """Per key over ``[as_of - days, as_of)``: mean value, count, last seen."""
    hi = ts_lit(as_of)
    lo = hi - F.expr(f"INTERVAL {int(days)} DAYS")
    w = events.where((F.col(ts) >= lo) & (F.col(ts) < hi))
    return w.groupBy(key).agg(
        (F.sum(F.col(value).cast("decimal(12,2)")).cast("double") / F.count(value)).alias("avg_value"),
        F.count(F.lit(1)).alias("n_events"), F.max(ts).alias("last_seen"))


def daily_feature_snapshots(events: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Per key and day: features that become available when the day ends."""
    return (events.groupBy(key, F.to_date(ts).alias("day"))
            .agg(F.count(F.lit(1)).alias("day_events"),
                 F.sum(F.col(value).cast("decimal(12,2)")).cast("double").alias("day_value"))
            .withColumn("feature_ts", F.date_add("day", 1).cast("timestamp_ntz")))


def training_set(labels: DataFrame, features: DataFrame, key: str, label_ts: str, feature_ts: str,
                 feature_cols: Sequence[str]) -> DataFrame:
    """Labels joined to the latest feature row at or before each label time
    (point-in-time correct: no feature from the future leaks in)."""
    return asof_join(labels, features, [key], label_ts, feature_ts, feature_cols)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features", invalid: str = "skip") -> DataFrame:
    """The feature vector; rows with a NULL feature are left out for training
    and kept (with NaN) where ``invalid`` is ``keep``."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid).transform(df)


FOREST_BYTES = 32 * 1024 * 1024


def forest_partitions(rows: int, num_trees: int, features: int) -> int:
    """Partitions of about ``FOREST_BYTES`` for the estimator's cache, whose rows
    hold a sample count and a tree node per tree: far more than the training
    rows, whose bytes decide the partitions that a shuffle leaves."""
    return partitions_for(rows * (8 * num_trees + 4 * features + 100), FOREST_BYTES)


def train_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, seed: int = 42,
                 max_depth: int = 5):
    """Random-forest regression trained on the executors."""
    from pyspark.ml.regression import RandomForestRegressor
    # more tree nodes per pass over the data (fewer passes); the training set
    # itself is cached by the estimator as binned points (MEMORY_AND_DISK)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed,
                               maxDepth=max_depth, maxMemoryInMB=1024, cacheNodeIds=True)
    known = df.dropna(subset=list(features))
    n = forest_partitions(known.count(), num_trees, len(features))
    points = assemble(df, features).select("features", label)
    return rf.fit(points.repartition(n) if n > 1 else points)


def train_linear(df: DataFrame, features: Sequence[str], label: str):
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(featuresCol="features", labelCol=label).fit(assemble(df, features))


@dataclass(frozen=True)
class LinearModel:
    """Least squares over ``features``: an intercept and a coefficient each;
    NaN where the training rows do not determine them."""
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    n: int
    mse: float
    r2: float


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearModel:
    """Linear regression by the normal equations. One aggregation gives all sums
    of products (the Gram matrix, combined on the map side); what the driver
    solves has as many rows as there are features. Decimal columns are summed
    exactly, so the result does not depend on partitions. Rows with a NULL in a
    feature or the label are left out."""
    import numpy as np
    cols = [*features, label]
    known = df.dropna(subset=cols)
    k = len(cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = known.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col(c)).cast("double").alias(f"s{i}") for i, c in enumerate(cols)),
                    *(F.sum(F.col(cols[i]) * F.col(cols[j])).cast("double").alias(f"p{i}_{j}") for i, j in pairs)).first()
    n = row["n"]
    if not n:
        return LinearModel(tuple(features), float("nan"), (float("nan"),) * (k - 1), 0, float("nan"), float("nan"))
    mean = np.array([row[f"s{i}"] for i in range(k)]) / n
    cov = np.zeros((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"p{i}_{j}"] - row[f"s{i}"] * row[f"s{j}"] / n
    # scaled to correlations, so that units do not matter for what counts as singular
    scale = np.sqrt(np.diag(cov)[:-1])
    scale = np.where(scale > 0, scale, 1.0)
    a = cov[:-1, :-1] / np.outer(scale, scale)
    b = cov[:-1, -1] / scale
    w = np.full(k - 1, np.nan) if np.linalg.matrix_rank(a) < k - 1 else np.linalg.solve(a, b) / scale
    sse = max(float(cov[-1, -1] - w @ cov[:-1, -1]), 0.0) if not np.isnan(w).any() else float("nan")
    return LinearModel(tuple(features), float(mean[-1] - w @ mean[:-1]), tuple(map(float, w)), n, sse / n,
                       float(1.0 - sse / cov[-1, -1]) if cov[-1, -1] > 0 else float("nan"))


def score_linear(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    """The model as one native expression, on batches and streams alike: NULL where a feature is NULL."""
    total = F.lit(model.intercept)
    for f, w in zip(model.features, model.coefficients):
        total = total + F.col(f).cast("double") * F.lit(w)
    return df.withColumn(out, total)


def score(df: DataFrame, model, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Apply a fitted model over all partitions (works on streams too): one row
    per input row, NULL where a feature is NULL."""
    s = model.transform(assemble(df, features, invalid="keep"))
    known = F.lit(True)
    for f in features:
        known = known & F.col(f).isNotNull()
    s = s.withColumn("prediction", F.when(known, F.col("prediction")))
    if out != "prediction":
        s = s.withColumnRenamed("prediction", out)
    return s.drop("features")


def regression_metrics(df: DataFrame, pred: str, actual: str, by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, MSE, RMSE, R^2 in one aggregation (closed form); R^2 is NULL
    where the actual values do not vary."""
    err = F.col(pred) - F.col(actual)
    n = F.count(F.lit(1))
    sy = F.sum(F.col(actual)).cast("double")
    syy = F.sum(F.col(actual) * F.col(actual)).cast("double")
    sse = F.sum(err * err).cast("double")
    return df.groupBy(*by).agg(
        n.alias("n"), (F.sum(F.abs(err)).cast("double") / n).alias("mae"), (sse / n).alias("mse"),
        F.sqrt(sse / n).alias("rmse"), (F.lit(1.0) - F.try_divide(sse, syy - sy * sy / n)).alias("r2"))


def drift(df: DataFrame, is_train: Column, is_prod: Column, features: Sequence[str],
          alert: float = 2.0) -> DataFrame:
    """Mean-shift drift per feature, |mu_train - mu_prod| / sigma_train, from one
    scan over both sets; plus an ``overall`` row with the average score."""
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.avg(F.when(is_train, x)).alias(f"tm{i}"), F.stddev_samp(F.when(is_train, x)).alias(f"ts{i}"),
                 F.avg(F.when(is_prod, x)).alias(f"pm{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{f}', tm{i}, pm{i}, ts{i}" for i, f in enumerate(features))
    long = wide.selectExpr(f"stack({len(features)}, {parts}) AS (feature, train_mean, prod_mean, train_std)")
    long = long.withColumn("drift_score", F.try_divide(F.abs(F.col("train_mean") - F.col("prod_mean")), F.col("train_std")))
    return long.withColumn("alert", F.col("drift_score") > alert)


def ab_assign(df: DataFrame, key: str, arms: Sequence[str] = ("A", "B"), out: str = "test_group") -> DataFrame:
    """Stable arm from the first 60 bits of md5(key): same key, same arm on
    every engine and run (no dependence on Spark's internal hash), even shares
    for any number of arms. A NULL key has no arm."""
    b = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long") % len(arms)
    expr = None
    for i, a in enumerate(arms):
        expr = F.when(b == i, a) if expr is None else expr.when(b == i, a)
    return df.withColumn(out, expr)


def decision_rules(df: DataFrame, rules: Sequence[tuple[str, str]], default: str, out: str) -> DataFrame:
    """First matching (predicate, label) wins, else ``default``."""
    expr = None
    for pred, label in rules:
        expr = F.when(F.expr(pred), label) if expr is None else expr.when(F.expr(pred), label)
    return df.withColumn(out, expr.otherwise(default) if expr is not None else F.lit(default))


def tenure_features(df: DataFrame, since: str, spend: str, as_of) -> DataFrame:
    """Days since ``since`` and monthly spend (spend / days x 30; zero days -> NULL)."""
    days = F.datediff(date_lit(as_of), F.to_date(since))
    return df.withColumns({"tenure_days": days,
                           "avg_monthly_spend": F.try_divide(F.col(spend).cast("double"), days) * 30})


def retrain_gate(metrics: DataFrame, trained_at: str, r2: str, as_of, max_age_days: int = 7,
                 min_r2: float = 0.8, promote_r2: float = 0.85) -> DataFrame:
    age = F.datediff(date_lit(as_of), F.to_date(trained_at))
    return metrics.withColumns({"age_days": age,
                                "needs_retrain": (age > max_age_days) | (F.col(r2) < min_r2),
                                "promote": F.col(r2) > promote_r2})


def group_rates(df: DataFrame, group: str, flags: Mapping[str, Column], value: str) -> DataFrame:
    """Per arm: units, rate of each flag, exact mean value."""
    n = F.count(F.lit(1))
    return df.groupBy(group).agg(
        n.alias("n"), *[(F.count_if(c).cast("double") / n).alias(f"{k}_rate") for k, c in flags.items()],
        (F.sum(F.col(value).cast("decimal(12,2)")).cast("double") / F.count(value)).alias("avg_value"))
