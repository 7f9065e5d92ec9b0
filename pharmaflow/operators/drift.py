"""Baselines, data drift and performance monitoring.

Statistics are aggregated per feature with one scan per side; drift is a
join of two small per-feature (or per-value) tables. Only those aggregated
tables are ever joined, never raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from ..functions import missing

from .quantiles import quantiles
from .windows import history_mean, trend_label

# The reference's drift thresholds (defaults of the parameters).
NUMERIC_THRESHOLD = 0.1   # mean/std shift in baseline std units
PSI_THRESHOLD = 0.2
ACCURACY_DROP = 0.05
PSI_FLOOR = 0.0001        # share used for a value absent on one side


def _clean(df: DataFrame, c: str) -> Column:
    """Float NaN counts as missing, like pandas."""
    return F.when(~missing(df, c), F.col(c))


def _unpivot(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    """(feature, value) rows for ``cols`` (one narrow explode, no shuffle)."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), _clean(df, c).cast(cast).alias("value"))
        for c in cols])).alias("u")).select("u.*")


# ---------------------------------------------------------------- D1
def _per_column(df: DataFrame, cols: Sequence[str], measures: dict) -> DataFrame:
    """(feature, measures...) from one aggregate over the columns themselves, without a row per
    column. ``measures`` maps names to functions of a column's value."""
    values = [_clean(df, c).cast("double") for c in cols]
    row = df.agg(*[make(v).alias(f"{name}{i}") for i, v in enumerate(values) for name, make in measures.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{name}{i}").alias(name) for name in measures])
        for i, c in enumerate(cols)])).alias("u")).select("u.*")


def numeric_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, median): exact medians of the columns that have values."""
    return quantiles(_unpivot(df, cols, "double"), [0.5]).withColumnRenamed("q0", "median")


MOMENTS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
           "missing_ratio": lambda v: F.count_if(v.isNull()) / F.count(F.lit(1)),
           "rows": lambda v: F.count(F.lit(1))}


def numeric_stats(df: DataFrame, cols: Sequence[str], approx: bool = False,
                  accuracy: int = 10000, **options) -> DataFrame:
    """Per numeric feature: mean, sample std, min, max, median, q25, q75,
    missing ratio, rows. The moments are one aggregate over the columns. Quartiles
    are exact and linear-interpolated (``operators.quantiles``, which takes
    ``options``); ``approx=True`` takes ``percentile_approx`` with the given
    accuracy in the same aggregate instead."""
    order = ["feature", "mean", "std", "min", "max", "median", "q25", "q75", "missing_ratio", "rows"]
    if not cols:
        raise ValueError("no columns")
    if approx:
        more = {"q": lambda v: F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)}
        at = {n: F.col("q")[i] for i, n in enumerate(["q25", "median", "q75"])}
        return _per_column(df, cols, MOMENTS | more).withColumns(at).select(*order)
    q = quantiles(_unpivot(df, cols, "double"), [0.25, 0.5, 0.75], **options).withColumnsRenamed(
        {"q0": "q25", "q1": "median", "q2": "q75"})
    # one row per column on either side
    return _per_column(df, cols, MOMENTS).join(F.broadcast(q), "feature", "left").select(*order)


# ---------------------------------------------------------------- D2
def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, count) for categorical ``cols``, NULL values included
    as their own row. One shuffle for all columns, combined map-side."""
    return (_unpivot(df, cols, "string").groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def value_dist(df: DataFrame, cols: Sequence[str], top: int | None = None,
               normalize: bool = True) -> DataFrame:
    """Per feature, value shares of non-NULL rows (``normalize``) or raw
    counts, optionally only the ``top`` most frequent (value breaks ties)."""
    return dist_from_counts(value_counts(df, cols), top, normalize)


def dist_from_counts(vc: DataFrame, top: int | None = None, normalize: bool = True) -> DataFrame:
    """``value_dist`` from a (feature, value, count) table."""
    vc = vc.where(F.col("value").isNotNull())
    if normalize:
        totals = vc.groupBy("feature").agg(F.sum("count").alias("_all"))
        out = vc.join(totals, "feature").withColumn("ratio", F.col("count") / F.col("_all")).drop("_all")
    else:
        out = vc.withColumn("ratio", F.col("count").cast("double"))
    if top:
        from pyspark.sql import Window  # the top rows are cut before the shuffle too
        w = Window.partitionBy("feature").orderBy(F.col("count").desc(), F.col("value"))
        out = out.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top).drop("_r")
    return out


def category_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per categorical feature: distinct values, most frequent value and
    its share of all rows, missing ratio, rows."""
    return stats_from_counts(value_counts(df, cols))


def stats_from_counts(vc: DataFrame) -> DataFrame:
    """``category_stats`` from a (feature, value, count) table."""
    nn = F.col("value").isNotNull()
    return vc.groupBy("feature").agg(
        F.count_if(nn).alias("unique_values"),
        F.min_by(F.when(nn, F.col("value")),
                 F.when(nn, F.struct((-F.col("count")).alias("c"), F.col("value").alias("v"))))
        .alias("most_frequent"),
        (F.coalesce(F.max(F.when(nn, F.col("count"))), F.lit(0)) / F.sum("count"))
        .alias("most_frequent_ratio"),
        (F.coalesce(F.sum(F.when(~nn, F.col("count"))), F.lit(0)) / F.sum("count"))
        .alias("missing_ratio"),
        F.sum("count").alias("rows"))


def _materialized_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts computed once and checkpointed (in the shared
    ``spark.checkpoint.dir``), so every table derived from them reuses one
    scan of ``df`` instead of re-reading it."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return value_counts(df, cols).checkpoint(eager=True)


# ---------------------------------------------------------------- D3 / D4
def prediction_stats(df: DataFrame, col: str) -> DataFrame:
    """D3: mean, population std, min, max, exact median of predictions (one row)."""
    rows = df.select(F.lit(0).alias("feature"), F.col(col).cast("double").alias("value"))
    v = F.col("value")
    stats = rows.agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                     F.lit(0).alias("feature"))
    return stats.join(F.broadcast(quantiles(rows, [0.5])), "feature", "left").select(
        "mean", "std", "min", "max", F.col("q0").alias("median"))


def prediction_histogram(df: DataFrame, col: str) -> DataFrame:
    """D3: counts per integer prediction 0..max, gaps filled with 0
    (``bincount``). The bins are a distributed range up to the max, joined with
    the counts. A negative prediction raises."""
    counts = df.groupBy(F.col(col).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    low, high = counts.agg(F.min("bin"), F.max("bin")).first()
    if low is not None and low < 0:
        raise ValueError(f"negative prediction {low}")
    bins = df.sparkSession.range(0 if high is None else high + 1).select(F.col("id").cast("int").alias("bin"))
    return (bins.join(counts, "bin", "left")
                .select("bin", F.coalesce("count", F.lit(0)).alias("count")))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count per target value (NULLs dropped)."""
    return (df.where(F.col(target).isNotNull()).groupBy(target)
              .agg(F.count(F.lit(1)).alias("count")))


def baseline(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
             compat: bool = False) -> dict[str, DataFrame]:
    """D1+D2 baseline tables: ``feature_stats``, ``category_stats`` and
    ``value_dist`` (shares; ``compat=True`` keeps the top-10 raw counts)."""
    out = {}
    if numeric:
        out["feature_stats"] = numeric_stats(df, numeric)
    if categorical:
        vc = _materialized_counts(df, categorical)
        out["category_stats"] = stats_from_counts(vc)
        out["value_dist"] = (dist_from_counts(vc, top=10, normalize=False) if compat
                             else dist_from_counts(vc))
    return out


# ---------------------------------------------------------------- D5
DRIFT_COLUMNS = ["feature", "drift_type", "drift_score", "drift_detected"]


def numeric_drift(base_stats: DataFrame, current: DataFrame, cols: Sequence[str],
                  threshold: float = NUMERIC_THRESHOLD) -> DataFrame:
    """score = max(|dmean|, |dstd|) / baseline std (0 when that std is
    not > 0); drift when score > threshold. A feature whose current values
    are all missing drifts with type 'missing_data' and score 0. Features
    absent from the baseline are skipped."""
    cur = _per_column(current, cols, {"current_mean": F.avg, "current_std": F.stddev_samp, "current_n": F.count})
    b = base_stats.select("feature", F.col("mean").alias("baseline_mean"),
                          F.col("std").alias("baseline_std"))
    j = cur.join(b, "feature")  # one row per feature on both sides
    bs = F.col("baseline_std")
    pos = bs.isNotNull() & (bs > 0)
    mean_d = F.when(pos, F.abs(F.col("current_mean") - F.col("baseline_mean")) / bs).otherwise(F.lit(0.0))
    std_d = F.when(pos, F.abs(F.col("current_std") - bs) / bs).otherwise(F.lit(0.0))
    missing = F.col("current_n") == 0
    score = F.when(missing, F.lit(0.0)).otherwise(F.greatest(mean_d, std_d))
    return j.select(
        "feature",
        F.when(missing, F.lit("missing_data")).otherwise(F.lit("statistical")).alias("drift_type"),
        F.coalesce(score, F.lit(0.0)).alias("drift_score"),
        (missing | (F.coalesce(score, F.lit(0.0)) > F.lit(threshold))).alias("drift_detected"),
        "baseline_mean", "current_mean", "baseline_std", "current_std",
        F.when(missing, None).otherwise(mean_d).alias("mean_drift"),
        F.when(missing, None).otherwise(std_d).alias("std_drift"))


# ---------------------------------------------------------------- D6
def psi(base_dist: DataFrame, cur_dist: DataFrame) -> DataFrame:
    """Population stability index per feature over the union of values:
    sum((c - b) * ln(c / b)), a value missing on one side counting 0.0001."""
    b = base_dist.select("feature", "value", F.col("ratio").alias("b"))
    c = cur_dist.select("feature", "value", F.col("ratio").alias("c"))
    j = b.join(c, ["feature", "value"], "full_outer")
    bb = F.coalesce(F.col("b"), F.lit(PSI_FLOOR))
    cc = F.coalesce(F.col("c"), F.lit(PSI_FLOOR))
    term = F.when((bb > 0) & (cc > 0), (cc - bb) * F.ln(cc / bb)).otherwise(F.lit(0.0))
    return j.groupBy("feature").agg(F.sum(term).alias("psi"))


def categorical_drift(base: dict[str, DataFrame], current: DataFrame, cols: Sequence[str],
                      threshold: float = PSI_THRESHOLD) -> DataFrame:
    """PSI of current shares against the baseline distribution; drift
    when PSI > threshold; all-missing current values -> 'missing_data'."""
    feats = base["category_stats"].select("feature")
    cols = list(cols)
    cur_counts = _materialized_counts(current, cols)
    nn = (cur_counts.groupBy("feature")
          .agg(F.sum(F.when(F.col("value").isNotNull(), F.col("count"))).alias("_nn")))
    cur_dist = dist_from_counts(cur_counts)
    scores = psi(base["value_dist"].join(feats, "feature", "left_semi"),
                 cur_dist.join(feats, "feature", "left_semi"))
    j = feats.join(nn, "feature").join(scores, "feature", "left")
    missing = F.coalesce(F.col("_nn"), F.lit(0)) == 0
    score = F.when(missing, F.lit(0.0)).otherwise(F.coalesce(F.col("psi"), F.lit(0.0)))
    return j.select(
        "feature",
        F.when(missing, F.lit("missing_data")).otherwise(F.lit("distribution")).alias("drift_type"),
        score.alias("drift_score"),
        (missing | (score > F.lit(threshold))).alias("drift_detected"))


# ---------------------------------------------------------------- D7
def feature_drift(base: dict[str, DataFrame], current: DataFrame, numeric: Sequence[str],
                  categorical: Sequence[str]) -> DataFrame:
    """D5 + D6 as one (feature, drift_type, drift_score, drift_detected) table."""
    parts = []
    if numeric:
        parts.append(numeric_drift(base["feature_stats"], current, numeric).select(*DRIFT_COLUMNS))
    if categorical:
        parts.append(categorical_drift(base, current, categorical).select(*DRIFT_COLUMNS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def overall_drift(features: DataFrame, threshold: float = PSI_THRESHOLD) -> DataFrame:
    """Any feature drifted; mean score of drifted features (0 if none);
    overall drift when that mean > threshold."""
    d = F.col("drift_detected")
    return features.agg(
        F.coalesce(F.bool_or(d), F.lit(False)).alias("drift_detected"),
        F.coalesce(F.avg(F.when(d, F.col("drift_score"))), F.lit(0.0)).alias("drift_score"),
        F.count(F.lit(1)).alias("features"),
        F.count_if(d).alias("drifted_features"),
    ).withColumn("overall_drift", F.col("drift_score") > F.lit(threshold))


# ---------------------------------------------------------------- D8 / D9
def performance_drift(points: DataFrame, keys: Sequence[str] = ("model", "metric"),
                      ts_col: str = "ts", value_col: str = "value",
                      drop: float = ACCURACY_DROP, window: int = 10) -> DataFrame:
    """Each point against the mean of up to ``window - 1`` earlier points
    of the same (model, metric); drift when the mean exceeds the value by
    more than ``drop``. Points without history never drift."""
    h = history_mean(points, list(keys), ts_col, value_col, window)
    dropv = F.col("historical_mean") - F.col(value_col)
    return h.withColumn("performance_drop", dropv).withColumn(
        "drift_detected", (F.col("n_history") >= 1) & F.coalesce(dropv > F.lit(drop), F.lit(False)))


def monitoring_summary(points: DataFrame, baselines: DataFrame | None = None,
                       model_col: str = "model", ts_col: str = "ts",
                       metric_col: str = "metric", value_col: str = "value",
                       trend_metric: str = "accuracy") -> DataFrame:
    """Per model: monitoring points (distinct times), last time, whether
    a baseline exists, and the trend of the last three ``trend_metric``
    values (W3)."""
    summ = points.groupBy(model_col).agg(
        F.count_distinct(ts_col).alias("total_monitoring_points"),
        F.max(ts_col).alias("last_monitoring_time"))
    tr = trend_label(points.where(F.col(metric_col) == trend_metric), [model_col], ts_col, value_col)
    out = summ.join(tr, model_col, "left").withColumn(
        "performance_trend", F.coalesce(F.col("trend"), F.lit("stable"))).drop("trend")
    if baselines is not None:
        b = baselines.select(model_col).distinct().withColumn("has_baseline", F.lit(True))
        out = out.join(b, model_col, "left").withColumn(
            "has_baseline", F.coalesce(F.col("has_baseline"), F.lit(False)))
    else:
        out = out.withColumn("has_baseline", F.lit(False))
    return out


def drift(base_df: DataFrame, current: DataFrame, numeric: Sequence[str],
          categorical: Sequence[str], compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """D5-D7 in one call: per-feature drift rows and the overall row.

    ``compat=True`` compares current shares with the baseline's top-10 raw
    counts, as the reference did; the default compares shares with shares.
    """
    base = baseline(base_df, numeric, categorical, compat=compat)
    feats = feature_drift(base, current, numeric, categorical)
    return feats, overall_drift(feats)


def write_monitoring_report(points: DataFrame, path: str, baselines: DataFrame | None = None,
                            drop: float = ACCURACY_DROP) -> None:
    """D9 JSON sink: the per-model summary and the per-point drift rows."""
    monitoring_summary(points, baselines).write.mode("overwrite").json(f"{path.rstrip('/')}/summary")
    performance_drift(points, drop=drop).write.mode("overwrite").json(f"{path.rstrip('/')}/points")
