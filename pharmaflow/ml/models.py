"""Models, training loop, importance, search, scoring, persistence
(M5-M9, M16-M19). All fits are Spark ML estimators (distributed); only
parameters and metrics reach the driver.

Classes are a table (value, label) that is joined, never a list of literals, so a target
may have any number of them. Cross-validation and search prepare every fold once
(``prepared_folds``); all trials read the prepared rows.
"""

from __future__ import annotations

import json
import random
import statistics
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators.prefix import dense_ids
from ..operators.small import SMALL, small
from ..session import ensure_checkpoint_dir, scratch_path
from .fits import PARALLELISM, run_fits
from .prep import TableEncoder, preprocessor_stages
from .split import class_weights, fold_ids, weight_table

MAX_TREE_DEPTH = 30  # Spark's limit, taken for "unlimited"; an explicit depth beyond it raises
ROWS_A_TASK = 20_000  # a pass over fewer takes less than it takes to start its task
# A forest keeps the node of each row in each tree. Else a task gets all trees grown so far, and each pass
# sends each row down each of them from the root; the trees are the same.
DEEP_TREES = {"cacheNodeIds": True}

# The configured algorithms and their parameters.
ALGORITHMS = {
    "logistic_regression": {"max_iter": 1000, "class_weight": "balanced", "C": 1.0},
    "random_forest": {"n_estimators": 300, "max_depth": None, "class_weight": "balanced"},
    "gradient_boosting": {"n_estimators": 300, "learning_rate": 0.1, "max_depth": 3},
}

# The predefined search spaces, by algorithm.
PARAM_SPACES = {
    "logistic_regression": {"C": ("log", 0.001, 100), "max_iter": ("int", 100, 2000), "class_weight": ("choice", [None, "balanced"])},
    "random_forest": {"n_estimators": ("int", 50, 500), "max_depth": ("int", 3, 20), "min_samples_split": ("int", 2, 20),
                      "min_samples_leaf": ("int", 1, 10), "class_weight": ("choice", [None, "balanced"])},
    "gradient_boosting": {"n_estimators": ("int", 50, 500), "learning_rate": ("float", 0.01, 0.3), "max_depth": ("int", 2, 10),
                          "min_samples_split": ("int", 2, 20), "min_samples_leaf": ("int", 1, 10)},
}

#: Algorithms whose target is a number; the others predict classes.
REGRESSORS = {
    "linear_regression": {"alpha": 0.0, "max_iter": 100},
    "random_forest_regressor": {"n_estimators": 100, "max_depth": None},
    "gradient_boosting_regressor": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
}

#: Parameters that each algorithm takes; any other name is refused.
KNOWN = {
    "logistic_regression": {"max_iter", "class_weight", "C", "tol"},
    "random_forest": {"n_estimators", "max_depth", "class_weight", "min_samples_leaf", "min_samples_split"},
    "gradient_boosting": {"n_estimators", "learning_rate", "max_depth", "min_samples_leaf", "min_samples_split"},
    "linear_regression": {"alpha", "max_iter"},
    "random_forest_regressor": {"n_estimators", "max_depth", "min_samples_leaf", "min_samples_split"},
    "gradient_boosting_regressor": {"n_estimators", "learning_rate", "max_depth", "min_samples_leaf", "min_samples_split"},
}


def _tree_params(p: Mapping) -> dict:
    """Leaf size for Spark's trees. ``min_samples_split`` rows in a node are needed
    for a cut; a cut leaves two leaves, so half of them is the leaf size that
    implies it (the larger of the two parameters counts)."""
    leaf, split = int(p.get("min_samples_leaf", 1)), int(p.get("min_samples_split", 2))
    return {"minInstancesPerNode": max(leaf, -(-split // 2), 1)}


def _depth(depth) -> int:
    if depth is None:
        return MAX_TREE_DEPTH
    if int(depth) > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {depth} is beyond {MAX_TREE_DEPTH}, the engine's limit")
    return int(depth)


def estimator(name: str, n_rows: int, n_classes: int, params: Mapping | None = None,
              label: str = "label", features: str = "features", weight: str | None = "weight",
              seed: int = 42):
    """M5-M7: the Spark estimator for a configured algorithm.

    Logistic regression: sklearn's C -> ``regParam = 1 / (C * n)`` with
    unstandardized L2. Random forest: unlimited depth is 30. Gradient boosting:
    binary ``GBTClassifier``; more classes go through ``OneVsRest``. Linear
    regression: the squared error plus ``alpha`` times the squared norm, as a sum over the rows.
    """
    p = dict(ALGORITHMS.get(name, REGRESSORS.get(name, {})))
    p.update(params or {})
    if name in KNOWN and set(p) - KNOWN[name]:
        raise ValueError(f"{name} takes no {sorted(set(p) - KNOWN[name])}")
    if name == "logistic_regression":
        est = LogisticRegression(maxIter=int(p.get("max_iter", 100)),
                                 regParam=1.0 / (float(p.get("C", 1.0)) * max(n_rows, 1)),
                                 elasticNetParam=0.0, standardization=False, tol=float(p.get("tol", 1e-6)),
                                 labelCol=label, featuresCol=features)
        if weight and p.get("class_weight") == "balanced":
            est.setWeightCol(weight)
        return est
    if name == "random_forest":
        est = RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)),
                                     maxDepth=_depth(p.get("max_depth")), **_tree_params(p), **DEEP_TREES,
                                     seed=seed, labelCol=label, featuresCol=features)
        if weight and p.get("class_weight") == "balanced":
            est.setWeightCol(weight)
        return est
    if name == "gradient_boosting":
        gbt = GBTClassifier(maxIter=int(p.get("n_estimators", 100)), stepSize=float(p.get("learning_rate", 0.1)),
                            maxDepth=_depth(p.get("max_depth", 3)), **_tree_params(p), seed=seed, labelCol=label, featuresCol=features)
        return gbt if n_classes <= 2 else OneVsRest(classifier=gbt, labelCol=label, featuresCol=features,
                                                    parallelism=min(n_classes, 4))
    if name == "linear_regression":
        return LinearRegression(maxIter=int(p["max_iter"]), regParam=float(p["alpha"]) / max(n_rows, 1),
                                elasticNetParam=0.0, standardization=False, labelCol=label, featuresCol=features)
    if name == "random_forest_regressor":
        return RandomForestRegressor(numTrees=int(p["n_estimators"]), maxDepth=_depth(p["max_depth"]), **_tree_params(p),
                                     **DEEP_TREES, seed=seed, labelCol=label, featuresCol=features)
    if name == "gradient_boosting_regressor":
        return GBTRegressor(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), maxDepth=_depth(p["max_depth"]),
                            **_tree_params(p), seed=seed, labelCol=label, featuresCol=features)
    raise ValueError(f"unknown algorithm {name}")


def class_values(df: DataFrame, target: str) -> list:
    """The classes of ``target`` in order, for a caller that knows them to be few."""
    return [r[0] for r in df.where(F.col(target).isNotNull()).select(target).distinct()
            .orderBy(target).collect()]


def class_table(df: DataFrame, target: str) -> DataFrame:
    """(value, label): the classes of ``target`` numbered 0.0, 1.0, ... in order, by prefix counts
    over ranges of values; written once."""
    values = df.where(F.col(target).isNotNull()).select(F.col(target).alias("value"))
    ids = dense_ids(values, [], ["value"], "label").select("value", F.col("label").cast("double").alias("label"))
    path = scratch_path(df.sparkSession, f"classes-{uuid.uuid4().hex[:12]}")
    ids.write.parquet(path)
    return df.sparkSession.read.schema(ids.schema).parquet(path)


def _as_table(df: DataFrame, target: str, classes) -> DataFrame:
    if classes is None:
        return class_table(df, target)
    if isinstance(classes, DataFrame):
        return classes
    schema = StructType([StructField("value", df.schema[target].dataType), StructField("label", DoubleType())])
    return df.sparkSession.createDataFrame([(c, float(i)) for i, c in enumerate(classes)], schema)


def prepare_label(df: DataFrame, target: str, label: str = "label", classes=None):
    """Target -> double label 0..k-1 in sorted class order (GBT needs {0,1}), and
    the classes as a table (``class_table``). Give the ``classes`` of the full data, as a table or
    a list, when ``df`` is a part of it: a part that lacks a class must not number the others anew. A
    value that is no class has no label."""
    classes = _as_table(df, target, classes)
    named = small(classes.select(F.col("value").alias("_class"), F.col("label").alias("_number")))
    out = df.drop(label).join(named, F.col(target) == F.col("_class"), "left").withColumn(label, F.col("_number"))
    return out.drop("_class", "_number"), classes


class EncodedModel:
    """A fitted model behind a ``TableEncoder``; used like a ``PipelineModel``."""

    def __init__(self, encoder: TableEncoder, model):
        self.encoder, self.model, self.stages = encoder, model, [model]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.encoder.transform(df))

    def save(self, df: DataFrame, path: str) -> None:
        self.encoder.save(df, f"{path}/encoder")
        PipelineModel([self.model]).write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "EncodedModel":
        return cls(TableEncoder.load(spark, f"{path}/encoder"), PipelineModel.load(f"{path}/model").stages[0])


def _labelled(df: DataFrame, target: str, algorithm: str, classes) -> tuple[DataFrame, int]:
    """Rows with a target, its number as ``label`` and balanced weights; and the number of classes."""
    data = df.where(F.col(target).isNotNull())
    if algorithm in REGRESSORS:
        return data.withColumn("label", F.col(target).cast("double")), 0
    data, classes = prepare_label(data, target, classes=classes)
    k = classes.count()
    return class_weights(data, "label", few=k <= SMALL), k


def train(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
          algorithm: str, params: Mapping | None = None, seed: int = 42,
          encoding: str = "onehot", classes=None):
    """M5-M7: fit preprocessor + model as one PipelineModel on ``df``
    (rows with a NULL target are dropped; balanced weights added). The rows are prepared once
    and kept while the constants and the model are fitted.
    ``encoding="hash"`` hashes categorical columns, ``"table"`` keeps their vocabularies as
    tables (see ``prep``; the model is then an ``EncodedModel``); ``classes`` as for ``prepare_label``."""
    return _fitted(_prepared(df, target, numeric, categorical, algorithm, encoding, classes), algorithm, params, seed)


def _prepared(df: DataFrame, target: str, numeric, categorical, algorithm: str, encoding: str = "onehot", classes=None):
    """(encoded rows, their number, the number of classes, the fitted preprocessor). The rows are
    checkpointed: a cached plan would broadcast the tables it joins again and again during a fit."""
    ensure_checkpoint_dir(df.sparkSession)
    data, k = _labelled(df, target, algorithm, classes)
    used = dict.fromkeys([*numeric, *categorical, "label", *(["weight"] if "weight" in data.columns else [])])
    cached = data.select(*used).persist()
    n = cached.count()
    data = cached.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_A_TASK))).checkpoint(eager=True)
    cached.unpersist()
    if encoding == "table":
        encoder = TableEncoder.fit(data, numeric, categorical)
    else:
        encoder = Pipeline(stages=preprocessor_stages(data, numeric, categorical, encoding=encoding)).fit(data)
    return encoder.transform(data), n, k, encoder


def _fitted(prepared, algorithm: str, params: Mapping | None, seed: int):
    rows, n, k, encoder = prepared
    est = _scaled(estimator(algorithm, n, k, params, seed=seed), rows)
    model = _without_summary(rows.sparkSession, est.fit(_dealt(rows, est, n)), algorithm)
    return EncodedModel(encoder, model) if isinstance(encoder, TableEncoder) else PipelineModel(encoder.stages + [model])


def _dealt(data: DataFrame, est, n: int) -> DataFrame:
    """The ``n`` rows in no more partitions than they fill. Boosting and the linear solvers make hundreds of
    short passes one after another, each a job with a task per partition; a forest grows all its trees in a
    few long ones and keeps its partitions, which its bootstrap samples follow."""
    if isinstance(est, (RandomForestClassifier, RandomForestRegressor)):
        return data
    return data.coalesce(max(1, -(-n // ROWS_A_TASK)))


def _scaled(est, data: DataFrame):
    """Linear regression divides its penalty by the label's standard deviation; this takes that back."""
    if isinstance(est, LinearRegression) and est.getRegParam() > 0:
        est.setRegParam(est.getRegParam() * (data.agg(F.stddev_pop("label")).first()[0] or 1.0))
    return est


def _without_summary(spark: SparkSession, model, label: str):
    """Save the fitted model under the shared checkpoint dir and reload it.

    A reloaded model carries no training summary. The summary holds the
    session, and once a session has used an ``Observation`` it can no longer
    be serialized into the model's prediction tasks.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, f"fitted-{label}-{uuid.uuid4().hex[:12]}")
    model.write().overwrite().save(path)
    return type(model).load(path)


def train_all(df: DataFrame, target: str, numeric, categorical,
              algorithms: Mapping[str, Mapping] | None = None, seed: int = 42, parallelism: int = PARALLELISM):
    """M8: fit every configured algorithm, several at a time (``fits``); a failure is recorded and the
    others go on. The rows are prepared once for all classifiers and once for all regressors.
    Returns ({name: model}, [(name, status, error, seconds)])."""
    algorithms = algorithms or ALGORITHMS
    classes = None if all(a in REGRESSORS for a in algorithms) else class_table(df, target)

    prepared = {}
    for name in algorithms:
        if (kind := name in REGRESSORS) not in prepared:
            try:
                prepared[kind] = _prepared(df, target, numeric, categorical, name, classes=classes)
            except Exception as e:  # what fails all of them is each one's failure
                prepared[kind] = e

    def fit(name: str):
        rows = prepared[name in REGRESSORS]
        if isinstance(rows, Exception):
            raise rows
        return _fitted(rows, name, algorithms[name], seed)

    done = run_fits(df.sparkSession, {n: partial(fit, n) for n in algorithms}, parallelism)
    models, log = {}, []
    for name, (model, error, seconds) in done.items():
        if error is None:
            models[name] = model
        log.append((name, "ok" if error is None else "failed", error and f"{type(error).__name__}: {error}", seconds))
    return models, log


def feature_names(model: PipelineModel, df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled vector slots, from the column metadata."""
    meta = model.transform(df.limit(0)).schema[features].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    attrs.sort(key=lambda a: a["idx"])
    return [a["name"] for a in attrs]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance) sorted descending, from a tree model's
    ``featureImportances`` or a linear model's |coefficients| (mean over
    classes)."""
    est = model.stages[-1]
    names = feature_names(model, df)
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    elif hasattr(est, "coefficientMatrix"):
        m = est.coefficientMatrix.toArray()
        vals = abs(m).mean(axis=0).tolist()
    else:
        raise ValueError("model has no importances")
    spark = df.sparkSession
    rows = list(zip(names, [float(v) for v in vals]))
    return spark.createDataFrame(rows, "feature string, importance double") \
                .orderBy(F.col("importance").desc(), "feature")


# ---------------------------------------------------------------- M17
def sample_space(space: Mapping[str, tuple], n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded random draws. ``space`` entries: ("float", lo, hi),
    ("int", lo, hi), ("log", lo, hi), ("choice", [..]) or ("fixed", v)."""
    import math
    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        d = {}
        for k, spec in space.items():
            kind = spec[0]
            if kind == "float":
                d[k] = rng.uniform(spec[1], spec[2])
            elif kind == "int":
                d[k] = rng.randint(spec[1], spec[2])
            elif kind == "log":
                d[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "choice":
                d[k] = rng.choice(list(spec[1]))
            elif kind == "fixed":
                d[k] = spec[1]
            else:
                raise ValueError(f"unknown space kind {kind}")
        trials.append(d)
    return trials


CV_SCORES = ("accuracy", "precision", "recall", "f1", "roc_auc")
REGRESSION_SCORES = ("mse", "mae", "r2")
SCORING = {"neg_mean_squared_error": ("mse", -1.0), "neg_mean_absolute_error": ("mae", -1.0)}


@dataclass
class Folds:
    """Prepared folds: for each one, all rows as the constants of its training part encode them."""
    spark: SparkSession
    path: str
    folds: int
    classes: int  # 0 for regression
    rows: list[int]  # training rows of each fold

    def part(self, fold: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/fold={fold}")


def prepared_folds(df: DataFrame, target: str, numeric, categorical, key_cols: Sequence[str], folds: int = 5,
                   seed: int = 42, encoding: str = "onehot", regression: bool = False) -> Folds:
    """M9: assign folds (stratified by class, plain for regression) and write, for every fold, label,
    weight, features and whether the row is tested. Imputation, scaling and encoding are fitted on the
    fold's training rows, once, whatever is tried on them afterwards."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    algorithm = next(iter(REGRESSORS if regression else ALGORITHMS))
    classes = None if regression else class_table(df, target)
    kept = df.where(F.col(target).isNotNull()).select(*dict.fromkeys([*key_cols, *numeric, *categorical, target]))
    data = fold_ids(kept, None if regression else target, list(key_cols), k=folds, seed=seed, col="_fold").checkpoint(eager=True)
    path, counts = scratch_path(spark, f"folds-{uuid.uuid4().hex[:12]}"), []
    for f in range(folds):
        rows = data.withColumn("_test", F.col("_fold") == f)
        rows, _ = _labelled(rows, target, algorithm, classes) if regression else (prepare_label(rows, target, classes=classes)[0], 0)
        train_rows = rows.where(~F.col("_test"))
        if encoding == "table":
            out = TableEncoder.fit(train_rows, numeric, categorical).transform(rows)
        else:
            out = Pipeline(stages=preprocessor_stages(train_rows, numeric, categorical, encoding=encoding)).fit(train_rows).transform(rows)
        if regression:
            out = out.withColumn("weight", F.lit(1.0))
        else:
            out = out.join(weight_table(train_rows, "label"), "label", "left")
        out.select("label", "weight", "features", "_test").write.parquet(f"{path}/fold={f}")
        counts.append(spark.read.parquet(f"{path}/fold={f}").where("NOT _test").count())
    return Folds(spark, path, folds, 0 if regression else classes.count(), counts)


def _fold_scores(folds: Folds, f: int, algorithm: str, params: Mapping | None, seed: int, scores: Sequence[str]) -> dict[str, float]:
    """Fit on the training part of a fold; all scores from the predictions of the rest."""
    from . import evaluate as EV
    part = folds.part(f)
    est = _scaled(estimator(algorithm, folds.rows[f], folds.classes, params, seed=seed), part.where("NOT _test"))
    pred = _without_summary(folds.spark, est.fit(_dealt(part.where("NOT _test"), est, folds.rows[f])), algorithm).transform(part.where("_test"))
    if algorithm in REGRESSORS:
        vals = EV.regression_metrics(pred).first().asDict()
    else:
        m = EV.classification_metrics(pred, "label", "prediction").first()
        vals = {"accuracy": m["accuracy"], "precision": m["precision_macro"], "recall": m["recall_macro"], "f1": m["f1_macro"]}
        if "roc_auc" in scores and "probability" in pred.columns:
            probs = pred.select("label", vector_to_array("probability").alias("p"))
            vals["roc_auc"] = EV.roc_auc(probs.select("label", F.col("p")[1].alias("s")), "label", "s") if folds.classes == 2 \
                else EV.roc_auc_ovr(probs, "label", "p").first()[0]
    return {k: float(vals[k]) for k in scores if vals.get(k) is not None}


def cross_validate(df: DataFrame, target: str, numeric, categorical, algorithm: str,
                   key_cols: Sequence[str], folds: int = 5, seed: int = 42,
                   params: Mapping | None = None, scores: Sequence[str] | None = None,
                   encoding: str = "onehot", parallelism: int = PARALLELISM) -> DataFrame:
    """M9: k-fold scores, one fit per fold, every score from that fold's predictions. Classes: stratified
    folds; precision/recall/f1 are macro averages, roc_auc is the mean over the classes when there are more
    than two. Regressors: plain folds; mse, mae and r2. Returns (score, mean, std, folds) with the
    population std."""
    regression = algorithm in REGRESSORS
    scores = scores or (REGRESSION_SCORES if regression else CV_SCORES)
    data = prepared_folds(df, target, numeric, categorical, key_cols, folds, seed, encoding, regression)

    def fit(f: int):
        return lambda: _fold_scores(data, f, algorithm, params, seed, scores)

    rows = []
    for f, (vals, error, _) in run_fits(df.sparkSession, {f: fit(f) for f in range(folds)}, parallelism).items():
        if error is not None:
            raise error
        rows += [(f, k, v) for k, v in vals.items()]
    per_fold = df.sparkSession.createDataFrame(rows, "fold int, score string, value double")
    return per_fold.groupBy("score").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                         F.count(F.lit(1)).alias("folds"))


def random_search(df: DataFrame, target: str, numeric, categorical, algorithm: str,
                  space: Mapping[str, tuple] | None = None, n_trials: int = 10, folds: int = 3,
                  key_cols: Sequence[str] = (), seed: int = 42, metric: str | None = None,
                  encoding: str = "onehot", parallelism: int = PARALLELISM):
    """Random search maximizing the mean CV score (accuracy for classes, the negative mean squared
    error for regressors) over ``space`` (default: the predefined one of the algorithm). The folds are
    prepared once; trials run several at a time and a failed one is recorded.

    Returns (history DataFrame (trial, value, std, state, params), best params).
    """
    regression = algorithm in REGRESSORS
    metric = metric or ("neg_mean_squared_error" if regression else "accuracy")
    score, sign = SCORING.get(metric, (metric, 1.0))
    if score not in (REGRESSION_SCORES if regression else CV_SCORES):
        raise ValueError(f"no score {metric} for {algorithm}")
    trials = sample_space(PARAM_SPACES[algorithm] if space is None else space, n_trials, seed)
    data = prepared_folds(df, target, numeric, categorical, list(key_cols) or [target], folds, seed, encoding, regression)

    def fit(p: Mapping):
        return lambda: [sign * _fold_scores(data, f, algorithm, p, seed, (score,))[score] for f in range(folds)]

    results = []
    for i, (vals, error, _) in run_fits(df.sparkSession, {i: fit(p) for i, p in enumerate(trials)}, parallelism).items():
        if error is None:
            results.append((i, statistics.fmean(vals), statistics.pstdev(vals), "COMPLETE", json.dumps(trials[i], sort_keys=True)))
        else:
            results.append((i, None, None, "FAIL", json.dumps({"error": str(error), **trials[i]}, default=str)))
    hist = df.sparkSession.createDataFrame(results, "trial int, value double, std double, state string, params string")
    done = [r for r in results if r[1] is not None]
    best = json.loads(max(done, key=lambda r: (r[1], -r[0]))[4]) if done else None
    return hist, best


# ---------------------------------------------------------------- M18
def score(model, df: DataFrame, model_name: str, classes=None) -> DataFrame:
    """Prediction, probability per class, confidence = max probability,
    model name and scoring time, for every row of ``df``. ``classes`` (a table or a list) turns the
    predicted number back into its class, as text."""
    out = model.transform(df)
    if "probability" in out.columns:
        probs = vector_to_array(F.col("probability"))
    else:
        # OneVsRest (multi-class GBT) has no probabilities: documented choice,
        # a softmax over the per-class raw scores.
        raw = vector_to_array(F.col("rawPrediction"))
        mx = F.array_max(raw)
        ex = F.transform(raw, lambda x: F.exp(x - mx))
        total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
        probs = F.transform(ex, lambda x: x / total)
    pred = F.col("prediction")
    if classes is not None:
        if not isinstance(classes, DataFrame):
            classes = df.sparkSession.createDataFrame([(str(c), float(i)) for i, c in enumerate(classes)], "value string, label double")
        named = small(classes.select(F.col("value").cast("string").alias("_class"), F.col("label").alias("_number")))
        out, pred = out.join(named, F.col("prediction") == F.col("_number"), "left"), F.col("_class")
    return out.select(*df.columns, pred.alias("predicted"), probs.alias("probabilities"),
                      F.array_max(probs).alias("confidence"), F.lit(model_name).alias("model_name"),
                      F.current_timestamp().alias("scored_at"))


def score_check(scored: DataFrame) -> DataFrame:
    """M18 invariants: rows scored, rows whose probabilities do not sum to 1,
    rows whose confidence is not the max probability."""
    s = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(s - 1.0) > 1e-6).alias("bad_sum"),
        F.count_if(F.col("confidence") != F.array_max("probabilities")).alias("bad_confidence"))


# ---------------------------------------------------------------- M19
MODEL_META = StructType([StructField("model_name", StringType()), StructField("algorithm", StringType()),
                         StructField("features", StringType()), StructField("path", StringType()),
                         StructField("saved_at", LongType())])


def save_model(spark: SparkSession, model, root: str, name: str, algorithm: str,
               features: Sequence[str]) -> str:
    """Overwrite-save the pipeline and append its metadata row."""
    path = f"{root.rstrip('/')}/models/{name}"
    if isinstance(model, EncodedModel):
        model.save(spark.range(0), path)
    else:
        model.write().overwrite().save(path)
    meta = spark.createDataFrame([(name, algorithm, json.dumps(list(features)), path, int(time.time()))],
                                 MODEL_META)
    meta.write.mode("append").parquet(f"{root.rstrip('/')}/model_index")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """Latest metadata row per model name."""
    from ..operators.dedup import latest_per_group
    idx = spark.read.schema(MODEL_META).parquet(f"{root.rstrip('/')}/model_index")
    return latest_per_group(idx, ["model_name"], "saved_at", tie=["path"])
