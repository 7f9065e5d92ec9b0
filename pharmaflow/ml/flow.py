"""The full training flow (M21): load -> check -> split -> tune -> fit -> evaluate
-> compare -> summary. Every step is a Spark job; the driver sees only
metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import basic_quality, is_valid
from ..operators.select import filter_eq
from . import evaluate as EV
from .fits import PARALLELISM, run_fits
from .models import ALGORITHMS, PARAM_SPACES, class_table, prepare_label, random_search, train
from .split import train_test_split

RESULTS = ("model_name string, task_type string, test_size long, accuracy double, f1_macro double, "
           "precision_macro double, recall_macro double, params string, status string")


def load(source, filters: Mapping | None = None, table: str | None = None) -> DataFrame:
    """The flow's input: a DataFrame, or the ``table`` of a catalog (S6); rows that meet ``filters``."""
    return filter_eq(source if isinstance(source, DataFrame) else source.table(table), filters)


def run(source, target: str, numeric: Sequence[str], categorical: Sequence[str],
        key_cols: Sequence[str], algorithms: Mapping[str, Mapping] | None = None,
        test_size: float = 0.2, seed: int = 42, primary: str = "accuracy", encoding: str = "onehot",
        table: str | None = None, filters: Mapping | None = None, tune: Mapping[str, Mapping] | None = None,
        trials: int = 10, folds: int = 3, parallelism: int = PARALLELISM) -> dict:
    """``source`` is a DataFrame or a catalog whose ``table`` is read; ``filters`` keep some of its rows.

    ``tune`` names the algorithms whose parameters are searched on the training part first (M17), each
    with its search space or None for the predefined one; the best parameters replace the
    configured ones. Models are fitted several at a time; one that fails is recorded.

    Returns {"quality": DataFrame, "valid": DataFrame, "results": DataFrame (per model metrics,
    ranked), "models": {name: model}, "best": name or None, "classes": table, "summary": DataFrame}."""
    df = load(source, filters, table)
    spark, algorithms, tune = df.sparkSession, dict(algorithms or ALGORITHMS), dict(tune or {})
    if set(tune) - set(algorithms):
        raise ValueError(f"no algorithm {sorted(set(tune) - set(algorithms))} to tune")
    cols = list(dict.fromkeys([*key_cols, *numeric, *categorical, target]))
    data = df.select(*cols).where(F.col(target).isNotNull())
    quality = basic_quality(data, target)
    split = train_test_split(data, target, key_cols, test_size, seed)
    ckpt = split.checkpoint(eager=True)  # cut lineage; reused by every model
    train_df = ckpt.where(F.col("split") == "train")
    classes = class_table(ckpt, target)  # of both parts: a part may lack one
    test_df = prepare_label(ckpt.where(F.col("split") == "test"), target, classes=classes)[0]

    def fit(name: str):
        def one():
            params = algorithms[name]
            if name in tune:
                space = PARAM_SPACES[name] if tune[name] is None else tune[name]
                _, best = random_search(train_df, target, numeric, categorical, name, space, trials, folds, key_cols, seed,
                                        encoding=encoding, parallelism=1)
                if best is None:
                    raise RuntimeError(f"no trial of {name} ran to its end")
                params = {**params, **best}
            model = train(train_df, target, numeric, categorical, name, params, seed, encoding, classes)
            return model, params, EV.classification_metrics(model.transform(test_df), "label", "prediction").first().asDict()
        return one

    rows, models = [], {}
    for name, (done, error, _) in run_fits(spark, {n: fit(n) for n in algorithms}, parallelism).items():
        if error is None:
            models[name], params, m = done
            rows.append((name, "classification", int(m["support"]), m["accuracy"], m["f1_macro"],
                         m["precision_macro"], m["recall_macro"], str(sorted(params.items(), key=str)), "ok"))
        else:
            rows.append((name, "classification", 0, None, None, None, None, None, f"failed: {error}"))
    ranked = EV.compare(spark.createDataFrame(rows, RESULTS), primary)
    best = ranked.where("is_best AND status = 'ok'").select("model_name").first()
    return {"quality": quality, "valid": is_valid(quality), "results": ranked, "models": models,
            "best": best[0] if best else None, "classes": classes,
            "summary": summary(ckpt, ranked, len(numeric) + len(categorical))}


def summary(split: DataFrame, results: DataFrame, features: int) -> DataFrame:
    """M21 totals, one row: samples of both parts, features, models tried and fitted, the best one."""
    parts = split.agg(F.count_if(F.col("split") == "train").alias("train_samples"),
                      F.count_if(F.col("split") == "test").alias("test_samples"), F.lit(features).alias("features"))
    ok = F.col("status") == "ok"
    totals = results.agg(F.count(F.lit(1)).alias("total_models"), F.count_if(ok).alias("successful_models"),
                         F.max(F.when(ok & F.col("is_best"), F.col("model_name"))).alias("best_model"),
                         F.max(F.when(ok & F.col("is_best"), F.col("accuracy"))).alias("best_accuracy"), F.lit(features).alias("features"))
    return parts.join(F.broadcast(totals), "features")  # a row on either side
