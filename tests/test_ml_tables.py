"""Classes and vocabularies as tables, prepared folds, concurrent fits, regressors and the tuned flow."""

import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaEstimator
from pyspark.sql import functions as F

from pharmaflow.ml import evaluate as EV, fits, flow, models as MD, prep as PP

ROWS = [(i, None if i % 11 == 0 else float(i % 17), None if i % 13 == 0 else f"v{i % 29}", "ab"[i % 2], (i * 7) % 3) for i in range(300)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, x double, c string, d string, y int")


def _vectors(rows, col="features"):
    return {r.id: r.v for r in rows.select("id", vector_to_array(col).alias("v")).collect()}


def test_table_encoding_equals_the_one_hot_stages(spark, df):
    train, unseen = df.where("id < 250"), df.where("id >= 250").withColumn("c", F.concat(F.lit("new"), "c"))
    enc = PP.TableEncoder.fit(train, ["x"], ["c", "d"])
    model = PP.fit_preprocessor(train, ["x"], ["c", "d"])
    for part in (train, unseen):
        got, want = _vectors(enc.transform(part)), _vectors(model.transform(part))
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)
    path = MD.scratch_path(spark, "encoder-test")
    enc.save(spark.range(0), path)
    again = PP.TableEncoder.load(spark, path)
    assert _vectors(again.transform(train)) == _vectors(enc.transform(train))


def test_columns_without_values(spark):
    df = spark.createDataFrame([(i, None, None, i % 2) for i in range(20)], "id long, x double, c string, y int")
    enc = PP.TableEncoder.fit(df, [], ["c"])
    assert enc.sizes == {"c": 0} and enc.indexed(df).columns == df.columns


def test_a_target_of_many_classes(spark):
    """10,000 classes get their numbers by a join, and a model names its classes by one."""
    df = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id") % 10_000).alias("y"), F.col("id"))
    out, classes = MD.prepare_label(df, "y")
    order = sorted({f"k{i}" for i in range(10_000)})
    got = {r.y: r.label for r in out.select("y", "label").distinct().collect()}
    assert got == {v: float(i) for i, v in enumerate(order)} and classes.count() == 10_000
    part = MD.prepare_label(df.where("y = 'k77'"), "y", classes=classes)[0].first()
    assert part.label == got["k77"]
    assert MD.prepare_label(df.limit(1).withColumn("y", F.lit("none")), "y", classes=classes)[0].first().label is None


def test_encoded_models_train_save_and_score(spark, df):
    model = MD.train(df, "y", ["x"], ["c", "d"], "logistic_regression", encoding="table")
    root = MD.scratch_path(spark, "encoded-models")
    path = MD.save_model(spark, model, root, "lr", "logistic_regression", ["x", "c", "d"])
    loaded = MD.EncodedModel.load(spark, path)
    classes = MD.class_table(df, "y")
    a, b = (MD.score(m, df, "lr", classes) for m in (model, loaded))
    key = lambda rows: sorted((r.id, r.predicted, tuple(r.probabilities)) for r in rows.collect())
    assert key(a) == key(b) and MD.score_check(a).first().bad_sum == 0
    assert {r.predicted for r in a.collect()} <= {"0", "1", "2"}


def test_fits_run_together_and_fail_alone(spark):
    both = threading.Barrier(2, timeout=60)  # passes only if two fits are under way at once

    def fine():
        both.wait()
        return spark.range(1000).count()

    def broken():
        both.wait()
        raise ValueError("no model")

    out = fits.run_fits(spark, {"fine": fine, "broken": broken, "late": lambda: 7}, parallelism=2)
    assert list(out) == ["fine", "broken", "late"]
    assert out["fine"][0] == 1000 and isinstance(out["broken"][1], ValueError) and out["late"][0] == 7
    assert spark.range(10).count() == 10  # the failure cancelled only its own jobs


def test_folds_are_prepared_once(spark, df):
    folds = MD.prepared_folds(df, "y", ["x"], ["c"], ["id"], folds=3)
    parts = [folds.part(f) for f in range(3)]
    assert all(p.count() == 300 for p in parts) and sum(p.where("_test").count() for p in parts) == 300
    for f, p in enumerate(parts):
        n = {r.label: r.n for r in p.where("NOT _test").groupBy("label").agg(F.count("*").alias("n")).collect()}
        got = {r.label: r.weight for r in p.select("label", "weight").distinct().collect()}
        assert got == pytest.approx({k: sum(n.values()) / (len(n) * v) for k, v in n.items()}) and folds.rows[f] == sum(n.values())


def test_search_records_failed_trials(spark, df):
    space = {"C": ("choice", [1.0, -1.0, "x"])}
    hist, best = MD.random_search(df, "y", ["x"], [], "logistic_regression", space, n_trials=6, folds=2, key_cols=["id"], seed=1)
    rows = hist.collect()
    tried = [t["C"] for t in MD.sample_space(space, 6, 1)]
    assert [r.state for r in rows] == ["COMPLETE" if c == 1.0 else "FAIL" for c in tried]
    assert best == ({"C": 1.0} if 1.0 in tried else None)
    with pytest.raises(ValueError):
        MD.random_search(df, "y", ["x"], [], "logistic_regression", space, metric="mse")


def test_predefined_spaces_are_within_what_algorithms_take():
    for name, space in MD.PARAM_SPACES.items():
        assert set(space) <= MD.KNOWN[name]
        for trial in MD.sample_space(space, 20):
            MD.estimator(name, 10, 2, trial)


def test_ridge_penalty(spark):
    """The penalised least squares solution, with an intercept that is not penalised."""
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=50)
    y = 3 * x + 2 + rnd.normal(size=50) * 0.1
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = MD.train(df, "y", ["x"], [], "linear_regression", {"alpha": 5.0}).stages[-1]
    z = (x - x.mean()) / x.std()
    assert model.coefficients[0] == pytest.approx((z @ (y - y.mean())) / (z @ z + 5.0), abs=1e-6)


def test_multiclass_auc_by_pairs(spark):
    rnd = np.random.default_rng(2)
    rows = [(int(rnd.integers(0, 3)), [float(rnd.integers(0, 5)) for _ in range(3)]) for _ in range(60)] + [(None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "label int, probabilities array<double>")
    got = {r["class"]: r.roc_auc for r in EV.auc_per_class(df).collect()}
    for k in range(3):
        own, other = [p[k] for y, p in rows if y == k], [p[k] for y, p in rows if y not in (k, None)]
        assert got[k] == pytest.approx(np.mean([(a > b) + (a == b) / 2 for a in own for b in other]))
    assert EV.roc_auc_ovr(df).first()[0] == pytest.approx(np.mean(list(got.values())))


def test_flow_tunes_filters_and_counts(spark, df):
    out = flow.run(df, "y", ["x"], ["d"], ["id"], {"random_forest": {"n_estimators": 3}, "nothing": {}}, filters={"d": "a"},
                   tune={"random_forest": {"max_depth": ("int", 2, 3)}}, trials=2, folds=2)
    total = out["summary"].first()
    n = df.where("d = 'a'").count()
    assert total.train_samples + total.test_samples == n and (total.total_models, total.successful_models) == (2, 1)
    assert out["best"] == total.best_model == "random_forest" and "max_depth" in out["results"].where("is_best").first().params
    assert out["results"].where("model_name = 'nothing'").first().status.startswith("failed: ")
    with pytest.raises(ValueError):
        flow.run(df, "y", ["x"], [], ["id"], {"random_forest": {}}, tune={"other": None})


def test_fits_prepare_once_and_boost_in_few_tasks(spark, df, monkeypatch):
    """All classifiers share one preparation; boosting and the linear solver get the partitions that the rows
    fill, a forest those of the data."""
    prepared, parts = [], {}
    whole, fit = MD._labelled, JavaEstimator._fit
    monkeypatch.setattr(MD, "_labelled", lambda *a: prepared.append(a[2]) or whole(*a))

    def seen(self, data):
        parts[type(self).__name__] = data.rdd.getNumPartitions()
        return fit(self, data)

    monkeypatch.setattr(JavaEstimator, "_fit", seen)
    algorithms = {"logistic_regression": {}, "random_forest": {"n_estimators": 3}, "gradient_boosting": {"n_estimators": 2}, "broken": {}}
    data = df.withColumn("y", F.col("y") % 2).repartition(7)
    models, log = MD.train_all(data, "y", ["x"], ["d"], algorithms)
    assert len(prepared) == 1 and set(models) == set(algorithms) - {"broken"}
    assert [s for _n, s, _e, _t in log] == ["ok", "ok", "ok", "failed"]
    assert parts["LogisticRegression"] == parts["GBTClassifier"] == 1 <= parts["RandomForestClassifier"]


def test_a_preparation_that_fails_fails_each_fit(df):
    models, log = MD.train_all(df, "y", ["no_such_column"], ["d"], {"logistic_regression": {}, "gradient_boosting": {}})
    assert not models and [s for _n, s, _e, _t in log] == ["failed", "failed"]


def test_forests_get_even_partitions_and_keep_nodes(spark, monkeypatch):
    """A class that holds nearly all rows does not put them in one partition, whatever files they come from;
    and a row does not go down all trees again for each level."""
    slots, seen, fit = spark.sparkContext.defaultParallelism, {}, JavaEstimator._fit

    def watched(self, data):
        if type(self).__name__.startswith("RandomForest"):
            parts = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
            seen[type(self).__name__] = max(parts), sum(parts), self.getCacheNodeIds()
        return fit(self, data)

    monkeypatch.setattr(JavaEstimator, "_fit", watched)
    data = spark.range(4000).select("id", (F.col("id") % 37).alias("x"), (F.col("id") % 50 > 0).cast("int").alias("y")).coalesce(1)
    models, _log = MD.train_all(data, "y", ["x"], [], {"random_forest": {"n_estimators": 2, "max_depth": 2},
                                                       "random_forest_regressor": {"n_estimators": 2, "max_depth": 2}})
    assert len(models) == len(seen) == 2
    for largest, rows, kept in seen.values():
        assert rows == 4000 and largest <= 4000 // slots + 50 and kept


def test_kept_nodes_grow_the_same_trees(spark, df):
    rows = MD._prepared(df, "y", ["x"], ["c", "d"], "random_forest")[0]
    est = MD.estimator("random_forest", 300, 3, {"n_estimators": 10})
    a, b = (est.copy({est.cacheNodeIds: kept}).fit(rows).toDebugString.split("\n", 1)[1] for kept in (True, False))
    assert a == b


def test_weights_of_few_classes_are_broadcast(spark, df):
    from pharmaflow.ml.split import class_weights
    few, many = class_weights(df, "y", few=True), class_weights(df, "y")
    key = lambda rows: sorted(rows.select("id", "weight").collect())
    assert key(few) == key(many)
    assert "strategy=broadcast" in few._jdf.queryExecution().optimizedPlan().toString()
