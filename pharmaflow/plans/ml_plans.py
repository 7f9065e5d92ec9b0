"""ML queries (M1-M21) on documents and labels.

Task: predict ``labels.quality`` from the document's length, language and
source. Split, folds and every metric are exact and carry a DuckDB oracle. Fits are held
against values that SQL computes from the data: the gradient of the logistic loss at
the fitted coefficients, least squares per fold, and trees on a target that is a threshold of
one feature, which fixes every prediction. Each query fits for itself.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from ..ml import evaluate as EV, models as MD, prep as PP, split as SP
from ..ml.flow import run as run_flow
from ..ml.runs import RunLog, best_version, latest_run
from ..sources.tables import Catalog
from .registry import fresh_dir, r6, register, t

NUMERIC = ["n_chars"]
CATEGORICAL = ["lang", "source"]
TARGET = "quality"

def labeled(spark, sf):
    """labels joined to their documents' features (every label has its document)."""
    d = t(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return t(spark, sf, "labels").join(d, "doc_id")


def all_docs(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")


LIMIT = 2000  # characters
FEATURES = (["x"], CATEGORICAL)


def threshold_docs(spark, sf):
    """Documents whose class is whether they have LIMIT characters. ``x`` counts them by the thousand, up
    to 20, so that trees try every cut of it and the class is a threshold of ``x``."""
    d = all_docs(spark, sf)
    return d.withColumns({"x": F.least(F.floor(F.col("n_chars") / 1000), F.lit(20)), "y": (F.col("n_chars") >= LIMIT).cast("int")})


_THRESHOLD = f"""
SELECT doc_id, CASE WHEN n_chars >= {LIMIT} THEN '1' ELSE '0' END AS predicted FROM documents"""


# ------------------------------------------------------------------ M1, M9
@register("m1_stratified_split", """
WITH r AS (SELECT doc_id, quality,
                  row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rk,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rk < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""")
def m1_stratified_split(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", "quality")
    return SP.train_test_split(lab, "quality", ["doc_id"], 0.2, 42).select("doc_id", "quality", "split")


@register("m9_stratified_folds", """
SELECT doc_id, quality,
       CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5
            AS INTEGER) AS fold
FROM labels""")
def m9_stratified_folds(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", "quality")
    return SP.fold_ids(lab, "quality", ["doc_id"], 5, 42).select("doc_id", "quality", "fold")


@register("m9_plain_folds", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST((row_number() OVER (ORDER BY md5('7|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)
                                              || '|' || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)),
                                l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) % 5 AS INTEGER) AS fold
FROM lineitem""")
def m9_plain_folds(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = t(spark, sf, "lineitem").select(*keys)
    return SP.fold_ids(li, None, keys, 5, seed=7).select(*keys, "fold")


# ------------------------------------------------------------------ M10-M15
_CONF = """
WITH c AS (SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT label AS k FROM c UNION SELECT prediction FROM c),
pc AS (SELECT k,
              coalesce((SELECT sum(n) FROM c WHERE label = k AND prediction = k), 0) AS tp,
              coalesce((SELECT sum(n) FROM c WHERE label = k), 0) AS support,
              coalesce((SELECT sum(n) FROM c WHERE prediction = k), 0) AS predicted FROM cls),
m AS (SELECT k, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM m)"""


@register("m10_classification_metrics", _CONF + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(p), 6) AS precision_macro,
       round(avg(r), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
       round(sum(p * support) / sum(support), 6) AS precision_weighted,
       round(sum(r * support) / sum(support), 6) AS recall_weighted,
       round(sum(f1 * support) / sum(support), 6) AS f1_weighted, CAST(sum(support) AS BIGINT) AS support FROM f""")
def m10_classification_metrics(spark, sf):
    m = EV.classification_metrics(t(spark, sf, "labels"), "quality", "toxic")
    return m.select(*[r6(c).alias(c) for c in m.columns if c != "support"], "support")


@register("m12_per_class_report", _CONF + """
SELECT k AS class, round(p, 6) AS precision, round(r, 6) AS recall, CAST(support AS BIGINT) AS support,
       CAST(tp AS BIGINT) AS tp, round(f1, 6) AS f1 FROM f""")
def m12_per_class_report(spark, sf):
    pc = EV.per_class(t(spark, sf, "labels"), "quality", "toxic")
    return pc.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                     "support", "tp", r6("f1").alias("f1"))


@register("m12_confusion_matrix", """
SELECT quality AS label, count(*) FILTER (WHERE toxic = 0) AS "0", count(*) FILTER (WHERE toxic = 1) AS "1"
FROM labels GROUP BY quality""")
def m12_confusion_matrix(spark, sf):
    return EV.confusion_matrix(t(spark, sf, "labels"), "quality", "toxic", labels=[0, 1])


@register("m11_roc_auc", """
WITH s AS (SELECT d.n_chars AS score, count(*) FILTER (WHERE l.quality = 1) AS pos,
                  count(*) FILTER (WHERE l.quality = 0) AS neg
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM s)
SELECT CAST(round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS DOUBLE) AS roc_auc FROM c""")
def m11_roc_auc(spark, sf):
    return EV.auc_table(labeled(spark, sf), "quality", "n_chars").select(r6("roc_auc").alias("roc_auc"))


@register("m13_regression_metrics", """
WITH e AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity * 1.5 AS p FROM lineitem)
SELECT round(avg((y - p) * (y - p)), 6) AS mse, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(avg(abs(y - p)), 6) AS mae,
       round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(y) FROM e)) * (y - (SELECT avg(y) FROM e))), 6) AS r2,
       round(avg(abs((y - p) / y)) * 100, 6) AS mape FROM e""")
def m13_regression_metrics(spark, sf):
    li = t(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y"),
                                          (F.col("l_quantity") * 1.5).alias("p"))
    m = EV.regression_metrics(li, "y", "p")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("m14_residuals", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice - l_quantity * 1500.0, 6) AS residual
FROM lineitem""")
def m14_residuals(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_extendedprice", (F.col("l_quantity") * 1500.0).alias("p"))
    r = EV.residuals(li, "l_extendedprice", "p")
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6("residual").alias("residual"))


@register("m15_compare_models", """
WITH a AS (SELECT d.lang AS model_name, avg(CASE WHEN l.quality = l.toxic THEN 1.0 ELSE 0.0 END) AS accuracy
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1)
SELECT model_name, round(accuracy, 6) AS accuracy,
       row_number() OVER (ORDER BY accuracy DESC, model_name) AS rank,
       row_number() OVER (ORDER BY accuracy DESC, model_name) = 1 AS is_best FROM a""")
def m15_compare_models(spark, sf):
    """Each language's 'toxic as a quality predictor' accuracy, compared."""
    res = (labeled(spark, sf).groupBy(F.col("lang").alias("model_name"))
           .agg(F.avg((F.col("quality") == F.col("toxic")).cast("double")).alias("accuracy")))
    return EV.compare(res, "accuracy").withColumn("accuracy", r6("accuracy"))


# ------------------------------------------------------------------ M2-M4
@register("m2_numeric_prep", """
WITH x AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS s,
                  p_retailprice AS pr FROM part),
med AS (SELECT quantile_cont(s, 0.5) AS ms, quantile_cont(pr, 0.5) AS mp FROM x),
i AS (SELECT p_partkey, coalesce(s, ms) AS s, coalesce(pr, mp) AS pr FROM x, med),
st AS (SELECT avg(s) AS a1, stddev_pop(s) AS d1, avg(pr) AS a2, stddev_pop(pr) AS d2 FROM i)
SELECT p_partkey, round((s - a1) / d1, 6) AS num__p_size, round((pr - a2) / d2, 6) AS num__p_retailprice
FROM i, st""")
def m2_numeric_prep(spark, sf):
    p = t(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_type") == "ECONOMY", F.lit(None)).otherwise(F.col("p_size")).alias("p_size"),
        "p_retailprice")
    stages = PP.preprocessor_stages(p, ["p_size", "p_retailprice"], [])
    out = stages[0].transform(p)
    return out.select("p_partkey", r6("num__p_size").alias("num__p_size"),
                      r6("num__p_retailprice").alias("num__p_retailprice"))


@register("m3_one_hot_counts", """
WITH x AS (SELECT CASE WHEN c_nationkey = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
mode AS (SELECT seg FROM x WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1),
i AS (SELECT coalesce(x.seg, (SELECT seg FROM mode)) AS seg FROM x),
c AS (SELECT seg, count(*) AS n FROM i GROUP BY seg)
SELECT CAST(row_number() OVER (ORDER BY seg) - 1 AS INTEGER) AS slot, seg AS category, n AS count FROM c""")
def m3_one_hot_counts(spark, sf):
    c = t(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    return _slot_counts(c, "seg")


def _slot_counts(df, col):
    """Rows per slot of a table-encoded column, with the slot's category."""
    enc = PP.TableEncoder.fit(df, [], [col])
    counts = enc.indexed(df).groupBy(F.col(f"idx__{col}").cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("count"))
    names = enc.vocabulary(df, col).select(F.col("slot").cast("int").alias("slot"), F.col("value").alias("category"))
    return counts.join(names, "slot").select("slot", "category", "count")


@register("m3_large_vocabulary", """
WITH c AS (SELECT 'order ' || CAST(l_orderkey AS VARCHAR) AS category, count(*) AS count FROM lineitem GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS slot, category, count FROM c""")
def m3_large_vocabulary(spark, sf):
    """A category per order: its vocabulary stays a table."""
    li = t(spark, sf, "lineitem").select(F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("category"))
    return _slot_counts(li, "category")


@register("m4_label_numbers", """
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS label FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders))
SELECT o_orderkey, o_custkey, CAST(label AS DOUBLE) AS label FROM orders JOIN c ON c_custkey = o_custkey""")
def m4_label_numbers(spark, sf):
    """A target with a class per customer, numbered by a join."""
    return MD.prepare_label(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")[0]


@register("m4_table_encoding", """
SELECT l.doc_id, 1 + count(DISTINCT lang) OVER () + count(DISTINCT source) OVER () AS vector_size,
       d.lang, d.source FROM labels l JOIN documents d ON d.doc_id = l.doc_id""")
def m4_table_encoding(spark, sf):
    """Vectors from vocabularies in tables: the slots that are set lead back to the values."""
    data = labeled(spark, sf)
    enc = PP.TableEncoder.fit(data, NUMERIC, CATEGORICAL)
    out = enc.transform(data).select("doc_id", vector_to_array("features").alias("v"))
    n = enc.sizes["lang"]

    def value(col, first):
        """The value whose slot of the vector is 1."""
        names = enc.vocabulary(data, col).agg(F.array_sort(F.collect_list(F.struct("slot", "value"))).alias(f"{col}s"), F.lit(1).alias("k"))
        part = F.slice("v", first, enc.sizes[col])
        return names, F.element_at(f"{col}s", F.array_position(part, F.lit(1.0)).cast("int"))["value"].alias(col)

    (langs, lang), (sources, source) = value("lang", 2), value("source", 2 + n)  # few, as in the model itself
    out = out.withColumn("k", F.lit(1)).join(F.broadcast(langs), "k").join(F.broadcast(sources), "k")
    return out.select("doc_id", F.size("v").cast("long").alias("vector_size"), lang, source)


@register("m4_preprocessor_shape", """
SELECT count(*) AS rows, 1 + count(DISTINCT lang) + count(DISTINCT source) AS vector_size
FROM labels l JOIN documents d ON d.doc_id = l.doc_id""")
def m4_preprocessor_shape(spark, sf):
    data = labeled(spark, sf)
    model = PP.fit_preprocessor(data, NUMERIC, CATEGORICAL)
    out = model.transform(data)
    return out.agg(F.count(F.lit(1)).alias("rows"),
                   F.max(F.size(vector_to_array("features"))).cast("long").alias("vector_size"))


# ------------------------------------------------------------------ M11 multi-class
@register("m11_multiclass_auc", """
WITH x AS (SELECT l.quality + l.toxic AS y, d.n_chars % 97 AS s0, d.n_chars % 31 AS s1, d.n_chars % 53 AS s2
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
u AS (SELECT 0 AS class, y = 0 AS own, s0 AS s FROM x UNION ALL SELECT 1, y = 1, s1 FROM x UNION ALL SELECT 2, y = 2, s2 FROM x),
h AS (SELECT class, s, count(*) FILTER (own) AS own, count(*) FILTER (NOT own) AS other FROM u GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(other) OVER (PARTITION BY class ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT class, CASE WHEN sum(own) * sum(other) > 0 THEN round(sum(own * (below + other / 2)) / (sum(own) * sum(other)), 6) END AS roc_auc
FROM r GROUP BY class""")
def m11_multiclass_auc(spark, sf):
    """Each class against the rest, all from one score histogram."""
    d = labeled(spark, sf).select((F.col("quality") + F.col("toxic")).alias("y"),
                                  F.array(*[(F.col("n_chars") % m).cast("double") for m in (97, 31, 53)]).alias("p"))
    return EV.auc_per_class(d, "y", "p").select("class", r6("roc_auc").alias("roc_auc"))


# ------------------------------------------------------------------ M5-M8, M16-M19
_WEIGHTED = """
WITH d AS (SELECT l.doc_id, l.quality AS y, d.n_chars, d.lang, d.source FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
w AS (SELECT quality AS y, (SELECT count(*) FROM d) / (count(*) * count(*) OVER ()) AS w FROM labels GROUP BY quality),
x AS (SELECT d.*, w, (n_chars - (SELECT avg(n_chars) FROM d)) / (SELECT stddev_pop(n_chars) FROM d) AS z FROM d JOIN w USING (y))"""


@register("m5_logistic_regression", _WEIGHTED + """
SELECT 'all' AS feature, round(sum(w * y), 3) AS weighted FROM x
UNION ALL SELECT 'num__n_chars', round(sum(w * y * z), 3) FROM x
UNION ALL SELECT 'lang ' || lang, round(sum(w * y), 3) FROM x GROUP BY lang
UNION ALL SELECT 'source ' || source, round(sum(w * y), 3) FROM x GROUP BY source""")
def m5_logistic_regression(spark, sf):
    """Where the weighted, penalised loss is least its gradient is 0: for every feature the weighted sum
    of the predicted probabilities, plus the coefficient's penalty, is that of the labels."""
    data = labeled(spark, sf)
    model = MD.train(data, TARGET, NUMERIC, CATEGORICAL, "logistic_regression", {"tol": 1e-12, "max_iter": 2000})
    rows = SP.class_weights(model.transform(data), TARGET).withColumn("wp", F.col("weight") * vector_to_array("probability")[1])
    est, names = model.stages[-1], MD.feature_names(model, data)
    coef = dict(zip(names, est.coefficients.toArray().tolist()))

    def by(col):
        sums = rows.groupBy(F.col(col).alias("v")).agg(F.sum("wp").alias("s"))
        own = spark.createDataFrame([(n.split(f"ohe__{col}_", 1)[1], c) for n, c in coef.items() if n.startswith(f"ohe__{col}_")], "v string, c double")
        return sums.join(F.broadcast(own), "v").select(F.concat(F.lit(f"{col} "), "v").alias("feature"), (F.col("s") + F.col("c")).alias("weighted"))

    all_ = rows.agg(F.sum("wp").alias("s"), F.sum(F.col("wp") * F.col("num__n_chars")).alias("z"))
    pair = all_.select(F.explode(F.array(
        F.struct(F.lit("all").alias("feature"), F.col("s").alias("weighted")),
        F.struct(F.lit("num__n_chars").alias("feature"), (F.col("z") + F.lit(coef["num__n_chars"])).alias("weighted")))).alias("r")).select("r.*")
    out = pair.unionByName(by("lang")).unionByName(by("source"))
    return out.withColumn("weighted", F.round("weighted", 3))


def _threshold_scores(spark, sf, algorithm, params, encoding="onehot"):
    data = threshold_docs(spark, sf)
    model = MD.train(data, "y", *FEATURES, algorithm, params, encoding=encoding)
    return MD.score(model, data, algorithm, classes=[0, 1]).select("doc_id", "predicted")


@register("m6_random_forest", _THRESHOLD)
def m6_random_forest(spark, sf):
    return _threshold_scores(spark, sf, "random_forest", {"n_estimators": 60})


@register("m7_gradient_boosting", _THRESHOLD)
def m7_gradient_boosting(spark, sf):
    """Through vocabularies that stay tables."""
    return _threshold_scores(spark, sf, "gradient_boosting", {"n_estimators": 20}, "table")


@register("m7_gradient_boosting_multiclass", """
SELECT doc_id, CASE WHEN n_chars >= 4000 THEN '2' WHEN n_chars >= 1000 THEN '1' ELSE '0' END AS predicted FROM documents""")
def m7_gradient_boosting_multiclass(spark, sf):
    """M7 with three classes (OneVsRest of binary GBTs), two thresholds of one feature."""
    n = F.col("n_chars")
    data = threshold_docs(spark, sf).withColumn("y", (n >= 1000).cast("int") + (n >= 4000).cast("int"))
    model = MD.train(data, "y", *FEATURES, "gradient_boosting", {"n_estimators": 10})
    return MD.score(model, data, "gbt_ovr", classes=[0, 1, 2]).select("doc_id", "predicted")


@register("m18_batch_score_check", _THRESHOLD)
def m18_batch_score_check(spark, sf):
    """M18 through the saved-and-reloaded model."""
    data = threshold_docs(spark, sf)
    model = MD.train(data, "y", *FEATURES, "random_forest", {"n_estimators": 40})
    path = MD.save_model(spark, model, fresh_dir(spark, "models"), "threshold_rf", "random_forest", ["x", *CATEGORICAL])
    return MD.score(MD.load_model(path), data, "threshold_rf", classes=[0, 1]).select("doc_id", "predicted")


@register("m18_score_invariants", """
SELECT count(*) AS rows, 0 AS bad_sum, 0 AS bad_confidence FROM documents""")
def m18_score_invariants(spark, sf):
    """Probabilities sum to 1 and the confidence is the greatest of them, in every row."""
    model = MD.train(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, "logistic_regression")
    return MD.score_check(MD.score(model, all_docs(spark, sf), "lr", classes=[0, 1]))


@register("m16_feature_importance", """
SELECT 'num__x' AS top_feature, 1 + count(DISTINCT lang) + count(DISTINCT source) AS features,
       CAST(1.0 AS DOUBLE) AS importance_sum FROM documents""")
def m16_feature_importance(spark, sf):
    """The feature that decides the class leads."""
    data = threshold_docs(spark, sf)
    model = MD.train(data, "y", *FEATURES, "random_forest", {"n_estimators": 60})
    imp = MD.feature_importance(model, data)
    return imp.agg(F.max_by("feature", "importance").alias("top_feature"), F.count(F.lit(1)).alias("features"),
                   F.round(F.sum("importance"), 6).alias("importance_sum"))


@register("m9_cross_validate")
def m9_cross_validate(spark, sf):
    """M9 scores (rows): 5-fold stratified CV of logistic regression; mean and
    population std of accuracy, macro precision/recall/F1 and ROC AUC."""
    return MD.cross_validate(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, "logistic_regression", ["doc_id"], folds=5)


_FOLD = """CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(l.doc_id AS VARCHAR)), l.doc_id) - 1) % 5 AS INTEGER)"""


@register("m9_cv_auc", f"""
WITH d AS (SELECT l.quality AS y, d.n_chars AS x, {_FOLD} AS fold FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
f AS (SELECT unnest(range(5))::INTEGER AS fold),
g AS (SELECT f.fold, sign(avg(x) FILTER (y = 1) - avg(x) FILTER (y = 0)) AS way FROM f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
h AS (SELECT d.fold, x * way AS s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM d JOIN g ON g.fold = d.fold GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h),
a AS (SELECT fold, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY fold)
SELECT 'roc_auc' AS score, round(avg(auc), 6) AS mean, round(stddev_pop(auc), 6) AS std, count(*) AS folds FROM a""")
def m9_cv_auc(spark, sf):
    """A logistic model of one feature ranks by that feature, in the direction of the class means."""
    cv = MD.cross_validate(labeled(spark, sf), TARGET, NUMERIC, [], "logistic_regression", ["doc_id"], folds=5, scores=["roc_auc"])
    return cv.select("score", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


@register("m9_cv_invariants", """
SELECT unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc']) AS score, CAST(1 AS DOUBLE) AS mean,
       CAST(0 AS DOUBLE) AS std, CAST(5 AS BIGINT) AS folds FROM (SELECT count(*) AS n FROM documents) WHERE n > 0""")
def m9_cv_invariants(spark, sf):
    """Trees that learn a threshold make no mistake on any fold."""
    cv = MD.cross_validate(threshold_docs(spark, sf), "y", *FEATURES, "gradient_boosting", ["doc_id"], folds=5, params={"n_estimators": 3})
    return cv.select("score", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


def _prices(spark, sf):
    """A number to predict, with a key of its own for each row."""
    return t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("x"), (F.col("o_totalprice") / 1000).alias("y"))


_LEAST_SQUARES = """
WITH d AS (SELECT o_custkey AS x, o_totalprice / 1000 AS y,
                  CAST((row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % {k} AS INTEGER) AS fold
           FROM orders),
f AS (SELECT unnest(range({k}))::INTEGER AS fold),
g AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
e AS (SELECT d.fold, y, y - a - b * x AS e FROM d JOIN g ON g.fold = d.fold),
s AS (SELECT fold, avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - sum(e * e) / (count(*) * var_pop(y)) AS r2 FROM e GROUP BY fold)"""


@register("m9_cv_regression", _LEAST_SQUARES.format(k=5) + """
SELECT 'mse' AS score, round(avg(mse), 5) AS mean, round(stddev_pop(mse), 5) AS std, count(*) AS folds FROM s
UNION ALL SELECT 'mae', round(avg(mae), 5), round(stddev_pop(mae), 5), count(*) FROM s
UNION ALL SELECT 'r2', round(avg(r2), 5), round(stddev_pop(r2), 5), count(*) FROM s""")
def m9_cv_regression(spark, sf):
    """Plain folds, least squares on the others, three scores."""
    cv = MD.cross_validate(_prices(spark, sf), "y", ["x"], [], "linear_regression", ["o_orderkey"], folds=5)
    return cv.select("score", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "folds")


@register("m17_regression_search", _LEAST_SQUARES.format(k=3) + """
SELECT trial, round(-avg(mse), 5) AS value, round(stddev_pop(mse), 5) AS std, 'COMPLETE' AS state
FROM s, (SELECT unnest(range(2))::INTEGER AS trial) GROUP BY trial""")
def m17_regression_search(spark, sf):
    """A search by the negative mean squared error; without a penalty the rounds of the solver do not matter."""
    space = {"alpha": ("fixed", 0.0), "max_iter": ("int", 50, 100)}
    hist, _best = MD.random_search(_prices(spark, sf), "y", ["x"], [], "linear_regression", space, n_trials=2, folds=3, key_cols=["o_orderkey"])
    return hist.select("trial", F.round("value", 5).alias("value"), F.round("std", 5).alias("std"), "state")


@register("m9_tree_regression", """
SELECT unnest(['mse', 'mae', 'r2']) AS score, unnest([0.0, 0.0, 1.0])::DOUBLE AS mean, CAST(0 AS DOUBLE) AS std,
       CAST(3 AS BIGINT) AS folds FROM (SELECT count(*) AS n FROM documents) WHERE n > 0""")
def m9_tree_regression(spark, sf):
    """Trees on a target with one step."""
    cv = MD.cross_validate(threshold_docs(spark, sf), "y", ["x"], [], "random_forest_regressor", ["doc_id"], folds=3, params={"n_estimators": 5})
    return cv.select("score", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


@register("m8_train_all", """
SELECT * FROM (VALUES ('logistic_regression', 'ok'), ('random_forest', 'ok'),
                      ('gradient_boosting', 'ok'), ('not_an_algorithm', 'failed'))
  AS t(model_name, status)""")
def m8_train_all(spark, sf):
    """M8 (rows): every configured algorithm plus one that fails; the failure
    is recorded and the others still train."""
    algos = dict(MD.ALGORITHMS) | {"not_an_algorithm": {}}
    _models, log = MD.train_all(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, algos)
    return spark.createDataFrame([(n, s) for n, s, _e, _t in log], "model_name string, status string")


@register("m8_trained_models", f"""
SELECT model_name, count(*) AS rows, count(*) AS right_class FROM documents, (SELECT unnest(['random_forest', 'gradient_boosting']) AS model_name)
WHERE n_chars >= 0 GROUP BY model_name""")
def m8_trained_models(spark, sf):
    """M8: the models that ``train_all`` returns, fitted at the same time, each score every document."""
    data = threshold_docs(spark, sf)
    models, _log = MD.train_all(data, "y", *FEATURES, {"random_forest": {"n_estimators": 40}, "gradient_boosting": {"n_estimators": 3}, "broken": {}})
    parts = [MD.score(m, data, name, classes=[0, 1]).select("model_name", (F.col("predicted") == F.col("y").cast("string")).alias("ok"))
             for name, m in models.items()]
    return parts[0].unionByName(parts[1]).groupBy("model_name").agg(F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("right_class"))


@register("m17_random_search")
def m17_random_search(spark, sf):
    """M17 (rows): 4 seeded trials of logistic regression, 3 folds."""
    space = {"C": ("log", 0.01, 10.0), "max_iter": ("int", 50, 200), "class_weight": ("choice", ["balanced", None])}
    hist, best = MD.random_search(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, "logistic_regression", space,
                                  n_trials=4, folds=3, key_cols=["doc_id"], seed=42)
    return hist.withColumn("best_params", F.lit(json.dumps(best, sort_keys=True)))


@register("m17_search_invariants", """
SELECT unnest(range(3))::INTEGER AS trial, CAST(1 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS std, 'COMPLETE' AS state
FROM (SELECT count(*) AS n FROM documents) WHERE n > 0""")
def m17_search_invariants(spark, sf):
    """Whatever a trial's parameters, its trees find the threshold."""
    space = MD.PARAM_SPACES["gradient_boosting"] | {"n_estimators": ("int", 2, 4), "min_samples_leaf": ("int", 1, 3)}
    hist, _best = MD.random_search(threshold_docs(spark, sf), "y", ["x"], [], "gradient_boosting", space, n_trials=3, folds=2, key_cols=["doc_id"])
    return hist.select("trial", r6("value").alias("value"), r6("std").alias("std"), "state")


@register("m19_model_index", """
SELECT * FROM (VALUES
  ('quality_logistic_regression', 'logistic_regression', '["n_chars", "lang", "source"]'),
  ('quality_random_forest', 'random_forest', '["n_chars", "lang", "source"]'))
  AS t(model_name, algorithm, features)""")
def m19_model_index(spark, sf):
    """M19 (rows): save two models, list the index (latest row per name)."""
    root = fresh_dir(spark, "models")
    for algo, params in (("logistic_regression", None), ("random_forest", {"n_estimators": 20})):
        model = MD.train(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, algo, params)
        MD.save_model(spark, model, root, f"quality_{algo}", algo, NUMERIC + CATEGORICAL)
    return MD.list_models(spark, root).select("model_name", "algorithm", "features")


SMALL_MODELS = {"logistic_regression": {"max_iter": 50}, "random_forest": {"n_estimators": 20}, "gradient_boosting": {"n_estimators": 10}}


@register("m20_run_log")
def m20_run_log(spark, sf):
    """M20 + W5 (rows): log one run per model with its test metrics,
    register versions, then the latest run and the best version."""
    res = run_flow(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, ["doc_id"], SMALL_MODELS)
    log = RunLog(spark, fresh_dir(spark, "runs"))
    for r in res["results"].collect():  # one metrics row per model
        rid = log.log_run("quality", {"algorithm": r["model_name"]},
                          {"accuracy": r["accuracy"] or 0.0, "f1_macro": r["f1_macro"] or 0.0})
        log.register_version("quality_model", rid)
    runs = log.runs()
    best = best_version(log.versions(), runs, "accuracy")
    latest = latest_run(runs).select("experiment", F.col("run_id").alias("latest_run_id"))
    # best version -> its run's experiment -> that experiment's latest run (key joins)
    return (best.join(runs.select("run_id", "experiment"), "run_id")
                .join(latest, "experiment")
                .select("name", "version", "accuracy", "experiment",
                        (F.col("run_id") == F.col("latest_run_id")).alias("best_is_latest")))


_TEST_ROWS = f"""
WITH d AS (SELECT n_chars >= {LIMIT} AS y FROM documents WHERE lang IN ('en', 'de', 'fr')),
n AS (SELECT CAST(sum(ceil(c * 0.2)) AS BIGINT) AS test, CAST(sum(c) AS BIGINT) AS n FROM (SELECT count(*) AS c FROM d GROUP BY y))"""


def _tuned_flow(spark, sf):
    """The flow over a filtered table of a catalog, one model tuned, one that fails."""
    path = fresh_dir(spark, "training")
    threshold_docs(spark, sf).write.parquet(path)
    algos = {"gradient_boosting": {"n_estimators": 3}, "random_forest": {"max_depth": 4}, "broken": {}}
    return run_flow(Catalog(spark, {"training": path}), "y", ["x"], ["lang"], ["doc_id"], algos, table="training",
                    filters={"lang": ["en", "de", "fr"]}, tune={"random_forest": {"n_estimators": ("int", 3, 5)}}, trials=2, folds=2)


@register("m21_flow_invariants", _TEST_ROWS + """
SELECT n - test AS train_samples, test AS test_samples, 2 AS features, 3 AS total_models, 2 AS successful_models,
       'gradient_boosting' AS best_model, CAST(1 AS DOUBLE) AS best_accuracy FROM n""")
def m21_flow_invariants(spark, sf):
    """M21 totals: a filtered table as input, a tuned model, a failing one."""
    return _tuned_flow(spark, sf)["summary"].select("train_samples", "test_samples", "features", "total_models",
                                                    "successful_models", "best_model", "best_accuracy")


@register("m21_tuned_results", _TEST_ROWS + """
SELECT model_name, status, acc AS accuracy, CASE WHEN status = 'ok' THEN test ELSE 0 END AS test_size, rank, rank = 1 AS is_best
FROM n, (VALUES ('gradient_boosting', 'ok', CAST(1 AS DOUBLE), 1), ('random_forest', 'ok', CAST(1 AS DOUBLE), 2),
                ('broken', 'failed', NULL, 3)) AS m(model_name, status, acc, rank)""")
def m21_tuned_results(spark, sf):
    """M21 per model: metrics on the test part, ranked."""
    res = _tuned_flow(spark, sf)["results"]
    return res.select("model_name", F.substring_index("status", ":", 1).alias("status"), "accuracy", "test_size", "rank", "is_best")


@register("m21_training_flow")
def m21_training_flow(spark, sf):
    """M21 (rows): load -> check -> split -> fit -> evaluate -> compare."""
    res = run_flow(labeled(spark, sf), TARGET, NUMERIC, CATEGORICAL, ["doc_id"], SMALL_MODELS)
    return res["results"].select("model_name", "status", "rank", "is_best", "test_size")
