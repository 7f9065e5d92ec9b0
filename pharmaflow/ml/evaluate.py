"""Evaluation metrics as DataFrames.

Classification metrics come from the confusion table ``groupBy(y, p)``,
which has at most classes^2 rows, so everything after that one aggregation
is tiny. Regression metrics are one aggregate. Exact ROC AUC uses Spark's
distributed binary evaluator with binning switched off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.prefix import prefix_sums


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) for the observed pairs."""
    return (df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
              .agg(F.count(F.lit(1)).alias("count")))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     labels: Sequence | None = None) -> DataFrame:
    """One row per true label, one column per predicted label (pivot
    over known labels; give ``labels`` to skip the distinct-values pass)."""
    c = confusion(df, label, prediction)
    piv = c.groupBy("label").pivot("prediction", list(labels) if labels else None).sum("count")
    return piv.na.fill(0)


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class (union of true and predicted labels, sorted):
    precision, recall, f1 (zero division -> 0) and support.

    One aggregation of the data (the confusion table); each confusion cell
    then contributes to its true class (support, tp) and its predicted class
    (predicted count) through a two-element explode, so no joins follow."""
    c = confusion(df, label, prediction)
    hit = (F.col("label") == F.col("prediction")).cast("long") * F.col("count")
    parts = F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("support"),
                 hit.alias("tp"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("count").alias("predicted")))
    j = (c.select(F.explode(parts).alias("x")).select("x.*")
          .groupBy("cls").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                              F.sum("predicted").alias("predicted")))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    out = j.select(F.col("cls").alias("class"), p.alias("precision"), r.alias("recall"),
                   F.col("support").cast("long").alias("support"), F.col("tp").cast("long").alias("tp"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return out.withColumn("f1", f1).orderBy("class")


def classification_metrics(df: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """Accuracy and macro precision/recall/F1 plus support-weighted
    averages (M12 report rows), one row."""
    pc = per_class(df, label, prediction)
    return pc.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall_weighted"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.sum("support").cast("long").alias("support"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> float:
    """M11 (binary): exact area under the ROC curve (ties count one half).

    Runs Spark's distributed binary metrics with ``numBins=0`` (no
    down-sampling of the curve)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    data = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="_s", labelCol="_y",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(data))


def auc_per_class(df: DataFrame, label: str = "label", probabilities: str = "probabilities") -> DataFrame:
    """M11 (multi-class): (class, roc_auc) of every class against the rest, from an array of scores whose
    i-th item is the score of the rows labelled i.

    One histogram holds the scores of all classes (rows of a class and score, those of the class and
    others counted apart). With the number of other rows below each score, by prefix sums over ranges
    of scores, the area is the rank sum ``sum(own * (others below + others equal / 2)) / (own * others)``. A
    class that no row or every row has gives NULL."""
    own = F.col("_y") == F.col("_i")
    scores = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), F.posexplode(probabilities).alias("_i", "_s"))
    hist = scores.groupBy("_i", "_s").agg(F.count_if(own).alias("_own"), F.count_if(~own).alias("_other"))
    ranked = prefix_sums(hist, ["_i"], ["_s"], {"_other": "_below"})
    n = F.sum("_own") * F.sum("_other")
    area = F.sum(F.col("_own") * (F.col("_below") + F.col("_other") / 2))
    return ranked.groupBy(F.col("_i").alias("class")).agg(F.when(n > 0, area / n).alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, label: str = "label", probabilities: str = "probabilities") -> DataFrame:
    """M11 (multi-class): the mean of the classes' areas (``auc_per_class``), one row."""
    return auc_per_class(df, label, probabilities).agg(F.avg("roc_auc").alias("roc_auc_macro"))


def auc_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """M11 as a one-row DataFrame (the AUC is computed by the evaluator)."""
    spark = df.sparkSession
    return spark.range(1).select(F.lit(roc_auc(df, label, score)).alias("roc_auc"))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mse, rmse, mae, r2 and mape (%) in one aggregate.

    r2 = 1 - SSE / (n * population variance of y), which does not cancel. mape
    is +inf when some y = 0 with a non-zero error; rows with y = 0 and no error
    (0/0) count neither above nor below the line.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"),
                 F.var_pop(y).alias("var"), F.avg(F.when(y != 0, F.abs(e / y))).alias("ape"),
                 F.count_if((y == 0) & (e != 0)).alias("zero_y"))
    n = F.col("n")
    sst = n * F.col("var")
    mse = F.col("sse") / n
    return agg.select(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), (F.col("sae") / n).alias("mae"),
        F.when(sst != 0, F.lit(1.0) - F.col("sse") / sst).alias("r2"),
        F.when(F.col("zero_y") > 0, F.lit(float("inf")))
         .otherwise(F.col("ape") * 100).alias("mape"))


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction",
              alias: str = "residual") -> DataFrame:
    """Y - p as a column (stays distributed)."""
    return df.withColumn(alias, F.col(label).cast("double") - F.col(prediction).cast("double"))


def compare(results: DataFrame, primary: str = "accuracy", name_col: str = "model_name",
            order_col: str | None = None) -> DataFrame:
    """Model results sorted by ``primary`` descending (name breaks ties),
    with ``is_best`` on the first strict maximum in input order
    (``order_col``) or by name."""
    tie = F.col(order_col) if order_col else F.col(name_col)
    w = Window.partitionBy().orderBy(F.col(primary).desc_nulls_last(), tie)
    return (results.withColumn("rank", F.row_number().over(w))
                   .withColumn("is_best", F.col("rank") == 1)
                   .orderBy("rank"))
