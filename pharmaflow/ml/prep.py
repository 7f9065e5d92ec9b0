"""Feature preprocessing as Spark ML pipeline stages (M2-M4).

Numeric: median impute, then standardize with the population std (sklearn
semantics; Spark's Imputer median is approximate and its StandardScaler uses
the sample std). Fitted constants come from one or two aggregates and are
baked into ``SQLTransformer`` stages, so the result is an ordinary,
saveable ``PipelineModel``.

Categorical: most-frequent impute (count desc, value asc), then
``StringIndexer(alphabetAsc, keep)`` + ``OneHotEncoder(dropLast=True)``:
one slot per training category, and an unseen value maps to all zeros. That keeps each
column's vocabulary in the model, on the driver. ``TableEncoder`` encodes the same way from
vocabularies that stay tables, and ``FeatureHasher`` without any.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer,
                                VectorAssembler)
from pyspark.sql import DataFrame, functions as F


from ..operators.prefix import dense_ids
from ..operators.small import small
from ..session import scratch_path


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def numeric_stats(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict:
    """Exact medians, then mean and population std of the imputed columns.
    Returns {col: (median, mean, scale)}; scale 1.0 when std is 0 or NULL."""
    if not cols:
        return {}
    from ..operators.drift import _per_column, numeric_medians
    if approx:
        q = _per_column(df, cols, {"median": lambda v: F.percentile_approx(v, 0.5, 10000)})
    else:
        q = numeric_medians(df, cols)
    meds = {c: None for c in cols} | {r["feature"]: r["median"] for r in q.collect()}  # one row per column
    imputed = [F.coalesce(F.col(c).cast("double"), F.lit(meds[c])).alias(c) for c in cols]
    x = df.select(*imputed)
    row = x.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s_{i}"]
        out[c] = (meds[c], row[f"m_{i}"], s if s else 1.0)
    return out


def categorical_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-NULL value per column (ties: smallest value)."""
    if not cols:
        return {}
    from ..operators.drift import value_counts
    vc = value_counts(df, cols).where(F.col("value").isNotNull())
    modes = vc.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("count")).alias("c"), F.col("value").alias("v"))).alias("mode"))
    return {r["feature"]: r["mode"] for r in modes.collect()}


def preprocessor_stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                        features_col: str = "features", approx: bool = False,
                        encoding: str = "onehot", hash_features: int = 1 << 18) -> list:
    """M4: fitted constants + stages producing ``features_col``.

    ``encoding="onehot"`` (default) matches the reference: one slot per
    training category, unseen -> zeros. Fitting it collects each column's
    distinct values to the driver, so for high-cardinality columns use a ``TableEncoder``
    or ``encoding="hash"``: ``FeatureHasher`` into ``hash_features`` slots, with
    no fitted vocabulary (unseen values simply hash)."""
    numeric, categorical = list(numeric), list(categorical)
    stats = numeric_stats(df, numeric, approx)
    modes = categorical_modes(df, categorical)
    exprs = []
    for c in numeric:
        med, mean, scale = stats[c]
        exprs.append(f"(coalesce(CAST({_q(c)} AS DOUBLE), {_lit(med)}) - {_lit(mean)}) / {_lit(scale)}"
                     f" AS {_q('num__' + c)}")
    for c in categorical:
        exprs.append(f"coalesce(CAST({_q(c)} AS STRING), {_lit(modes.get(c))}) AS {_q('cat__' + c)}")
    stages = []
    if exprs:
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__"))
    inputs = [f"num__{c}" for c in numeric]
    if categorical and encoding == "hash":
        cats = [f"cat__{c}" for c in categorical]
        stages.append(FeatureHasher(inputCols=cats, categoricalCols=cats, outputCol="hashed__cat",
                                    numFeatures=hash_features))
        inputs.append("hashed__cat")
    elif categorical:
        idx = [f"idx__{c}" for c in categorical]
        ohe = [f"ohe__{c}" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"cat__{c}" for c in categorical], outputCols=idx,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        # The indexer maps unseen values to one extra index; dropLast removes that
        # slot, so an unseen value encodes as all zeros.
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
        inputs += ohe
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid="keep"))
    return stages


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     features_col: str = "features") -> PipelineModel:
    return Pipeline(stages=preprocessor_stages(df, numeric, categorical, features_col)).fit(df)


VOCABULARY = "value string, slot bigint, feature string"


class TableEncoder:
    """M3/M4 with vocabularies as tables: the same vectors as the one-hot stages, for any number of
    categories.

    Fitting numbers the values of all categorical columns in order by prefix counts over value
    ranges (``operators.prefix``) and writes (feature, value, slot) to the shared folder. Encoding joins
    each column with its part, broadcast only if that is small, and assembles sparse vectors. The driver
    holds a constant and a size per column.
    """

    def __init__(self, path: str, numeric: dict, modes: dict, sizes: dict, features_col: str = "features"):
        self.path, self.numeric, self.modes, self.sizes, self.features_col = path, numeric, modes, sizes, features_col

    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
            features_col: str = "features") -> "TableEncoder":
        from ..operators.drift import value_counts
        categorical = list(categorical)
        path, sizes = scratch_path(df.sparkSession, f"vocabulary-{uuid.uuid4().hex[:12]}"), {}
        if categorical:
            values = value_counts(df, categorical).where(F.col("value").isNotNull())
            dense_ids(values, ["feature"], ["value"], "slot").write.partitionBy("feature").parquet(path)
            counts = df.sparkSession.read.schema(VOCABULARY).parquet(path).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
            sizes = {r["feature"]: r["n"] for r in counts.collect()}
        sizes = {c: sizes.get(c, 0) for c in categorical}
        return cls(path, numeric_stats(df, list(numeric)), categorical_modes(df, categorical), sizes, features_col)

    def vocabulary(self, df: DataFrame, column: str) -> DataFrame:
        """(value, slot) of a column."""
        return df.sparkSession.read.schema(VOCABULARY).parquet(self.path).where(
            F.col("feature") == column).select("value", "slot")

    def indexed(self, df: DataFrame) -> DataFrame:
        """``df`` with ``idx__<column>``: the slot of its value, imputed; one past the last for an unseen one."""
        for c, size in self.sizes.items():
            if size:
                v = small(self.vocabulary(df, c).select(F.col("value").alias("_value"), F.col("slot").alias("_slot")))
                value = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
                meta = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
                df = df.join(v, value == F.col("_value"), "left").withColumn(
                    f"idx__{c}", F.coalesce("_slot", F.lit(size)).cast("double").alias(f"idx__{c}", metadata=meta)).drop("_value", "_slot")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        inputs = []
        for c, (median, mean, scale) in self.numeric.items():
            x = F.coalesce(F.col(c).cast("double"), F.lit(median).cast("double"))
            df = df.withColumn(f"num__{c}", (x - F.lit(mean)) / F.lit(scale))
            inputs.append(f"num__{c}")
        df, used = self.indexed(df), [c for c, n in self.sizes.items() if n]
        if used:
            # the sizes come with the columns, so this fit reads no data
            enc = OneHotEncoder(inputCols=[f"idx__{c}" for c in used], outputCols=[f"ohe__{c}" for c in used], dropLast=True)
            df = enc.fit(df).transform(df)
            inputs += [f"ohe__{c}" for c in used]
        return VectorAssembler(inputCols=inputs, outputCol=self.features_col, handleInvalid="keep").transform(df)

    def save(self, df: DataFrame, path: str) -> None:
        """The vocabularies and constants under ``path``."""
        if self.sizes:
            df.sparkSession.read.schema(VOCABULARY).parquet(self.path).write.mode("overwrite").partitionBy("feature").parquet(f"{path}/vocabulary")
        state = json.dumps([self.numeric, self.modes, self.sizes, self.features_col])
        df.sparkSession.createDataFrame([(state,)], "state string").write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> "TableEncoder":
        numeric, modes, sizes, features_col = json.loads(spark.read.text(f"{path}/state").first()[0])
        return cls(f"{path}/vocabulary", numeric, modes, sizes, features_col)
