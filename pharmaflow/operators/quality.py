"""Data-quality checks (Q1-Q14).

Every check of a suite becomes one or two aggregate columns of a single
``df.agg(...)``, so the data is scanned once however many checks there are.
The one-row result is reshaped to one row per check by exploding a literal
array of structs (no join, nothing collected).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import missing


@dataclass(frozen=True)
class Check:
    """One expectation. ``kind`` is one of: column_exists, values_between,
    values_in_set, not_null, row_count_between, column_count_between,
    distinct_in_set."""
    kind: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = ()
    mostly: float = 1.0

    def kwargs(self) -> str:
        """The check's own settings as JSON text, by name."""
        unset = {f.name: f.default for f in fields(self)}
        own = {k: v for k, v in asdict(self).items() if k != "kind" and v != unset[k]}
        return json.dumps(own, sort_keys=True, default=str)


# The reference's expectation suites.
EVENT_COLUMNS_EXPECTED = ["patientonsetage", "patientsex", "reaction", "brand_name", "serious"]
SEX_VALUES = ("M", "F", "U", "Unknown")
SERIOUS_VALUES = (0, 1, 2)
PATIENT_EVENT_COLUMNS = ["patient_id", "encounter_id", "condition_code"]


def suite(kind: str = "safety_events", target: str | None = None) -> list[Check]:
    """Q12: the suite for a data type, plus the training add-on when
    ``target`` is given."""
    if kind == "safety_events":
        checks = [Check("column_exists", c) for c in EVENT_COLUMNS_EXPECTED] + [
            Check("values_between", "patientonsetage", 0, 120, mostly=0.95),
            Check("values_in_set", "patientsex", value_set=SEX_VALUES),
            Check("values_in_set", "serious", value_set=SERIOUS_VALUES),
            Check("not_null", "serious", mostly=0.8),
            Check("row_count_between", min_value=1000, max_value=1_000_000),
        ]
    elif kind == "patient_events":
        checks = [Check("column_exists", c) for c in PATIENT_EVENT_COLUMNS]
    else:
        checks = [Check("row_count_between", min_value=1, max_value=10_000_000),
                  Check("column_count_between", min_value=1, max_value=1000)]
    if target is not None:
        checks += training_checks(target)
    return checks


def training_checks(target: str, classes: Sequence = SERIOUS_VALUES) -> list[Check]:
    """Q12 training add-on: target exists, mostly non-null, classes in set,
    enough rows."""
    return [Check("column_exists", target),
            Check("not_null", target, mostly=0.9),
            Check("distinct_in_set", target, value_set=tuple(classes)),
            Check("row_count_between", min_value=1000, max_value=10_000_000)]


def _in_set(col: Column, dtype, values) -> Column:
    """Type-aware membership: numbers compare as numbers, everything else as
    text (no implicit casts that could fail under ANSI mode)."""
    if isinstance(dtype, NumericType) and all(isinstance(v, (int, float)) for v in values):
        return col.isin(list(values))
    return col.cast("string").isin([str(v) for v in values])


def _ratio_ok(unexpected: Column, total: Column, mostly: float) -> Column:
    return (total == 0) | ((F.lit(1.0) - unexpected / total) >= F.lit(mostly))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Q5-Q11: evaluate ``checks`` in one aggregate; one row per check."""
    types = {f.name: f.dataType for f in df.schema.fields}
    ncols = len(df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    rows = F.col("_rows")
    results = []
    null_l = F.lit(None).cast("long")
    null_d = F.lit(None).cast("double")

    def add(expr):
        name = f"_a{len(aggs)}"
        aggs.append(expr.alias(name))
        return F.col(name)

    for i, ck in enumerate(checks):
        present = ck.column in types if ck.column else True
        if ck.kind == "column_exists":
            res = (F.lit(present), null_l, null_l, null_d)
        elif ck.kind == "row_count_between":
            ok = F.lit(True)
            if ck.min_value is not None:
                ok = ok & (rows >= F.lit(ck.min_value))
            if ck.max_value is not None:
                ok = ok & (rows <= F.lit(ck.max_value))
            res = (ok, rows, null_l, rows.cast("double"))
        elif ck.kind == "column_count_between":
            ok = (ck.min_value is None or ncols >= ck.min_value) and \
                 (ck.max_value is None or ncols <= ck.max_value)
            res = (F.lit(ok), null_l, null_l, F.lit(float(ncols)))
        elif not present:
            res = (F.lit(False), null_l, null_l, null_d)
        else:
            c = F.col(ck.column)
            if ck.kind == "not_null":
                bad = add(F.count_if(missing(df, ck.column)))
                res = (_ratio_ok(bad, rows, ck.mostly), rows, bad, null_d)
            elif ck.kind == "values_between":
                num = c.try_cast("double")
                out = ~num.between(F.lit(ck.min_value), F.lit(ck.max_value))
                nn = add(F.count(c))
                bad = add(F.count_if(c.isNotNull() & (num.isNull() | out)))
                res = (_ratio_ok(bad, nn, ck.mostly), nn, bad, null_d)
            elif ck.kind in ("values_in_set", "distinct_in_set"):
                nn = add(F.count(c))
                bad = add(F.count_if(c.isNotNull() & ~_in_set(c, types[ck.column], ck.value_set)))
                ok = _ratio_ok(bad, nn, ck.mostly) if ck.kind == "values_in_set" else (bad == 0)
                res = (ok, nn, bad, null_d)
            else:
                raise ValueError(f"unknown check kind {ck.kind}")
        results.append(F.struct(
            F.lit(i + 1).alias("position"), F.lit(ck.kind).alias("check"),
            F.lit(ck.column).cast("string").alias("column"),
            res[0].alias("success"), res[1].cast("long").alias("element_count"),
            res[2].cast("long").alias("unexpected_count"), res[3].cast("double").alias("observed")))
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def summarize(results: DataFrame) -> DataFrame:
    """Q13: success, rate, totals over the per-check rows (one row)."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
    ).withColumn("success_rate", F.try_divide(F.col("successful_expectations").cast("double"),
                                              F.col("total_expectations")))


def failed_details(results: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Q13: the failed rows of ``run_checks(df, checks)`` with the settings of their checks as
    JSON (``kwargs``): the check, its column, what was asked and what was seen."""
    asked = F.array(*[F.lit(c.kwargs()) for c in checks])
    return results.where(~F.col("success")).select(
        "position", "check", "column", F.element_at(asked, F.col("position")).alias("kwargs"),
        "element_count", "unexpected_count", "observed")


def basic_quality(df: DataFrame, target: str, min_rows: int = 100,
                  max_missing_ratio: float = 0.5, min_class_size: int = 10) -> DataFrame:
    """Q1-Q4 in one scan: (check, column, observed, passed, blocking).

    Failing a blocking check (too few rows, missing target) makes the data
    invalid; class size and missing ratios are reported issues only.
    Implemented as a per-class partial aggregate (class count + null counts
    per column) rolled up once more, so the table is read a single time.
    """
    cols = df.columns
    has_target = target in cols
    nulls = [F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    if has_target:
        g = df.groupBy(F.col(target).alias("_t")).agg(F.count(F.lit(1)).alias("_n"), *nulls)
        one = g.agg(F.sum("_n").alias("_rows"),
                    F.min(F.when(F.col("_t").isNotNull(), F.col("_n"))).alias("_min_class"),
                    *[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(cols))])
    else:
        one = df.agg(F.count(F.lit(1)).alias("_rows"),
                     F.lit(None).cast("long").alias("_min_class"), *nulls)
    rows = F.col("_rows")

    def row(check, column, observed, passed, blocking):
        return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                        observed.cast("double").alias("observed"),
                        F.coalesce(passed, F.lit(True)).alias("passed"),
                        F.lit(blocking).alias("blocking"))

    items = [row("min_rows", None, rows, rows >= F.lit(min_rows), True),
             row("target_present", target, F.lit(None), F.lit(has_target), True)]
    if has_target:
        mc = F.col("_min_class")
        items.append(row("min_class_size", target, mc, mc >= F.lit(min_class_size), False))
    for i, c in enumerate(cols):
        ratio = F.try_divide(F.col(f"_m{i}").cast("double"), rows)
        items.append(row("missing_ratio", c, ratio, ratio <= F.lit(max_missing_ratio), False))
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def is_valid(quality: DataFrame) -> DataFrame:
    """Q1-Q4 verdict: valid unless a blocking check failed; issue count."""
    return quality.agg(
        F.coalesce(F.bool_and(F.when(F.col("blocking"), F.col("passed"))), F.lit(True)).alias("is_valid"),
        F.count_if(~F.col("passed")).alias("issues"))


def column_kind(dtype) -> str:
    if isinstance(dtype, NumericType):
        return "numeric"
    if isinstance(dtype, StringType):
        return "categorical"
    return "other"


def quality_report(df: DataFrame) -> DataFrame:
    """Q14: per column: type, missing count, numeric/categorical kind; with
    the table shape (rows, columns). One aggregate."""
    fields = df.schema.fields
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(missing(df, f.name)).alias(f"_m{i}") for i, f in enumerate(fields)])
    items = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                      F.lit(f.dataType.simpleString()).alias("type"),
                      F.col(f"_m{i}").alias("missing"),
                      F.lit(column_kind(f.dataType)).alias("kind"))
             for i, f in enumerate(fields)]
    return (one.select(F.explode(F.array(*items)).alias("c"), "rows")
               .select("c.*", "rows", F.lit(len(fields)).alias("columns")))


def write_quality_report(df: DataFrame, path: str, checks: Sequence[Check] | None = None) -> None:
    """Q14 JSON sink: the column report and, when given, the check results
    (and their summary) as NDJSON folders under ``path``."""
    quality_report(df).write.mode("overwrite").json(f"{path.rstrip('/')}/columns")
    if checks:
        res = run_checks(df, checks)
        res.write.mode("overwrite").json(f"{path.rstrip('/')}/checks")
        summarize(res).write.mode("overwrite").json(f"{path.rstrip('/')}/summary")
