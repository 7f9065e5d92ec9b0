"""Data-quality, drift and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR, quality as Q
from .registry import r6, register, t
from .relational import monthly_points


# ------------------------------------------------------------------ Q1-Q4
def _docs_labels(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = t(spark, sf, "labels")
    return d.join(lab, "doc_id", "left")


_DL = """
WITH dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
n AS (SELECT count(*) AS rows FROM dl)"""


_BQ = _DL + """,
mc AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM dl WHERE quality IS NOT NULL GROUP BY quality)),
bq AS (
SELECT 'min_rows' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(rows AS DOUBLE) AS observed,
       rows >= 100 AS passed, true AS blocking FROM n
UNION ALL SELECT 'target_present', 'quality', NULL, true, true
UNION ALL SELECT 'min_class_size', 'quality', CAST(m AS DOUBLE), coalesce(m >= 10, true), false FROM mc
UNION ALL SELECT 'missing_ratio', c, round(r, 6), r <= 0.5, false FROM (
  SELECT 'doc_id' AS c, count(*) FILTER (WHERE doc_id IS NULL) / (SELECT rows FROM n) AS r FROM dl
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) / (SELECT rows FROM n) FROM dl
  UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL) / (SELECT rows FROM n) FROM dl
  UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE n_chars IS NULL) / (SELECT rows FROM n) FROM dl
  UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) / (SELECT rows FROM n) FROM dl
  UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) / (SELECT rows FROM n) FROM dl))"""


@register("q1_q4_basic_quality", _BQ + "\nSELECT * FROM bq")
def q1_q4_basic_quality(spark, sf):
    out = Q.basic_quality(_docs_labels(spark, sf), "quality", min_rows=100, max_missing_ratio=0.5)
    return out.withColumn("observed", r6("observed"))


@register("q1_q4_validity", _BQ + """
SELECT coalesce(bool_and(passed) FILTER (WHERE blocking), true) AS is_valid,
       count(*) FILTER (WHERE NOT passed) AS issues FROM bq""")
def q1_q4_validity(spark, sf):
    return Q.is_valid(Q.basic_quality(_docs_labels(spark, sf), "quality"))


# ------------------------------------------------------------------ Q5-Q13
def events_like(spark, sf):
    """Orders shaped like the safety-event table (brand_name left out so the
    column check fails; ages 0..129 so some are out of range)."""
    o = t(spark, sf, "orders")
    return o.select(
        (F.col("o_custkey") % 130).cast("double").alias("patientonsetage"),
        F.when(F.col("o_orderstatus") == "F", "M").when(F.col("o_orderstatus") == "O", "F")
         .otherwise("X").alias("patientsex"),
        F.col("o_orderpriority").alias("reaction"),
        (F.substring("o_orderpriority", 1, 1).cast("int") % 3).alias("serious"))


_EV = """
WITH ev AS (SELECT CAST(o_custkey % 130 AS DOUBLE) AS patientonsetage,
                   CASE o_orderstatus WHEN 'F' THEN 'M' WHEN 'O' THEN 'F' ELSE 'X' END AS patientsex,
                   o_orderpriority AS reaction,
                   CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 3 AS serious FROM orders),
s AS (SELECT count(*) AS n, count(patientonsetage) AS age_nn,
             count(*) FILTER (WHERE patientonsetage IS NOT NULL AND NOT patientonsetage BETWEEN 0 AND 120) AS age_bad,
             count(patientsex) AS sex_nn,
             count(*) FILTER (WHERE patientsex IS NOT NULL AND patientsex NOT IN ('M', 'F', 'U', 'Unknown')) AS sex_bad,
             count(serious) AS ser_nn,
             count(*) FILTER (WHERE serious IS NOT NULL AND serious NOT IN (0, 1, 2)) AS ser_bad,
             count(*) FILTER (WHERE serious IS NULL) AS ser_null FROM ev),
r AS (
  SELECT 1 AS position, 'column_exists' AS "check", 'patientonsetage' AS "column", true AS success,
         CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS unexpected_count,
         CAST(NULL AS DOUBLE) AS observed
  UNION ALL SELECT 2, 'column_exists', 'patientsex', true, NULL, NULL, NULL
  UNION ALL SELECT 3, 'column_exists', 'reaction', true, NULL, NULL, NULL
  UNION ALL SELECT 4, 'column_exists', 'brand_name', false, NULL, NULL, NULL
  UNION ALL SELECT 5, 'column_exists', 'serious', true, NULL, NULL, NULL
  UNION ALL SELECT 6, 'values_between', 'patientonsetage', age_nn = 0 OR 1.0 - age_bad / age_nn >= 0.95,
                   age_nn, age_bad, NULL FROM s
  UNION ALL SELECT 7, 'values_in_set', 'patientsex', sex_nn = 0 OR 1.0 - sex_bad / sex_nn >= 1.0,
                   sex_nn, sex_bad, NULL FROM s
  UNION ALL SELECT 8, 'values_in_set', 'serious', ser_nn = 0 OR 1.0 - ser_bad / ser_nn >= 1.0,
                   ser_nn, ser_bad, NULL FROM s
  UNION ALL SELECT 9, 'not_null', 'serious', n = 0 OR 1.0 - ser_null / n >= 0.8, n, ser_null, NULL FROM s
  UNION ALL SELECT 10, 'row_count_between', NULL, n BETWEEN 1000 AND 1000000, n, NULL, CAST(n AS DOUBLE) FROM s
  UNION ALL SELECT 11, 'column_exists', 'serious', true, NULL, NULL, NULL
  UNION ALL SELECT 12, 'not_null', 'serious', n = 0 OR 1.0 - ser_null / n >= 0.9, n, ser_null, NULL FROM s
  UNION ALL SELECT 13, 'distinct_in_set', 'serious', ser_bad = 0, ser_nn, ser_bad, NULL FROM s
  UNION ALL SELECT 14, 'row_count_between', NULL, n BETWEEN 1000 AND 10000000, n, NULL, CAST(n AS DOUBLE) FROM s)"""


def _event_suite_results(spark, sf):
    return Q.run_checks(events_like(spark, sf), Q.suite("safety_events", target="serious"))


@register("q5_q12_event_suite", _EV + "\nSELECT * FROM r")
def q5_q12_event_suite(spark, sf):
    return _event_suite_results(spark, sf)


@register("q13_suite_summary", _EV + """
SELECT bool_and(success) AS success, count(*) AS total_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS failed_expectations,
       round(count(*) FILTER (WHERE success) / count(*), 6) AS success_rate FROM r""")
def q13_suite_summary(spark, sf):
    return Q.summarize(_event_suite_results(spark, sf)).withColumn("success_rate", r6("success_rate"))


@register("q13_failed_details", _EV + """
SELECT r.position, "check", "column", kwargs, element_count, unexpected_count, observed
FROM r JOIN (VALUES (1, '{"column": "patientonsetage"}'), (2, '{"column": "patientsex"}'),
  (3, '{"column": "reaction"}'), (4, '{"column": "brand_name"}'), (5, '{"column": "serious"}'),
  (6, '{"column": "patientonsetage", "max_value": 120, "min_value": 0, "mostly": 0.95}'),
  (7, '{"column": "patientsex", "value_set": ["M", "F", "U", "Unknown"]}'),
  (8, '{"column": "serious", "value_set": [0, 1, 2]}'), (9, '{"column": "serious", "mostly": 0.8}'),
  (10, '{"max_value": 1000000, "min_value": 1000}'), (11, '{"column": "serious"}'),
  (12, '{"column": "serious", "mostly": 0.9}'), (13, '{"column": "serious", "value_set": [0, 1, 2]}'),
  (14, '{"max_value": 10000000, "min_value": 1000}')) AS k(position, kwargs) ON k.position = r.position
WHERE NOT success""")
def q13_failed_details(spark, sf):
    """Failed checks of the event suite: a column that does not exist, ages and sexes out of range."""
    return Q.failed_details(_event_suite_results(spark, sf), Q.suite("safety_events", target="serious"))


@register("q12_generic_suite", """
SELECT 1 AS position, 'row_count_between' AS "check", CAST(NULL AS VARCHAR) AS "column",
       count(*) BETWEEN 1 AND 10000000 AS success, count(*) AS element_count,
       CAST(NULL AS BIGINT) AS unexpected_count, CAST(count(*) AS DOUBLE) AS observed FROM lineitem
UNION ALL SELECT 2, 'column_count_between', NULL, true, NULL, NULL, 11.0""")
def q12_generic_suite(spark, sf):
    return Q.run_checks(t(spark, sf, "lineitem"), Q.suite("generic"))


@register("q12_patient_event_suite", """
SELECT 1 AS position, 'column_exists' AS "check", 'patient_id' AS "column", false AS success,
       CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS unexpected_count,
       CAST(NULL AS DOUBLE) AS observed
UNION ALL SELECT 2, 'column_exists', 'encounter_id', true, NULL, NULL, NULL
UNION ALL SELECT 3, 'column_exists', 'condition_code', true, NULL, NULL, NULL""")
def q12_patient_event_suite(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("encounter_id"),
                                       F.col("o_orderpriority").alias("condition_code"))
    return Q.run_checks(o, Q.suite("patient_events"))


@register("q14_quality_report", """
WITH m AS (SELECT count(*) AS rows,
                  count(*) FILTER (WHERE c_custkey IS NULL) AS m1, count(*) FILTER (WHERE c_name IS NULL) AS m2,
                  count(*) FILTER (WHERE c_nationkey IS NULL) AS m3, count(*) FILTER (WHERE c_acctbal IS NULL) AS m4,
                  count(*) FILTER (WHERE c_mktsegment IS NULL) AS m5 FROM customer)
SELECT 1 AS position, 'c_custkey' AS "column", 'bigint' AS type, m1 AS missing, 'numeric' AS kind, rows, 5 AS columns FROM m
UNION ALL SELECT 2, 'c_name', 'string', m2, 'categorical', rows, 5 FROM m
UNION ALL SELECT 3, 'c_nationkey', 'int', m3, 'numeric', rows, 5 FROM m
UNION ALL SELECT 4, 'c_acctbal', 'double', m4, 'numeric', rows, 5 FROM m
UNION ALL SELECT 5, 'c_mktsegment', 'string', m5, 'categorical', rows, 5 FROM m""")
def q14_quality_report(spark, sf):
    return Q.quality_report(t(spark, sf, "customer"))


# ------------------------------------------------------------------ D1-D4
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _num_sql(table, cols, where=""):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.5), 6) AS median,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.75), 6) AS q75,
       round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS missing_ratio, count(*) AS rows
FROM {table} {where}""")
    return "\nUNION ALL ".join(parts)


def _round_stats(df):
    return df.select("feature", *[r6(c).alias(c) for c in
                                  ["mean", "std", "min", "max", "median", "q25", "q75", "missing_ratio"]],
                     "rows")


@register("d1_numeric_baseline", _num_sql("lineitem", _NUM))
def d1_numeric_baseline(spark, sf):
    return _round_stats(DR.numeric_stats(t(spark, sf, "lineitem"), _NUM))


@register("d1_numeric_baseline_bracketed", _num_sql("lineitem", _NUM))
def d1_numeric_baseline_bracketed(spark, sf):
    """D1 with small histograms, so that every quantile is refined many times; same exact answer."""
    return _round_stats(DR.numeric_stats(t(spark, sf, "lineitem"), _NUM, bits=7))


_CAT = ["l_returnflag", "l_linestatus"]


@register("d2_category_stats", """
WITH u AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem
           UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem),
c AS (SELECT feature, value, count(*) AS n FROM u GROUP BY 1, 2)
SELECT feature, count(value) AS unique_values,
       arg_min(value, (-n, value)) FILTER (WHERE value IS NOT NULL) AS most_frequent,
       round(coalesce(max(n) FILTER (WHERE value IS NOT NULL), 0) / sum(n), 6) AS most_frequent_ratio,
       round(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) / sum(n), 6) AS missing_ratio,
       CAST(sum(n) AS BIGINT) AS rows
FROM c GROUP BY feature""")
def d2_category_stats(spark, sf):
    s = DR.category_stats(t(spark, sf, "lineitem"), _CAT)
    return s.select("feature", "unique_values", "most_frequent", r6("most_frequent_ratio").alias("most_frequent_ratio"),
                    r6("missing_ratio").alias("missing_ratio"), F.col("rows").cast("bigint").alias("rows"))


@register("d2_value_dist", """
WITH u AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem
           UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem)
SELECT feature, value, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY feature), 6) AS ratio
FROM u WHERE value IS NOT NULL GROUP BY 1, 2""")
def d2_value_dist(spark, sf):
    return DR.value_dist(t(spark, sf, "lineitem"), _CAT).withColumn("ratio", r6("ratio"))


@register("d3_prediction_stats", """
SELECT round(avg(l_linenumber), 6) AS mean, round(stddev_pop(l_linenumber), 6) AS std,
       CAST(min(l_linenumber) AS DOUBLE) AS min, CAST(max(l_linenumber) AS DOUBLE) AS max,
       round(quantile_cont(l_linenumber, 0.5), 6) AS median FROM lineitem""")
def d3_prediction_stats(spark, sf):
    s = DR.prediction_stats(t(spark, sf, "lineitem"), "l_linenumber")
    return s.select(*[r6(c).alias(c) for c in s.columns])


@register("d3_prediction_histogram", """
WITH c AS (SELECT l_linenumber AS bin, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, coalesce(c.n, 0) AS count
FROM range(0, (SELECT max(bin) FROM c) + 1) AS b(bin) LEFT JOIN c ON c.bin = b.bin""")
def d3_prediction_histogram(spark, sf):
    return DR.prediction_histogram(t(spark, sf, "lineitem"), "l_linenumber")


@register("d4_target_distribution", """
SELECT quality, count(*) AS count FROM labels WHERE quality IS NOT NULL GROUP BY quality""")
def d4_target_distribution(spark, sf):
    return DR.target_distribution(t(spark, sf, "labels"), "quality")


# ------------------------------------------------------------------ D5-D7
_SPLIT = "1999-01-01"


@register("d5_numeric_drift", f"""
WITH b AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{_SPLIT}'),
c AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_SPLIT}'),
bs AS ({" UNION ALL ".join(f"SELECT '{x}' AS feature, avg({x}) AS bm, stddev_samp({x}) AS bsd FROM b" for x in _NUM)}),
cs AS ({" UNION ALL ".join(f"SELECT '{x}' AS feature, avg({x}) AS cm, stddev_samp({x}) AS csd, count({x}) AS cn FROM c" for x in _NUM)}),
j AS (SELECT cs.feature, bm, bsd, cm, csd, cn,
             CASE WHEN bsd > 0 THEN abs(cm - bm) / bsd ELSE 0.0 END AS md,
             CASE WHEN bsd > 0 THEN abs(csd - bsd) / bsd ELSE 0.0 END AS sd FROM cs JOIN bs USING (feature))
SELECT feature, CASE WHEN cn = 0 THEN 'missing_data' ELSE 'statistical' END AS drift_type,
       round(CASE WHEN cn = 0 THEN 0.0 ELSE greatest(md, sd) END, 6) AS drift_score,
       cn = 0 OR greatest(md, sd) > 0.1 AS drift_detected,
       round(bm, 6) AS baseline_mean, round(cm, 6) AS current_mean,
       round(bsd, 6) AS baseline_std, round(csd, 6) AS current_std,
       round(md, 6) AS mean_drift, round(sd, 6) AS std_drift FROM j""")
def d5_numeric_drift(spark, sf):
    li = t(spark, sf, "lineitem")
    base = DR.numeric_stats(li.where(F.col("l_shipdate") < F.lit(_SPLIT)), _NUM)
    cur = li.where(F.col("l_shipdate") >= F.lit(_SPLIT))
    d = DR.numeric_drift(base, cur, _NUM)
    num = ["drift_score", "baseline_mean", "current_mean", "baseline_std", "current_std",
           "mean_drift", "std_drift"]
    return d.select("feature", "drift_type", "drift_detected", *[r6(c).alias(c) for c in num])


_OCAT = ["o_orderpriority", "o_orderstatus"]
_OSPLIT = "1998-01-01"

_PSI_SQL = f"""
WITH bu AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value FROM orders WHERE o_orderdate < TIMESTAMP '{_OSPLIT}'
            UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '{_OSPLIT}'),
cu AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value FROM orders WHERE o_orderdate >= TIMESTAMP '{_OSPLIT}'
       UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '{_OSPLIT}'),
bd AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS b
       FROM bu WHERE value IS NOT NULL GROUP BY 1, 2),
cd AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS c
       FROM cu WHERE value IS NOT NULL GROUP BY 1, 2),
j AS (SELECT coalesce(bd.feature, cd.feature) AS feature, coalesce(b, 0.0001) AS b, coalesce(c, 0.0001) AS c
      FROM bd FULL OUTER JOIN cd ON bd.feature = cd.feature AND bd.value = cd.value),
p AS (SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM j GROUP BY feature)"""


@register("d6_categorical_drift", _PSI_SQL + """
SELECT feature, 'distribution' AS drift_type, round(psi, 6) AS drift_score, psi > 0.2 AS drift_detected FROM p""")
def d6_categorical_drift(spark, sf):
    o = t(spark, sf, "orders")
    base = DR.baseline(o.where(F.col("o_orderdate") < F.lit(_OSPLIT)), [], _OCAT)
    d = DR.categorical_drift(base, o.where(F.col("o_orderdate") >= F.lit(_OSPLIT)), _OCAT)
    return d.withColumn("drift_score", r6("drift_score"))


@register("d6_categorical_drift_compat", f"""
WITH bu AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value FROM orders WHERE o_orderdate < TIMESTAMP '{_OSPLIT}'
            UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '{_OSPLIT}'),
cu AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value FROM orders WHERE o_orderdate >= TIMESTAMP '{_OSPLIT}'
       UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '{_OSPLIT}'),
bc AS (SELECT feature, value, CAST(count(*) AS DOUBLE) AS b,
              row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS rk
       FROM bu WHERE value IS NOT NULL GROUP BY 1, 2),
bd AS (SELECT feature, value, b FROM bc WHERE rk <= 10),
cd AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS c
       FROM cu WHERE value IS NOT NULL GROUP BY 1, 2),
j AS (SELECT coalesce(bd.feature, cd.feature) AS feature, coalesce(b, 0.0001) AS b, coalesce(c, 0.0001) AS c
      FROM bd FULL OUTER JOIN cd ON bd.feature = cd.feature AND bd.value = cd.value),
p AS (SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM j GROUP BY feature)
SELECT feature, 'distribution' AS drift_type, round(psi, 6) AS drift_score, psi > 0.2 AS drift_detected FROM p""")
def d6_categorical_drift_compat(spark, sf):
    """D6 with ``compat=True``: the reference's PSI of current shares against
    the baseline's top-10 raw counts."""
    o = t(spark, sf, "orders")
    base = DR.baseline(o.where(F.col("o_orderdate") < F.lit(_OSPLIT)), [], _OCAT, compat=True)
    d = DR.categorical_drift(base, o.where(F.col("o_orderdate") >= F.lit(_OSPLIT)), _OCAT)
    return d.withColumn("drift_score", r6("drift_score"))


@register("d7_overall_drift", _PSI_SQL + f""",
nb AS (SELECT avg(o_totalprice) AS bm, stddev_samp(o_totalprice) AS bsd FROM orders WHERE o_orderdate < TIMESTAMP '{_OSPLIT}'),
nc AS (SELECT avg(o_totalprice) AS cm, stddev_samp(o_totalprice) AS csd FROM orders WHERE o_orderdate >= TIMESTAMP '{_OSPLIT}'),
n AS (SELECT greatest(abs(cm - bm) / bsd, abs(csd - bsd) / bsd) AS s FROM nb, nc),
f AS (SELECT psi AS score, psi > 0.2 AS d FROM p UNION ALL SELECT s, s > 0.1 FROM n)
SELECT bool_or(d) AS drift_detected, round(coalesce(avg(score) FILTER (WHERE d), 0.0), 6) AS drift_score,
       count(*) AS features, count(*) FILTER (WHERE d) AS drifted_features,
       coalesce(avg(score) FILTER (WHERE d), 0.0) > 0.2 AS overall_drift FROM f""")
def d7_overall_drift(spark, sf):
    o = t(spark, sf, "orders")
    old, new = o.where(F.col("o_orderdate") < F.lit(_OSPLIT)), o.where(F.col("o_orderdate") >= F.lit(_OSPLIT))
    base = DR.baseline(old, ["o_totalprice"], _OCAT)
    feats = DR.feature_drift(base, new, ["o_totalprice"], _OCAT)
    return DR.overall_drift(feats).withColumn("drift_score", r6("drift_score"))


# ------------------------------------------------------------------ D8-D9
def _points(spark, sf):
    return monthly_points(spark, sf).withColumn("metric", F.lit("accuracy"))


_MP = """
WITH m AS (SELECT o_orderpriority AS model, strftime(o_orderdate, '%Y-%m') AS ts,
                  avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS value
           FROM orders GROUP BY 1, 2)"""


@register("d8_performance_drift", _MP + """,
h AS (SELECT model, ts, value,
             avg(value) OVER (PARTITION BY model ORDER BY ts ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS hm,
             count(value) OVER (PARTITION BY model ORDER BY ts ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS nh
      FROM m)
SELECT model, 'accuracy' AS metric, ts, round(value, 6) AS value, round(hm, 6) AS historical_mean,
       nh AS n_history, round(hm - value, 6) AS performance_drop,
       nh >= 1 AND coalesce(hm - value > 0.05, false) AS drift_detected FROM h""")
def d8_performance_drift(spark, sf):
    d = DR.performance_drift(_points(spark, sf))
    return d.select("model", "metric", "ts", r6("value").alias("value"),
                    r6("historical_mean").alias("historical_mean"), "n_history",
                    r6("performance_drop").alias("performance_drop"), "drift_detected")


@register("d9_monitoring_summary", _MP + """,
l AS (SELECT model, ts, value, lag(value, 1) OVER w AS p1, lag(value, 2) OVER w AS p2,
             row_number() OVER (PARTITION BY model ORDER BY ts DESC) AS rn
      FROM m WINDOW w AS (PARTITION BY model ORDER BY ts)),
tr AS (SELECT model, CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL AND p1 >= p2 AND value >= p1 THEN 'improving'
                          WHEN p1 IS NOT NULL AND p2 IS NOT NULL AND p1 <= p2 AND value <= p1 THEN 'declining'
                          ELSE 'stable' END AS performance_trend FROM l WHERE rn = 1)
SELECT m.model, count(DISTINCT ts) AS total_monitoring_points, max(ts) AS last_monitoring_time,
       any_value(performance_trend) AS performance_trend, m.model <> '5-LOW' AS has_baseline
FROM m JOIN tr USING (model) GROUP BY m.model""")
def d9_monitoring_summary(spark, sf):
    pts = _points(spark, sf)
    baselines = (t(spark, sf, "orders").where(F.col("o_orderpriority") != "5-LOW")
                 .select(F.col("o_orderpriority").alias("model")))
    return DR.monitoring_summary(pts, baselines)
