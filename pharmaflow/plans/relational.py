"""Projection, search, aggregation and window queries on the driver tables.

Mapping of the reference's data onto the driver tables (demos):
reports -> orders, products -> part / lineitem, time series -> events.ts and
orders.o_orderdate. Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display_date, first_value, parse_timestamp, strip_ws, strip_prefix
from ..functions.dates import ts_text
from ..functions.text import WS_CLASS
from ..operators import aggregates as A, dedup as D, profile as PR, select as S, windows as W
from ..sources.tables import Catalog
from .registry import r6, register, t

# DuckDB twin of the whitespace class used by strip_ws.
WS_SQL = f"'^{WS_CLASS}+|{WS_CLASS}+$'"

ORDER_STATUS = {"F": "Fulfilled", "O": "Open"}


# ------------------------------------------------------------------ P1-P15
@register("p1_project", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def p1_project(spark, sf):
    cat = Catalog.for_dir(spark, sf)
    return S.select_table(cat, "lineitem", columns=["l_orderkey", "l_linenumber", "l_quantity"])


@register("p2_filter_dict", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def p2_filter_dict(spark, sf):
    cat = Catalog.for_dir(spark, sf)
    return S.select_table(
        cat, "orders",
        columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
        filters={"o_orderstatus": "P", "o_orderpriority": ["1-URGENT", "2-HIGH"],
                 "ignored": {"not": "a filter"}})


@register("p4_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""")
def p4_limit(spark, sf):
    cat = Catalog.for_dir(spark, sf)
    return S.select_table(cat, "orders", columns=["o_orderkey", "o_custkey", "o_totalprice"],
                          limit=100, order=["o_orderkey"])


@register("p5_browse", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_quantity > 45
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100""")
def p5_browse(spark, sf):
    df = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                          "l_suppkey", "l_quantity")
    return S.browse(df, "l_quantity > 45", size=100,
                    order=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@register("p6_date_range", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def p6_date_range(spark, sf):
    df = t(spark, sf, "orders")
    out = S.date_range(df, "o_orderdate", "1996-01-01 00:00:00", "1996-12-31 00:00:00",
                       tie=["o_orderkey"])
    return out.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@register("p7_search_name", """
SELECT p_partkey, p_name, p_brand FROM part WHERE p_name ILIKE '%RED%'""")
def p7_search_name(spark, sf):
    return S.search(t(spark, sf, "part"), "p_name", "%RED%").select("p_partkey", "p_name", "p_brand")


@register("p8_search_labeler", """
SELECT s_suppkey, s_name FROM supplier WHERE s_name ILIKE 'supplier#%1'""")
def p8_search_labeler(spark, sf):
    return S.search(t(spark, sf, "supplier"), "s_name", "supplier#%1").select("s_suppkey", "s_name")


@register("p9_recent", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 12 MONTH""")
def p9_recent(spark, sf):
    out = S.recent(t(spark, sf, "orders"), "o_orderdate", as_of="2001-08-01", months=12,
                   tie=["o_orderkey"])
    return out.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@register("p10_listing", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def p10_listing(spark, sf):
    return S.project(t(spark, sf, "part"),
                     ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])


@register("p11_drop_null_target", """
SELECT doc_id, quality FROM labels WHERE toxic <> 1""")
def p11_drop_null_target(spark, sf):
    df = t(spark, sf, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, F.lit(None)).otherwise(
            F.col("quality").cast("string")).alias("quality"))
    return S.drop_null_target(df, "quality", cast="int")


@register("p12_nan_to_null", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events""")
def p12_nan_to_null(spark, sf):
    df = t(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("value")).alias("value"))
    return S.nan_to_null_all(df)


@register("p13_decode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
       ELSE 'Unknown' END AS status_label FROM orders""")
def p13_decode(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.decode_column(df, "o_orderstatus", ORDER_STATUS, "Unknown",
                           alias="status_label").select("o_orderkey", "status_label")


@register("p14_display_date", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN 'N/A'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date
FROM orders""")
def p14_display_date(spark, sf):
    df = t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("raw"))
    return df.select("o_orderkey", display_date("raw").alias("order_date"))


@register("p15_newest_events", """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       coalesce(nullif(CASE WHEN event_type = 'view' THEN '' ELSE event_type END, ''),
                nullif(props, ''), 'N/A') AS product,
       CASE WHEN value > 100 THEN 'Yes' ELSE 'No' END AS serious_label
FROM events ORDER BY ts DESC, event_id LIMIT 20""")
def p15_newest_events(spark, sf):
    df = t(spark, sf, "events").select(
        "event_id", "event_type", "ts",
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
        .alias("medicinalproduct"),
        F.col("props").alias("brand_name"),
        (F.col("value") > 100).cast("int").alias("serious"))
    out = S.newest_events(df, "ts", n=20, tie=["event_id"],
                          columns=["event_id", "event_type", "ts"])
    return out.select("event_id", "event_type",
                      ts_text("ts").alias("ts_text"),
                      "product", "serious_label")


# ------------------------------------------------------------------ N2, N3, N9-N13
@register("n2_first_value", f"""
SELECT p_partkey,
       regexp_replace(string_split(p_name, ' ')[1], {WS_SQL}, '', 'g') AS first_word,
       regexp_replace(p_brand, {WS_SQL}, '', 'g') AS brand
FROM part""")
def n2_first_value(spark, sf):
    df = t(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"), "p_brand")
    words_t = df.schema["words"].dataType
    return df.select("p_partkey", first_value("words", words_t).alias("first_word"),
                     first_value("p_brand").alias("brand"))


@register("n3_strip_text", f"""
SELECT doc_id, regexp_replace(text, {WS_SQL}, '', 'g') AS text,
       length(regexp_replace(text, {WS_SQL}, '', 'g')) AS n_stripped
FROM documents""")
def n3_strip_text(spark, sf):
    df = t(spark, sf, "documents").select("doc_id", strip_ws("text").alias("text"))
    return df.select("doc_id", "text", F.length("text").alias("n_stripped"))


@register("n9_strip_reference", """
SELECT c_custkey, replace('Patient/' || CAST(c_custkey AS VARCHAR), 'Patient/', '') AS patient_id
FROM customer""")
def n9_strip_reference(spark, sf):
    df = t(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Patient/"), F.col("c_custkey").cast("string")).alias("ref"))
    return df.select("c_custkey", strip_prefix("ref").alias("patient_id"))


@register("n10_parse_timestamp", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS birth_ts
FROM orders""")
def n10_parse_timestamp(spark, sf):
    df = t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.replace(ts_text("o_orderdate"), F.lit(" "), F.lit("T"))).alias("txt"))
    return df.select("o_orderkey", ts_text(parse_timestamp("txt")).alias("birth_ts"))


# ------------------------------------------------------------------ A1-A15
@register("a1_age_histogram", """
SELECT CAST(round_even(CAST(p_size AS DOUBLE), 0) AS INTEGER) // 10 * 10 AS age_group,
       count(*) AS count
FROM part WHERE p_size IS NOT NULL GROUP BY 1""")
def a1_age_histogram(spark, sf):
    return A.age_histogram(t(spark, sf, "part"), "p_size", 10)


@register("a2_top_reactions", """
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
ORDER BY count DESC, event_type NULLS LAST LIMIT 10""")
def a2_top_reactions(spark, sf):
    return A.top_counts(t(spark, sf, "events"), "event_type", 10)


@register("a2_top_customers", """
SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey
ORDER BY count DESC, o_custkey NULLS LAST LIMIT 10""")
def a2_top_customers(spark, sf):
    return A.top_counts(t(spark, sf, "orders"), "o_custkey", 10)


@register("a3_top_products", """
SELECT lower(p_name) AS drug_name, count(*) AS count FROM part GROUP BY 1
ORDER BY count DESC, drug_name NULLS LAST LIMIT 10""")
def a3_top_products(spark, sf):
    return A.top_products(t(spark, sf, "part"), "p_name", 10)


@register("a4_reports_by_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS reports FROM orders GROUP BY 1""")
def a4_reports_by_month(spark, sf):
    df = t(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("receivedate"))
    return A.monthly_counts(df, "receivedate")


@register("a5_count_by_decoded", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status,
       count(*) AS count
FROM orders GROUP BY 1""")
def a5_count_by_decoded(spark, sf):
    return A.count_by_decoded(t(spark, sf, "orders"), "o_orderstatus", ORDER_STATUS,
                              "Unknown", alias="status")


@register("a6_count_by_route", """
SELECT p_type, count(*) AS drug_count FROM part GROUP BY p_type""")
def a6_count_by_route(spark, sf):
    return A.top_counts(t(spark, sf, "part"), "p_type", None, alias="drug_count")


@register("a7_count_by_form", """
SELECT p_brand, count(*) AS drug_count FROM part GROUP BY p_brand""")
def a7_count_by_form(spark, sf):
    return A.top_counts(t(spark, sf, "part"), "p_brand", None, alias="drug_count")


@register("a8_count_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS drug_count FROM orders GROUP BY 1""")
def a8_count_by_year(spark, sf):
    return A.count_by_year(t(spark, sf, "orders"), "o_orderdate")


@register("a9_group_summary", """
SELECT o_custkey, count(*) AS event_count,
       sum(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS serious_count,
       count(*) FILTER (WHERE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = 1) AS serious_true_count,
       min(strftime(o_orderdate, '%Y%m%d')) AS first_event,
       max(strftime(o_orderdate, '%Y%m%d')) AS last_event
FROM orders GROUP BY o_custkey
ORDER BY event_count DESC, o_custkey LIMIT 50""")
def a9_group_summary(spark, sf):
    df = t(spark, sf, "orders").select(
        "o_custkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("serious"),
        F.col("o_orderdate").alias("receivedate"))
    out = A.group_summary(df, ["o_custkey"], "serious", "receivedate", n=50)
    return out.withColumn("serious_count", F.col("serious_count").cast("bigint"))


@register("a9_flag_summary", """
SELECT l_returnflag, l_linestatus, count(*) AS event_count,
       sum(l_linenumber) AS serious_count,
       count(*) FILTER (WHERE l_linenumber = 1) AS serious_true_count,
       min(strftime(l_shipdate, '%Y%m%d')) AS first_event,
       max(strftime(l_shipdate, '%Y%m%d')) AS last_event
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a9_flag_summary(spark, sf):
    df = t(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_linenumber").alias("serious"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("receivedate"))
    out = A.group_summary(df, ["l_returnflag", "l_linestatus"], n=None)
    return out.withColumn("serious_count", F.col("serious_count").cast("bigint"))


@register("a10_trend", """
SELECT event_type AS group_key, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
       round(avg(value), 6) AS avg_value
FROM events GROUP BY 1, 2 ORDER BY date DESC, group_key LIMIT 500""")
def a10_trend(spark, sf):
    out = A.trend(t(spark, sf, "events"), "ts", "value", "event_type", 500, yyyymmdd=False)
    return out.select("group_key", F.date_format("date", "yyyy-MM-dd").alias("date"),
                      r6("avg_value").alias("avg_value"))


@register("a10_trend_yyyymmdd", """
SELECT o_orderpriority AS group_key, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS avg_value
FROM orders GROUP BY 1, 2 ORDER BY date DESC, group_key LIMIT 1000""")
def a10_trend_yyyymmdd(spark, sf):
    df = t(spark, sf, "orders").select(
        "o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd").alias("receivedate"),
        (F.col("o_orderstatus") == "F").cast("int").alias("serious"))
    out = A.trend(df, "receivedate", "serious", "o_orderpriority", 1000)
    return out.select("group_key", F.date_format("date", "yyyy-MM-dd").alias("date"),
                      r6("avg_value").alias("avg_value"))


def _daily_events(spark, sf):
    return A.daily_counts(t(spark, sf, "events"), "ts")


@register("a11_kpis", """
SELECT count(*) AS total_records, count(DISTINCT CAST(ts AS DATE)) AS unique_dates,
       strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS latest_date FROM events""")
def a11_kpis(spark, sf):
    k = A.kpis(_daily_events(spark, sf))
    return k.select(F.col("total_records").cast("bigint").alias("total_records"),
                    "unique_dates",
                    F.date_format("latest_date", "yyyy-MM-dd").alias("latest_date"))


@register("a12_daily_counts", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS count FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1""")
def a12_daily_counts(spark, sf):
    out = A.daily_counts(t(spark, sf, "events"), "ts", "2024-01-05", "2024-01-25")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "count")


@register("a13_category_counts", """
SELECT event_type AS category, count(*) AS count FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1""")
def a13_category_counts(spark, sf):
    return A.category_counts(t(spark, sf, "events"), "event_type", "ts", "2024-01-05", "2024-01-25")


@register("a14_profile", """
SELECT c.*, r.rows FROM (VALUES
  (1, 'o_orderkey', 'bigint', true), (2, 'o_custkey', 'bigint', true),
  (3, 'o_orderstatus', 'string', true), (4, 'o_totalprice', 'double', true),
  (5, 'o_orderdate', 'timestamp_ntz', true), (6, 'o_orderpriority', 'string', true))
  AS c(position, "column", type, nullable),
  (SELECT count(*) AS rows FROM orders) AS r""")
def a14_profile(spark, sf):
    return PR.profile(t(spark, sf, "orders"))


@register("a14_sample_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
ORDER BY o_orderkey LIMIT 5""")
def a14_sample_rows(spark, sf):
    """The profile's five sample rows, the first ones by key."""
    return PR.sample_rows(t(spark, sf, "orders").drop("o_orderdate"), 5, ["o_orderkey"])


@register("a15_class_check", """
SELECT count(*) AS rows, count(DISTINCT quality) AS classes,
       count(*) > 0 AND count(DISTINCT quality) >= 2 AS ok FROM labels""")
def a15_class_check(spark, sf):
    return PR.class_check(t(spark, sf, "labels"), "quality", 2)


# ------------------------------------------------------------------ W1-W5
@register("w1_rolling_mean", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS count
           FROM events GROUP BY 1, 2)
SELECT event_type, strftime(date, '%Y-%m-%d') AS date, count,
       round(CASE WHEN count(count) OVER w = 7 THEN avg(count) OVER w END, 6) AS rolling_avg
FROM d WINDOW w AS (PARTITION BY event_type ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def w1_rolling_mean(spark, sf):
    ev = t(spark, sf, "events")
    daily = (ev.groupBy("event_type", F.to_date("ts").alias("date"))
               .agg(F.count(F.lit(1)).alias("count")))
    out = W.rolling_mean(daily, "count", "date", 7, partition=["event_type"])
    return out.select("event_type", F.date_format("date", "yyyy-MM-dd").alias("date"),
                      "count", r6("rolling_avg").alias("rolling_avg"))


_MONTHLY_SQL = """
WITH m AS (SELECT o_orderpriority AS model, strftime(o_orderdate, '%Y-%m') AS ts,
                  avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS value
           FROM orders GROUP BY 1, 2)"""


def monthly_points(spark, sf):
    """Per priority and month: share of fulfilled orders (a metric history)."""
    o = t(spark, sf, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("model"),
                      F.date_format("o_orderdate", "yyyy-MM").alias("ts"))
             .agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("value")))


@register("w2_history_mean", _MONTHLY_SQL + """
SELECT model, ts, round(value, 6) AS value,
       round(avg(value) OVER (PARTITION BY model ORDER BY ts ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING), 6)
         AS historical_mean,
       count(value) OVER (PARTITION BY model ORDER BY ts ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING)
         AS n_history
FROM m""")
def w2_history_mean(spark, sf):
    out = W.history_mean(monthly_points(spark, sf), ["model"], "ts", "value", window=10)
    return out.select("model", "ts", r6("value").alias("value"),
                      r6("historical_mean").alias("historical_mean"), "n_history")


@register("w3_trend_label", _MONTHLY_SQL + """,
l AS (SELECT model, ts, value, lag(value, 1) OVER w AS p1, lag(value, 2) OVER w AS p2,
             row_number() OVER (PARTITION BY model ORDER BY ts DESC) AS rn
      FROM m WINDOW w AS (PARTITION BY model ORDER BY ts))
SELECT model, CASE WHEN p1 IS NOT NULL AND p2 IS NOT NULL AND p1 >= p2 AND value >= p1 THEN 'improving'
                   WHEN p1 IS NOT NULL AND p2 IS NOT NULL AND p1 <= p2 AND value <= p1 THEN 'declining'
                   ELSE 'stable' END AS trend
FROM l WHERE rn = 1""")
def w3_trend_label(spark, sf):
    return W.trend_label(monthly_points(spark, sf), ["model"], "ts", "value")


@register("w4_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1""")
def w4_keep_first(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                          "l_suppkey", "l_quantity")
    return D.keep_first(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@register("w5_latest_per_group", """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def w5_latest_per_group(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    out = D.latest_per_group(o, ["o_custkey"], "o_orderdate", tie=["o_orderkey"])
    return out.select("o_custkey", "o_orderkey",
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@register("w5_best_per_group", """
SELECT s_nationkey, s_suppkey, s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn
  FROM supplier WHERE s_acctbal IS NOT NULL) WHERE rn = 1""")
def w5_best_per_group(spark, sf):
    s = t(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return D.best_per_group(s, ["s_nationkey"], "s_acctbal", ascending=False, tie=["s_suppkey"])
