"""ETL flows: safety-report documents and FHIR bundles.

Nested inputs are built from the driver tables (reports from orders with
their lineitems as drugs; bundles from orders + customer), written to a fresh
folder under the session's shared checkpoint dir, and read back through the
sources, so every query exercises the real file paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import schemas
from ..functions.dates import ts_text
from ..operators import flatten as FL
from ..sources import files as FS
from ..sources.tables import save_table
from .registry import fresh_dir, register, shared_input, t


def _str(c):
    return F.col(c).cast("string")


def nested_reports(spark, sf) -> DataFrame:
    """Orders as safety reports: two reactions (priority, status with stray
    whitespace), one drug per lineitem sorted by (linenumber, partkey,
    suppkey). Orders without lineitems get an empty drug list. A report is one
    record of the source, so an order's lines are gathered whatever their number."""
    li = t(spark, sf, "lineitem")
    drug = F.struct(
        F.concat(F.lit(" part-"), _str("l_partkey"), F.lit(" ")).alias("medicinalproduct"),
        _str("l_suppkey").alias("drugauthorizationnumb"),
        F.struct(F.array(F.col("l_returnflag")).alias("brand_name"),
                 F.array().cast(ArrayType(StringType())).alias("manufacturer_name"),
                 F.array(F.concat_ws("-", _str("l_linenumber"), F.col("l_linestatus")))
                 .alias("product_ndc")).alias("openfda"))
    drugs = (li.groupBy("l_orderkey")
               .agg(F.array_sort(F.collect_list(F.struct(
                   F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("k"),
                   drug.alias("d")))).alias("items"))
               .select(F.col("l_orderkey").alias("o_orderkey"),
                       F.transform("items", lambda x: x["d"]).alias("drugs")))
    o = t(spark, sf, "orders").join(drugs, "o_orderkey", "left")
    drug_t = schemas.PATIENT["drug"].dataType
    return o.select(
        _str("o_orderkey").alias("safetyreportid"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("receivedate"),
        F.substring("o_orderpriority", 1, 1).alias("serious"),
        F.struct(
            (F.col("o_custkey") % 100).cast("string").alias("patientonsetage"),
            F.col("o_orderstatus").alias("patientsex"),
            F.array(F.struct(F.col("o_orderpriority").alias("reactionmeddrapt")),
                    F.struct(F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("\t"))
                             .alias("reactionmeddrapt"))).alias("reaction"),
            F.coalesce(F.col("drugs"), F.array().cast(drug_t)).cast(drug_t).alias("drug"),
        ).alias("patient"))


def report_documents(spark, sf) -> str:
    """The nested reports as ``{"results": [...]}`` documents, written once per application."""
    return shared_input(spark, sf, "reports", lambda path: FS.write_report_documents(nested_reports(spark, sf), path))


_REPORT_SQL = """
WITH n AS (SELECT l_orderkey, count(*) AS n_drugs FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, strftime(o_orderdate, '%Y%m%d') AS receivedate,
       substr(o_orderpriority, 1, 1) AS serious, CAST(o_custkey % 100 AS VARCHAR) AS patientonsetage,
       o_orderstatus AS patientsex, 2 AS n_reactions, coalesce(n.n_drugs, 0) AS n_drugs
FROM orders LEFT JOIN n ON n.l_orderkey = o_orderkey"""


@register("s1_report_source", _REPORT_SQL)
def s1_report_source(spark, sf):
    rep = FS.read_report_files(spark, report_documents(spark, sf))
    return rep.select(
        "safetyreportid", "receivedate", "serious",
        F.col("patient.patientonsetage").alias("patientonsetage"),
        F.col("patient.patientsex").alias("patientsex"),
        F.size("patient.reaction").alias("n_reactions"),
        F.size("patient.drug").cast("bigint").alias("n_drugs"))


_EVENTS_SQL = """
WITH li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey
                                         ORDER BY l_linenumber) AS rn FROM lineitem),
r AS (SELECT o_orderkey AS k, 0 AS rpos, o_orderpriority AS reaction FROM orders
      UNION ALL SELECT o_orderkey, 1, o_orderstatus FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, strftime(o_orderdate, '%Y%m%d') AS receivedate,
       substr(o_orderpriority, 1, 1) AS serious, CAST(o_custkey % 100 AS VARCHAR) AS patientonsetage,
       o_orderstatus AS patientsex, r.reaction,
       'part-' || CAST(l_partkey AS VARCHAR) AS medicinalproduct,
       CAST(l_suppkey AS VARCHAR) AS drugauthorizationnumb,
       l_returnflag AS brand_name, CAST(NULL AS VARCHAR) AS manufacturer_name,
       CAST(l_linenumber AS VARCHAR) || '-' || l_linestatus AS product_ndc
FROM orders JOIN r ON r.k = o_orderkey JOIN li ON li.l_orderkey = o_orderkey AND li.rn = 1"""


@register("etl_report_events", _EVENTS_SQL)
def etl_report_events(spark, sf):
    """S1 -> N1 -> N2/N3 -> N4: the safety-report transform."""
    rep = FS.read_report_files(spark, report_documents(spark, sf))
    return FL.reports_to_events(rep)


@register("n1_flatten_reports", """
WITH r AS (SELECT o_orderkey AS k, o_orderpriority AS reaction FROM orders
           UNION ALL SELECT o_orderkey, o_orderstatus FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, r.reaction,
       'part-' || CAST(l_partkey AS VARCHAR) AS medicinalproduct,
       CAST(l_suppkey AS VARCHAR) AS drugauthorizationnumb,
       CAST(l_linenumber AS VARCHAR) || '-' || l_linestatus AS product_ndc
FROM orders JOIN r ON r.k = o_orderkey JOIN lineitem ON l_orderkey = o_orderkey""")
def n1_flatten_reports(spark, sf):
    """N1 alone (no dedup): one row per reaction x drug of each report."""
    rep = FS.read_report_files(spark, report_documents(spark, sf))
    return FL.flatten_reports(rep).select("safetyreportid", "reaction", "medicinalproduct",
                                          "drugauthorizationnumb", "product_ndc")


@register("n4_dedup_keep_first", """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                               ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def n4_dedup_keep_first(spark, sf):
    li = t(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey",
                                          "l_linenumber", "l_quantity")
    return FL.keep_first(li, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])


@register("s9_save_table_replace", """
SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def s9_save_table_replace(spark, sf):
    """The table is saved twice in replace mode; the read-back holds one copy."""
    path = fresh_dir(spark, "nation_table")
    nation = t(spark, sf, "nation")
    save_table(nation, path)
    n = save_table(nation, path)
    assert n == nation.count()
    return spark.read.parquet(path)


@register("s3_csv_roundtrip", """
SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_name END AS n_name, n_regionkey
FROM nation""")
def s3_csv_roundtrip(spark, sf):
    """S7 writes CSV (empty text as an empty field); S3 reads it back with a
    schema, where empty fields become NULL."""
    path = fresh_dir(spark, "nation_csv")
    nation = t(spark, sf, "nation")
    df = nation.select("n_nationkey",
                       F.when(F.col("n_regionkey") == 0, F.lit("")).otherwise(F.col("n_name"))
                       .alias("n_name"), "n_regionkey")
    FS.write_csv(df, path)
    return FS.read_csv(spark, path, nation.schema)


@register("s2_json_props", """
SELECT event_id, CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS INTEGER) AS k FROM events""")
def s2_json_props(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@register("s2_ndjson_skip_bad", """
SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'""")
def s2_ndjson_skip_bad(spark, sf):
    """NDJSON with malformed lines (every 'error' event): they are skipped."""
    path = fresh_dir(spark, "events_ndjson")
    ev = t(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    ev.select(F.when(F.col("event_type") == "error", F.concat(F.lit("{oops "), line))
              .otherwise(line).alias("value")).write.mode("overwrite").text(path)
    schema = ev.select("event_id", "event_type", "value").schema
    return FS.read_json(spark, path, schema, layout="ndjson")


ARRAY_ROWS = 5000  # records of a JSON array; a document is parsed as a whole


def write_arrays(df: DataFrame, path: str, key: str, rows: int = ARRAY_ROWS) -> None:
    """``df`` as JSON arrays of about ``rows`` records, an array per file and a record per line."""
    n = max(1, -(-df.count() // rows))
    by = Window.partitionBy("file").orderBy("k")
    d = df.select(F.pmod(F.xxhash64(key), F.lit(n)).alias("file"), F.col(key).alias("k"), F.to_json(F.struct(*df.columns)).alias("j"))
    first, last = F.lag("k").over(by).isNull(), F.lead("k").over(by).isNull()
    d = d.select("file", "k", F.concat(F.when(first, "[").otherwise(" "), "j", F.when(last, "]").otherwise(",")).alias("value"))
    d.sortWithinPartitions("file", "k").select("file", "value").write.partitionBy("file").text(path)


def write_objects(df: DataFrame, path: str) -> None:
    """Every row as a file of its own that holds one object over several lines."""
    key = df.columns[0]
    df.select(F.col(key).alias("file"), F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value")) \
        .write.partitionBy("file").text(path)


def _nation_totals(spark, sf) -> DataFrame:
    c = t(spark, sf, "customer")
    return c.groupBy(F.col("c_nationkey").cast("long").alias("c_custkey")).agg(
        F.concat(F.lit("nation "), F.first("c_nationkey").cast("string")).alias("c_name"),
        F.count(F.lit(1)).alias("c_nationkey"), F.round(F.sum("c_acctbal"), 2).alias("c_acctbal"),
        F.max("c_mktsegment").alias("c_mktsegment"))


_NATION_SQL = """
SELECT CAST(c_nationkey AS BIGINT) AS c_custkey, 'nation ' || CAST(c_nationkey AS VARCHAR) AS c_name,
       count(*) AS c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal, max(c_mktsegment) AS c_mktsegment
FROM customer GROUP BY customer.c_nationkey"""


@register("s2_json_arrays", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s2_json_arrays(spark, sf):
    """JSON arrays over many lines, found by their first line."""
    path, cust = fresh_dir(spark, "arrays"), t(spark, sf, "customer")
    write_arrays(cust, path, "c_custkey")
    return FS.read_json(spark, f"{path}/file=*", cust.schema)


@register("s2_json_objects", _NATION_SQL)
def s2_json_objects(spark, sf):
    """Pretty-printed objects, one per file."""
    path, totals = fresh_dir(spark, "objects"), _nation_totals(spark, sf)
    write_objects(totals, path)
    return FS.read_json(spark, f"{path}/file=*", totals.schema)


@register("s2_json_mixed_folder", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL (""" + _NATION_SQL + ")")
def s2_json_mixed_folder(spark, sf):
    """Arrays, pretty objects and NDJSON under one path; every file is read by its own layout. Malformed
    lines, one of them the first of its file, are skipped."""
    path, cust, totals = fresh_dir(spark, "mixed"), t(spark, sf, "customer"), _nation_totals(spark, sf)
    odd = F.col("c_custkey") % 2 == 1
    write_arrays(cust.where(odd), f"{path}/arrays", "c_custkey")
    write_objects(totals, f"{path}/objects")
    whole = F.to_json(F.struct(*cust.columns))
    lines = cust.where(~odd).select(F.explode(F.array(F.substring(whole, 1, 20), whole)).alias("value"))
    lines.write.text(f"{path}/lines/file=0")
    return FS.read_json(spark, f"{path}/*/file=*", totals.schema)


@register("s5_by_suffix_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s5_by_suffix_csv(spark, sf):
    base = fresh_dir(spark, "resources")
    cust = t(spark, sf, "customer")
    FS.write_csv(cust, f"{base}/customer")
    return FS.read_resource(spark, "customer", base, cust.schema)


@register("s5_by_suffix_ndjson", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s5_by_suffix_ndjson(spark, sf):
    base = fresh_dir(spark, "resources")
    cust = t(spark, sf, "customer")
    FS.write_json(cust, f"{base}/customer.ndjson")
    return FS.read_resource(spark, "customer", base, cust.schema)


# ------------------------------------------------------------------ FHIR
def _iso(c):
    return F.date_format(c, "yyyy-MM-dd")


def nested_bundles(spark, sf) -> DataFrame:
    """One FHIR-like bundle per order: the customer as Patient, plus Encounter,
    Condition, Observation and MedicationRequest."""
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    pid = F.concat(F.lit("c"), _str("c_custkey"))
    subject = F.struct(F.concat(F.lit("Patient/"), pid).alias("reference"))
    key = _str("o_orderkey")
    coding = F.when(F.col("o_orderstatus") == "P", F.array())
    code_t = schemas.RESOURCE["code"].dataType
    patient = F.struct(
        F.lit("Patient").alias("resourceType"), pid.alias("id"),
        F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male").alias("gender"),
        _iso(F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")))
        .alias("birthDate"),
        F.array(F.struct(F.split("c_name", "#").alias("given"),
                         F.col("c_mktsegment").alias("family"))).alias("name"),
        F.array(F.struct(F.concat(F.lit("City"), _str("c_nationkey")).alias("city"),
                         F.when(F.col("c_nationkey") % 3 == 0, F.lit(None))
                         .otherwise(F.lit("ST")).alias("state"))).alias("address"))
    encounter = F.struct(
        F.lit("Encounter").alias("resourceType"), F.concat(F.lit("e"), key).alias("id"),
        subject.alias("subject"),
        F.struct(_iso("o_orderdate").alias("start"),
                 _iso(F.date_add(F.to_date("o_orderdate"), 1)).alias("end")).alias("period"))
    condition = F.struct(
        F.lit("Condition").alias("resourceType"), F.concat(F.lit("cond"), key).alias("id"),
        subject.alias("subject"), _iso("o_orderdate").alias("onsetDateTime"),
        F.struct(F.col("o_orderpriority").alias("text"),
                 coding.otherwise(F.array(F.struct(F.col("o_orderstatus").alias("code"),
                                                   F.col("o_orderpriority").alias("display"))))
                 .alias("coding")).alias("code"),
        F.struct(F.array(F.struct(F.when(F.col("o_orderstatus") == "F", "resolved")
                                  .otherwise("active").alias("code"))).alias("coding"))
        .alias("clinicalStatus"))
    observation = F.struct(
        F.lit("Observation").alias("resourceType"), F.concat(F.lit("obs"), key).alias("id"),
        subject.alias("subject"), F.struct(F.lit("total").alias("text"), F.array().cast(code_t["coding"].dataType).alias("coding")).alias("code"),
        F.struct(F.col("o_totalprice").alias("value")).alias("valueQuantity"))
    med_name = F.concat(F.lit("Drug-"), (F.col("o_custkey") % 50).cast("string"))
    medication = F.struct(
        F.lit("MedicationRequest").alias("resourceType"), F.concat(F.lit("med"), key).alias("id"),
        subject.alias("subject"), _iso("o_orderdate").alias("authoredOn"),
        F.when(F.col("o_orderstatus") == "F", "stopped").otherwise("active").alias("status"),
        F.struct(med_name.alias("text"),
                 coding.otherwise(F.array(F.struct(F.col("o_orderpriority").alias("code"),
                                                   med_name.alias("display"))))
                 .alias("coding")).alias("medicationCodeableConcept"))
    def entry(r, kind):
        """The resource in the struct of all kinds; a JSON writer leaves its NULL fields out."""
        return F.struct(F.struct(*[(r[f.name] if f.name in names[kind] else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in schemas.RESOURCE]).alias("resource"))

    made = {"Patient": patient, "Encounter": encounter, "Condition": condition, "Observation": observation,
            "MedicationRequest": medication}
    j = j.select("o_orderkey", "o_orderstatus", *[r.alias(kind) for kind, r in made.items()])
    names = {kind: j.schema[kind].dataType.fieldNames() for kind in made}
    return j.select("o_orderkey", "o_orderstatus", F.lit("Bundle").alias("resourceType"),
                    F.array(*[entry(F.col(kind), kind) for kind in made]).alias("entry"))


def fhir_folder(spark, sf) -> str:
    """The bundles as ``*.json.gz`` files, one bundle per line, written once per application."""
    return shared_input(spark, sf, "fhir", lambda path: FS.write_records(nested_bundles(spark, sf).select("resourceType", "entry"), path))


def parsed_resources(spark, sf, *kinds) -> DataFrame:
    """Resources of the given kinds from the FHIR directory source (S4); other fields are not parsed."""
    return FL.explode_resources(FS.read_fhir_dir(spark, fhir_folder(spark, sf), multi_line=False, kinds=kinds or None))


def staged_resources(spark, sf) -> DataFrame:
    """All kinds from one pass over the bundles, stored by kind; each table then reads its own part."""
    path = shared_input(spark, sf, "fhir-staged", lambda path: FL.stage_resources(parsed_resources(spark, sf), path))
    return spark.read.parquet(path)


_FHIR_BASE = """
WITH b AS (SELECT o.*, c.* FROM orders o JOIN customer c ON o_custkey = c_custkey)"""


@register("n5_patients", _FHIR_BASE + """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') AS birthDate
FROM b""")
def n5_patients(spark, sf):
    return FL.fhir_tables(parsed_resources(spark, sf, "Patient"))["patients"]


@register("n5_encounters", _FHIR_BASE + """
SELECT 'e' || CAST(o_orderkey AS VARCHAR) AS id, 'Patient/c' || CAST(c_custkey AS VARCHAR) AS patient,
       strftime(o_orderdate, '%Y-%m-%d') AS start,
       strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%d') AS "end"
FROM b""")
def n5_encounters(spark, sf):
    return FL.fhir_tables(staged_resources(spark, sf))["encounters"]


@register("n5_conditions", _FHIR_BASE + """
SELECT 'cond' || CAST(o_orderkey AS VARCHAR) AS id, 'Patient/c' || CAST(c_custkey AS VARCHAR) AS patient,
       o_orderpriority AS code FROM b""")
def n5_conditions(spark, sf):
    return FL.fhir_tables(staged_resources(spark, sf))["conditions"]


@register("n5_observations", _FHIR_BASE + """
SELECT 'obs' || CAST(o_orderkey AS VARCHAR) AS id, 'Patient/c' || CAST(c_custkey AS VARCHAR) AS patient,
       'total' AS code, o_totalprice AS value FROM b""")
def n5_observations(spark, sf):
    return FL.fhir_tables(staged_resources(spark, sf))["observations"]


@register("n5_medications", _FHIR_BASE + """
SELECT 'med' || CAST(o_orderkey AS VARCHAR) AS id, 'Patient/c' || CAST(c_custkey AS VARCHAR) AS patient,
       'Drug-' || CAST(o_custkey % 50 AS VARCHAR) AS medication FROM b""")
def n5_medications(spark, sf):
    return FL.fhir_tables(staged_resources(spark, sf))["medications"]


@register("n6_patient_view", _FHIR_BASE + """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, array_to_string(string_split(c_name, '#'), ' ') AS first,
       c_mktsegment AS last, CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') AS birthdate,
       'City' || CAST(c_nationkey AS VARCHAR) || ', ' || CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE 'ST' END
         AS address
FROM b""")
def n6_patient_view(spark, sf):
    return FL.patient_view(parsed_resources(spark, sf, "Patient"))


@register("n7_condition_view", _FHIR_BASE + """
SELECT 'cond' || CAST(o_orderkey AS VARCHAR) AS id, 'c' || CAST(c_custkey AS VARCHAR) AS patient_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS code,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS display,
       strftime(o_orderdate, '%Y-%m-%d') AS onsetDateTime,
       CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'active' END AS clinicalStatus
FROM b""")
def n7_condition_view(spark, sf):
    return FL.condition_view(parsed_resources(spark, sf, "Condition"))


@register("n8_medication_view", _FHIR_BASE + """
SELECT 'med' || CAST(o_orderkey AS VARCHAR) AS id, 'c' || CAST(c_custkey AS VARCHAR) AS patient_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS medication_code,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Drug-' || CAST(o_custkey % 50 AS VARCHAR) END
         AS medication_display,
       strftime(o_orderdate, '%Y-%m-%d') AS authoredOn,
       CASE WHEN o_orderstatus = 'F' THEN 'stopped' ELSE 'active' END AS status
FROM b""")
def n8_medication_view(spark, sf):
    return FL.medication_view(parsed_resources(spark, sf, "MedicationRequest"))


@register("n10_patients_birthdate", _FHIR_BASE + """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS birthDate
FROM b""")
def n10_patients_birthdate(spark, sf):
    p = FL.patients_table(parsed_resources(spark, sf, "Patient"))
    return p.select("id", "gender", ts_text("birthDate").alias("birthDate"))


@register("s4_fhir_directory", _FHIR_BASE + """
SELECT 'e' || CAST(o_orderkey AS VARCHAR) AS id, 'Patient/c' || CAST(c_custkey AS VARCHAR) AS patient
FROM b WHERE o_orderstatus <> 'P'""")
def s4_fhir_directory(spark, sf):
    """Bundles in kept files and in skip-listed ones, told apart by file name; staged once
    (N5 staging) and the encounters derived from the staged resources."""
    base = fresh_dir(spark, "fhir")
    b = nested_bundles(spark, sf)
    skipped = F.col("o_orderstatus") == "P"
    FS.write_records(b.where(~skipped).select("resourceType", "entry"), base)
    FS.write_records(b.where(skipped).select("resourceType", "entry"), base, "append",
                     **{"mapreduce.output.basename": "hospitalInformation"})
    bundles = FS.read_fhir_dir(spark, base, multi_line=False)
    staged = FL.stage_resources(FL.explode_resources(bundles), fresh_dir(spark, "fhir_staged"))
    return FL.fhir_tables(staged)["encounters"].select("id", "patient")


# ------------------------------------------------------------------ dashboard on the ETL output
# The dashboard queries (A1-A5, A9, A10) run over the flat safety-event
# table produced above: text-typed fields, exactly as the flow stores them.
_EV = "WITH ev AS (" + _EVENTS_SQL + ")\n"


def _events(spark, sf):
    return etl_report_events(spark, sf)


@register("etl_age_histogram", _EV + """
SELECT CAST(round_even(TRY_CAST(patientonsetage AS DOUBLE), 0) AS INTEGER) // 10 * 10 AS age_group,
       count(*) AS count
FROM ev WHERE TRY_CAST(patientonsetage AS DOUBLE) IS NOT NULL GROUP BY 1""")
def etl_age_histogram(spark, sf):
    from ..operators.aggregates import age_histogram
    return age_histogram(_events(spark, sf), "patientonsetage")


@register("etl_top_reactions", _EV + """
SELECT reaction, count(*) AS count FROM ev GROUP BY reaction
ORDER BY count DESC, reaction NULLS LAST LIMIT 10""")
def etl_top_reactions(spark, sf):
    from ..operators.aggregates import top_counts
    return top_counts(_events(spark, sf), "reaction", 10)


@register("etl_top_products", _EV + """
SELECT lower(medicinalproduct) AS drug_name, count(*) AS count FROM ev GROUP BY 1
ORDER BY count DESC, drug_name NULLS LAST LIMIT 10""")
def etl_top_products(spark, sf):
    from ..operators.aggregates import top_products
    return top_products(_events(spark, sf))


@register("etl_reports_by_month", _EV + """
SELECT strftime(strptime(receivedate, '%Y%m%d'), '%Y-%m') AS month, count(*) AS reports FROM ev GROUP BY 1""")
def etl_reports_by_month(spark, sf):
    from ..operators.aggregates import monthly_counts
    return monthly_counts(_events(spark, sf))


@register("etl_sex_distribution", _EV + """
SELECT CASE patientsex WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' ELSE 'Unknown' END AS sex,
       count(*) AS count FROM ev GROUP BY 1""")
def etl_sex_distribution(spark, sf):
    from ..operators.aggregates import count_by_decoded
    return count_by_decoded(_events(spark, sf))


@register("etl_demographic_summary", _EV + """
SELECT patientonsetage, patientsex, count(*) AS event_count,
       sum(TRY_CAST(serious AS BIGINT)) AS serious_count,
       count(*) FILTER (WHERE TRY_CAST(serious AS BIGINT) = 1) AS serious_true_count,
       min(receivedate) AS first_event, max(receivedate) AS last_event
FROM ev GROUP BY patientonsetage, patientsex
ORDER BY event_count DESC, patientonsetage NULLS LAST, patientsex NULLS LAST LIMIT 50""")
def etl_demographic_summary(spark, sf):
    from ..operators.aggregates import group_summary
    return group_summary(_events(spark, sf), ["patientonsetage", "patientsex"], n=50)


@register("etl_trend", _EV + """
SELECT patientsex AS group_key, strftime(strptime(receivedate, '%Y%m%d'), '%Y-%m-%d') AS date,
       round(avg(TRY_CAST(serious AS DOUBLE)), 6) AS avg_value
FROM ev GROUP BY 1, 2 ORDER BY date DESC, group_key LIMIT 500""")
def etl_trend(spark, sf):
    from ..operators.aggregates import trend
    from .registry import r6
    out = trend(_events(spark, sf))  # defaults: receivedate / serious / patientsex, limit 500
    return out.select("group_key", F.date_format("date", "yyyy-MM-dd").alias("date"),
                      r6("avg_value").alias("avg_value"))
