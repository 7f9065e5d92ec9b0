"""Nested-record flattening: safety reports (N1-N4) and FHIR bundles.

Explodes are narrow (no shuffle). The report flow shuffles the report ids, counted,
and the rows of reports that may repeat a key (``reports_to_events``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import parse_timestamp, strip_ws, first_value, strip_prefix
from ..schemas import EVENT_COLUMNS, RESOURCE_FIELDS
from ..session import ensure_checkpoint_dir
from .dedup import keep_first
from .small import small

DEDUP_KEYS = ["safetyreportid", "reaction", "medicinalproduct", "drugauthorizationnumb"]
DOCUMENT_COLS = ["_file", "_block", "_line", "_report_pos"]
ORDER_COLS = [*DOCUMENT_COLS, "_reaction_pos", "_drug_pos"]


def _reaction(r):
    """The reaction's name, stripped; an empty name is no name (NULL)."""
    return F.when(r["reactionmeddrapt"] == "", F.lit(None)).otherwise(strip_ws(r["reactionmeddrapt"]))


def _text(c):
    return strip_ws(F.coalesce(c, F.lit("")))


def flatten_reports(reports: DataFrame, keep_order: bool = True) -> DataFrame:
    """One row per (report, reaction, drug), reactions x drugs per report.

    Input: rows from ``read_report_files`` (report fields and the
    document's place). A report with no reactions or no drugs gives no rows
    (``explode``, not ``explode_outer``). Text fields are whitespace-stripped;
    a missing product/authorization becomes '' like the reference's default;
    the drug-label list fields keep their first item (N2).
    """
    for c in DOCUMENT_COLS:
        if c not in reports.columns:
            reports = reports.withColumn(c, F.lit("" if c == "_file" else 0))
    label_t = (reports.schema["patient"].dataType["drug"].dataType
                 .elementType["openfda"].dataType)
    r = reports.select(
        *DOCUMENT_COLS, "safetyreportid", "receivedate", "serious",
        F.col("patient.patientonsetage").alias("patientonsetage"),
        F.col("patient.patientsex").alias("patientsex"),
        F.col("patient.drug").alias("_drugs"),
        F.posexplode("patient.reaction").alias("_reaction_pos", "_reaction"))
    r = r.select("*", F.posexplode("_drugs").alias("_drug_pos", "_drug"))

    def of(field):
        return first_value(F.col("_drug.openfda")[field], label_t[field].dataType)

    out = r.select(
        "safetyreportid", "receivedate", "serious", "patientonsetage", "patientsex",
        _reaction(F.col("_reaction")).alias("reaction"),
        _text(F.col("_drug.medicinalproduct")).alias("medicinalproduct"),
        _text(F.col("_drug.drugauthorizationnumb")).alias("drugauthorizationnumb"),
        of("brand_name").alias("brand_name"),
        of("manufacturer_name").alias("manufacturer_name"),
        of("product_ndc").alias("product_ndc"),
        *[F.col(c) for c in ORDER_COLS])
    return out if keep_order else out.drop(*ORDER_COLS)


def dedup_events(events: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """Keep the first row per key in file/report/reaction/drug order."""
    return keep_first(events, keys, ORDER_COLS).select(*EVENT_COLUMNS)


def _all_differ(items):
    return F.size(F.array_distinct(items)) == F.size(items)


def _no_repeats():
    """Whether a report's reactions all differ, and its drugs by product and authorization: its rows
    are all pairs of the two, so none has the key of another. Arrays of texts are compared by hashing."""
    def drug(d):
        product = _text(d["medicinalproduct"])  # its length in front tells where it ends
        return F.concat_ws(":", F.length(product).cast("string"), product, _text(d["drugauthorizationnumb"]))

    differ = _all_differ(F.transform("patient.reaction", _reaction)) & _all_differ(F.transform("patient.drug", drug))
    return F.coalesce(differ, F.lit(False))


def reports_to_events(reports: DataFrame) -> DataFrame:
    """N1 + N4: the safety-report transform.

    The keys begin with the report id, so two rows share one only within a report that repeats a reaction
    or a drug, or among reports of one id. The rows of all other reports are first of their keys
    as they are; only the rest is shuffled and ranked. Ids are counted first, in a job of its own.
    """
    ensure_checkpoint_dir(reports.sparkSession)
    again = (reports.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select(F.col("safetyreportid").alias("_id"), F.lit(True).alias("_again")).checkpoint(eager=True))
    known = reports.join(small(again), F.col("safetyreportid").eqNullSafe(F.col("_id")), "left")
    alone = F.col("_again").isNull() & _no_repeats()
    return (flatten_reports(known.where(alone)).select(*EVENT_COLUMNS)
            .unionByName(dedup_events(flatten_reports(known.where(~alone)))))


# ------------------------------------------------------------------ FHIR
def explode_resources(bundles: DataFrame) -> DataFrame:
    """One row per bundle entry: ``_file``, ``_entry_pos`` and the resource."""
    file_col = F.col("_file") if "_file" in bundles.columns else F.lit("")
    return (bundles.select(file_col.alias("_file"),
                           F.posexplode("entry").alias("_entry_pos", "_e"))
                   .select("_file", "_entry_pos", "_e.resource.*"))


def _ref(c):
    return F.col(c)["reference"]


#: The flat table of each resource kind: its name, and the columns it takes from a resource.
_TABLES = {
    "Patient": ("patients", lambda: ["id", "gender", "birthDate"]),
    "Encounter": ("encounters", lambda: ["id", _ref("subject").alias("patient"), F.col("period.start").alias("start"),
                                         F.col("period.end").alias("end")]),
    "Condition": ("conditions", lambda: ["id", _ref("subject").alias("patient"), F.col("code.text").alias("code")]),
    "Observation": ("observations", lambda: ["id", _ref("subject").alias("patient"), F.col("code.text").alias("code"),
                                             F.col("valueQuantity.value").alias("value")]),
    "MedicationRequest": ("medications", lambda: ["id", _ref("subject").alias("patient"),
                                                  F.col("medicationCodeableConcept.text").alias("medication")]),
}
RESOURCE_KINDS = list(_TABLES)


def fhir_tables(resources: DataFrame) -> dict[str, DataFrame]:
    """The flat tables from exploded resources (missing -> NULL): all five, or those of
    the kinds whose fields were read (``schemas.bundle``).

    ``resources`` should be materialized once (``stage_resources``) when several
    are computed, so the JSON is parsed a single time.
    """
    return {name: resources.where(F.col("resourceType") == kind).select(*columns())
            for kind, (name, columns) in _TABLES.items()
            if set(RESOURCE_FIELDS[kind]) <= set(resources.columns)}


def stage_resources(resources: DataFrame, path: str) -> DataFrame:
    """Write exploded resources once, partitioned by kind, and read them back.

    Each of the five derived tables then scans only its own partition
    (partition pruning) instead of re-parsing every bundle.
    """
    resources.write.mode("overwrite").partitionBy("resourceType").parquet(path)
    return resources.sparkSession.read.parquet(path)


def _first(arr_col):
    return F.try_element_at(arr_col, F.lit(1))


def patient_view(resources: DataFrame) -> DataFrame:
    """Dashboard patients: first/last name, gender, birthdate, 'city, state'."""
    name0 = _first(F.col("name"))
    addr0 = _first(F.col("address"))
    given = name0["given"]
    return resources.where(F.col("resourceType") == "Patient").select(
        "id",
        F.when(F.size(F.coalesce(given, F.array())) > 0, F.array_join(given, " "))
         .otherwise(F.lit("")).alias("first"),
        F.coalesce(name0["family"], F.lit("")).alias("last"),
        "gender",
        F.col("birthDate").alias("birthdate"),
        F.concat(F.coalesce(addr0["city"], F.lit("")), F.lit(", "),
                 F.coalesce(addr0["state"], F.lit(""))).alias("address"))


def condition_view(resources: DataFrame) -> DataFrame:
    """Dashboard conditions: first coding code/display, onset, status."""
    c0 = _first(F.col("code.coding"))
    s0 = _first(F.col("clinicalStatus.coding"))
    return resources.where(F.col("resourceType") == "Condition").select(
        "id",
        strip_prefix(F.coalesce(_ref("subject"), F.lit(""))).alias("patient_id"),
        c0["code"].alias("code"), c0["display"].alias("display"),
        "onsetDateTime", s0["code"].alias("clinicalStatus"))


def medication_view(resources: DataFrame) -> DataFrame:
    """Dashboard medications: first coding code/display, authoredOn, status."""
    m0 = _first(F.col("medicationCodeableConcept.coding"))
    return resources.where(F.col("resourceType") == "MedicationRequest").select(
        "id",
        strip_prefix(F.coalesce(_ref("subject"), F.lit(""))).alias("patient_id"),
        m0["code"].alias("medication_code"), m0["display"].alias("medication_display"),
        "authoredOn", "status")


def patients_table(resources: DataFrame) -> DataFrame:
    """N5 patient-only twin + N10: birthDate parsed to a timestamp."""
    return (resources.where(F.col("resourceType") == "Patient")
            .select("id", "gender", parse_timestamp("birthDate").alias("birthDate")))
