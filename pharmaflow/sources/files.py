"""File sources and sinks: report documents, JSON/NDJSON, CSV, FHIR bundles.

All reads use explicit schemas (no inference pass over the data). File
listing for the suffix dispatch (S5) goes through the Hadoop FileSystem of the
session so it works the same on local disk and on shared cluster storage.
"""

from __future__ import annotations

import logging
import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, StringType

from .. import schemas

log = logging.getLogger(__name__)

READ_ERRORS = (PySparkException, Py4JJavaError)  # what a failed read raises

# Bundle files with these names hold no patient data and are
# skipped when a FHIR directory is read.
FHIR_SKIP_NAMES = ["hospitalInformation", "practitionerInformation"]

# Sample patients used when no patients file exists.
SAMPLE_PATIENTS = [
    ("patient-1", "1970-01-01", "female"),
    ("patient-2", "1985-05-12", "male"),
]

RECORDS_A_FILE = 100_000  # of a compressed file, which one task reads

JSON_SUFFIXES = (".json", ".ndjson", ".ndjsonl")
CSV_SUFFIXES = (".csv",)


def _strict_json(spark: SparkSession, path, schema: StructType, on_bad: str = "raise",
                 bad_records=None, **options) -> DataFrame:
    """JSON whose malformed records raise (``on_bad="raise"``) or are skipped and
    counted as ``bad_lines`` of an Observation (``"skip"``)."""
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad is raise or skip, not {on_bad}")
    if on_bad == "raise":
        return spark.read.schema(schema).options(mode="FAILFAST", **options).json(path)
    corrupt = "_corrupt_record"
    wide = StructType(list(schema.fields) + [StructField(corrupt, StringType(), True)])
    df = spark.read.schema(wide).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, **options).json(path)
    if bad_records is not None:
        df = df.observe(bad_records, F.count_if(F.col(corrupt).isNotNull()).alias("bad_lines"))
    return df.where(F.col(corrupt).isNull()).drop(corrupt)


# ---------------------------------------------------------------- S1
def read_report_files(spark: SparkSession, path: str,
                      report_schema: StructType = schemas.REPORT,
                      multi_line: bool = False, on_bad: str = "raise",
                      bad_records=None) -> DataFrame:
    """Report documents ``{"results": [report, ...]}`` -> one row per report.

    Adds ``_file`` (source path), ``_block`` and ``_line`` (the document's place in
    the file: where its split starts, and an id that grows within the split) and
    ``_report_pos`` (0-based position in ``results``): together the order of the
    documents, for a later keep-first dedup.
    ``multi_line=False`` expects one document per line, which keeps large
    inputs splittable; set it for pretty-printed single documents. A malformed
    document raises, or with ``on_bad="skip"`` is left out and counted by the
    Observation ``bad_records``.
    """
    file_schema = StructType([StructField("results", ArrayType(report_schema), True)])
    raw = (_strict_json(spark, path, file_schema, on_bad, bad_records, multiLine=multi_line)
           .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_line"), "results")
           .select("_file", "_block", "_line", F.posexplode("results").alias("_report_pos", "report")))
    return raw.select("_file", "_block", "_line", "_report_pos", "report.*")


def write_records(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """``df`` as gzipped JSON lines. Nested records repeat every field name, so packed they take about a
    tenth of the disk; a file holds at most ``RECORDS_A_FILE`` of them, so that reading stays spread."""
    df.write.mode(mode).options(compression="gzip", maxRecordsPerFile=RECORDS_A_FILE, **options).json(path)


def write_report_documents(reports: DataFrame, path: str) -> None:
    """Write every report as a ``{"results": [report]}`` document on a line of its
    own: a map without shuffle, and no document grows with the data."""
    write_records(reports.select(F.array(F.struct(*reports.columns)).alias("results")), path, "overwrite")


# ---------------------------------------------------------------- S2
def file_layouts(spark: SparkSession, path) -> DataFrame:
    """(file, layout) of every file with text under ``path``, by its first two lines with text.

    A file is a ``document`` when it begins with ``[``, or with an object that its line
    does not close and that goes on in the next one. It is ``ndjson`` otherwise, also when
    the first record is cut short but the next line is a whole one. Lines move only
    as their ends, at most two per task and file.
    """
    text = F.trim("value")
    lines = spark.read.text(path).where(text != "").select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
                 F.substring(text, 1, 1).alias("first"), F.substring(text, -1, 1).alias("last")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("file").orderBy("at"))  # cut per task before it moves
    top = lines.withColumn("n", rank).where("n <= 2").groupBy("file").agg(
        F.max(F.when(F.col("n") == 1, F.col("at"))).alias("one"), F.max(F.when(F.col("n") == 2, F.col("at"))).alias("two"))
    whole_next = (F.col("two.first") == "{") & (F.col("two.last") == "}")
    document = (F.col("one.first") == "[") | (
        (F.col("one.first") == "{") & (F.col("one.last") != "}") & ~F.coalesce(whole_next, F.lit(False)))
    return top.select("file", F.when(document, "document").otherwise("ndjson").alias("layout"))


def _as_path(uri: str) -> str:
    """A path for the readers from ``_metadata.file_path``: decoded, glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def read_json(spark: SparkSession, path, schema: StructType,
              layout: str = "auto", bad_records=None) -> DataFrame:
    """JSON records with a fixed schema.

    ``layout="ndjson"``: one object per line; malformed lines are skipped and
    counted through ``bad_records`` (a ``pyspark.sql.Observation``) without a
    second pass. ``layout="document"``: each file is one JSON array (each
    element a row) or one object (one row); a malformed file raises. ``auto``
    decides for every file by its first lines (``file_layouts``: a pass over the lines, but
    not their parsing); files of both kinds are read apart. Empty files give no rows.
    """
    if layout == "auto":
        kinds = file_layouts(spark, path).groupBy("layout").agg(F.collect_list("file").alias("files"))
        files = {r["layout"]: r["files"] for r in kinds.collect()}  # names that Spark's file index holds anyway
        if len(files) < 2:
            return read_json(spark, path, schema, next(iter(files), "ndjson"), bad_records)
        parts = [read_json(spark, [_as_path(f) for f in files[k]], schema, k, bad_records if k == "ndjson" else None)
                 for k in ("document", "ndjson")]
        return parts[0].unionByName(parts[1])
    if layout == "document":
        return _strict_json(spark, path, schema, multiLine=True)
    if layout != "ndjson":
        raise ValueError(f"unknown JSON layout: {layout}")
    if bad_records is None:
        # Spark drops (and logs) malformed lines itself.
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    # (Spark rejects a query whose only referenced column is the internal
    # corrupt-record column, so callers then select data.)
    return _strict_json(spark, path, schema, "skip", bad_records)


# ---------------------------------------------------------------- S3
def read_csv(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """CSV with header; empty fields -> NULL. With no schema, types are
    inferred (an extra pass: prefer passing the schema)."""
    reader = spark.read.option("header", True).option("nullValue", "")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


# ---------------------------------------------------------------- S4
def read_fhir_dir(spark: SparkSession, path: str, multi_line: bool = True, on_bad: str = "raise",
                  bad_records=None, kinds=None) -> DataFrame:
    """All ``*.json`` and ``*.json.gz`` bundles under ``path`` except the skip-listed names.

    Returns one row per bundle with ``_file`` and ``entry``. ``kinds`` names the
    resource kinds that are wanted: only their fields are parsed (``schemas.bundle``).
    Malformed bundles as in ``read_report_files``.
    """
    df = _strict_json(spark, path, schemas.bundle(kinds), on_bad, bad_records,
                      multiLine=multi_line, pathGlobFilter="*.{json,json.gz}")
    keep = F.lit(True)
    for name in FHIR_SKIP_NAMES:
        keep = keep & ~F.col("_metadata.file_name").contains(name)
    return df.where(keep).select(F.col("_metadata.file_path").alias("_file"), "entry")


# ---------------------------------------------------------------- S5
def _list_files(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted((s.getPath().toString(), s.isFile()) for s in fs.listStatus(hpath))


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def _candidates(spark: SparkSession, resource: str, base: str):
    """(paths, suffix) of the datasets that may hold ``resource``, in order."""
    files = [p for p, is_file in _list_files(spark, f"{base}/{resource}") if is_file] \
        if _is_dir(spark, f"{base}/{resource}") else []
    seen = []
    for p in files:
        found = next((x for x in JSON_SUFFIXES + CSV_SUFFIXES if p.lower().endswith(x)), None)
        if found is None:
            log.warning("skipping unsupported candidate %s", p)
        elif found not in seen:
            seen.append(found)
            yield [q for q in files if q.lower().endswith(found)], found
    names = {f"{resource}.json", f"{resource}.ndjson", f"{resource}.csv"}
    for p, _is_file in _list_files(spark, base):
        if p.rstrip("/").rsplit("/", 1)[-1].lower() in names:
            yield [p], "." + p.rsplit(".", 1)[-1].lower()


def read_resource(spark: SparkSession, resource: str, input_dir: str,
                  schema: StructType, json_layout: str = "auto") -> DataFrame:
    """Read ``resource`` from the first readable candidate, by suffix.

    Candidates: the files of ``input_dir/<resource>/`` in sorted order, then
    the entries ``input_dir/<resource>.{json,ndjson,csv}``. All files of the
    folder with a candidate's suffix are read as one dataset (a Spark-written
    table is a folder of part files). A candidate whose first row cannot be read
    is logged and the next one is tried. Nothing found: the two sample rows
    for ``patients``, else an empty frame.
    """
    for paths, suffix in _candidates(spark, resource, input_dir.rstrip("/")):
        try:
            if suffix in CSV_SUFFIXES:
                df = read_csv(spark, paths, schema)
            else:
                df = read_json(spark, paths, schema, layout=json_layout if suffix == ".json" else "ndjson")
            df.limit(1).collect()
            return df
        except READ_ERRORS as e:
            log.warning("skipping unreadable candidate %s: %s", paths[0], e)
    if resource == "patients":
        rows = [dict(zip(["id", "birthDate", "gender"], r)) for r in SAMPLE_PATIENTS]
        return spark.createDataFrame(
            [tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    return spark.createDataFrame([], schema)


def prepare_resource(spark: SparkSession, resource: str, input_dir: str, schema: StructType,
                     output_path: str | None = None, json_layout: str = "auto") -> str:
    """S5 + S8: normalize ``resource`` to JSON records at ``output_path``
    (default ``input_dir/<resource>.json``) and return that path. An
    existing output is reused as is, like the reference's flow."""
    out = output_path or f"{input_dir.rstrip('/')}/{resource}.json"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(out)
    if hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath):
        return out
    write_json(read_resource(spark, resource, input_dir, schema, json_layout), out)
    return out


# ---------------------------------------------------------------- S7 / S8
def write_csv(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Replace ``path`` with ``df`` as CSV with a header. Returns False (and
    writes nothing) when ``skip_empty`` and the frame has no rows."""
    if skip_empty and df.isEmpty():
        log.info("no rows for %s, skipping", path)
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_json(df: DataFrame, path: str) -> None:
    """Replace ``path`` with ``df`` as NDJSON (one object per line)."""
    df.write.mode("overwrite").json(path)
