"""Literal-row tests for the semantic traps and edge cases (SURVEY 1.2,
FIXTURES 3): whitespace, explode, keep-first, rounding, codes, ties, bad
dates, windows, drift, metrics, splits and file sources."""

import math
import os
import tempfile

import pytest
from pyspark.sql import Observation, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pharmaflow import schemas
from pharmaflow.functions import (decode, display_date, first_value, parse_yyyymmdd, strip_ws,
                                  year_month)
from pharmaflow.ml import evaluate as EV, split as SP
from pharmaflow.operators import aggregates as A, drift as DR, flatten as FL, quality as Q
from pharmaflow.operators import select as S, windows as W
from pharmaflow.operators.dedup import keep_first
from pharmaflow.sources import files as FS


def test_strip_all_whitespace(spark):
    df = spark.createDataFrame([("\t a \n",), (" b ",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_ws("s")).collect()] == ["a", "b", None]


def test_first_value(spark):
    df = spark.createDataFrame([([" x ", "y"],), ([],), (None,)], "a array<string>")
    t = df.schema["a"].dataType
    assert [r[0] for r in df.select(first_value("a", t)).collect()] == ["x", None, None]


def _report(rid, reactions, drugs):
    return (rid, "20240130", "1", {"patientonsetage": "30", "patientsex": "1",
                                   "reaction": [{"reactionmeddrapt": r} for r in reactions] if reactions is not None else None,
                                   "drug": drugs})


def _drug(prod, num, brands):
    return {"medicinalproduct": prod, "drugauthorizationnumb": num,
            "openfda": {"brand_name": brands, "manufacturer_name": None, "product_ndc": []}}


def test_flatten_explode_and_keep_first(spark):
    rows = [
        _report("r1", [" Headache\t", "Nausea"], [_drug(" Aspirin ", "A1", ["Bayer"]),
                                                  _drug("Aspirin", "A1", ["Other"])]),
        _report("r2", [], [_drug("X", "1", ["B"])]),        # no reactions -> no rows
        _report("r3", ["Rash"], []),                         # no drugs -> no rows
        _report("r4", ["Rash"], [_drug(None, None, None)]),  # empty product -> ''
    ]
    df = spark.createDataFrame(rows, schemas.REPORT)
    flat = FL.flatten_reports(df)
    assert flat.where("safetyreportid in ('r2', 'r3')").count() == 0
    assert flat.count() == 5
    ev = FL.dedup_events(flat.withColumn("_file", F.lit("f")))
    got = {(r.safetyreportid, r.reaction, r.medicinalproduct): r.brand_name for r in ev.collect()}
    # duplicate key (r1, Headache, Aspirin, A1): the first drug's brand wins
    assert got[("r1", "Headache", "Aspirin")] == "Bayer"
    assert got[("r1", "Nausea", "Aspirin")] == "Bayer"
    assert got[("r4", "Rash", "")] is None
    assert ev.count() == 3


def test_keep_first_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 5, "c")], "k string, o int, v string")
    out = {r.k: r.v for r in keep_first(df, ["k"], ["o"]).collect()}
    assert out == {None: "a", "k": "c"}


def test_age_bucket_rounds_half_even(spark):
    df = spark.createDataFrame([(23.5,), (24.5,), (25.5,), (35.0,), (None,)], "age double")
    h = {r.age_group: r["count"] for r in A.age_histogram(df, "age").collect()}
    assert h == {20: 3, 30: 1}


def test_sex_decode(spark):
    df = spark.createDataFrame([("1",), ("2",), ("0",), ("M",), (None,)], "s string")
    got = [r[0] for r in df.select(decode("s", {"1": "Male", "2": "Female"}, "Unknown")).collect()]
    assert got == ["Male", "Female", "Unknown", "Unknown", "Unknown"]


def test_serious_sum_is_sum_of_codes(spark):
    df = spark.createDataFrame([(30, "1", 1, "20240101"), (30, "1", 2, "20240102"), (30, "1", None, "20240103")],
                               "age int, sex string, serious int, d string")
    r = A.group_summary(df, ["age", "sex"], "serious", "d").first()
    assert (r.event_count, r.serious_count, r.serious_true_count) == (3, 3, 1)
    assert (r.first_event, r.last_event) == ("20240101", "20240103")


def test_topk_ties_broken_by_key(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccd"] + [(None,), (None,)], "r string")
    got = [(r.r, r["count"]) for r in A.top_counts(df, "r", 3).collect()]
    assert got == [("a", 2), ("b", 2), ("c", 2)]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("20240130",), ("2024013x",), (None,)], "d string")
    got = [r[0] for r in df.select(year_month(parse_yyyymmdd("d"))).collect()]
    assert got == ["2024-01", None, None]
    assert [r[0] for r in df.select(display_date("d")).collect()] == ["2024-01-30", "2024-01-3x", "N/A"]  # any 8 chars are dashed


def test_rolling_mean_needs_seven_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 8)], "date int, count double")
    got = [r.rolling_avg for r in W.rolling_mean(df).orderBy("date").collect()]
    assert got[:6] == [None] * 6 and got[6] == 4.0


@pytest.mark.parametrize("values,expected", [
    ([0.8, 0.9], "stable"), ([0.7, 0.8, 0.9], "improving"), ([0.9, 0.9, 0.9], "improving"),
    ([0.9, 0.8, 0.7], "declining"), ([0.8, 0.9, 0.85], "stable")])
def test_trend_label(spark, values, expected):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate(values)], "model string, ts int, value double")
    assert W.trend_label(df, ["model"], "ts").first().trend == expected


def test_numeric_drift_edges(spark):
    base = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    cur = spark.createDataFrame([(None, 6.0), (None, 7.0)], "x double, c double")
    stats = DR.numeric_stats(base, ["x", "c"])
    d = {r.feature: r for r in DR.numeric_drift(stats, cur, ["x", "c"]).collect()}
    assert d["x"].drift_type == "missing_data" and d["x"].drift_detected and d["x"].drift_score == 0.0
    assert d["c"].drift_score == 0.0 and not d["c"].drift_detected  # constant baseline: std 0


def test_psi_one_sided_values(spark):
    base = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    cur = spark.createDataFrame([("a",), ("c",)], "v string")
    b = DR.baseline(base, [], ["v"])
    r = DR.categorical_drift(b, cur, ["v"]).first()
    ba, bb = 2 / 3, 1 / 3
    ca, cc = 0.5, 0.5
    expected = ((ca - ba) * math.log(ca / ba) + (0.0001 - bb) * math.log(0.0001 / bb)
                + (cc - 0.0001) * math.log(cc / 0.0001))
    assert r.drift_score == pytest.approx(expected)
    assert r.drift_detected


def test_overall_drift_mean_of_drifted(spark):
    f = spark.createDataFrame([("a", "x", 0.5, True), ("b", "x", 0.3, True), ("c", "x", 0.05, False)],
                              "feature string, drift_type string, drift_score double, drift_detected boolean")
    r = DR.overall_drift(f).first()
    assert r.drift_score == pytest.approx(0.4) and r.overall_drift and r.drifted_features == 2


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "y int, p int")
    pc = {r["class"]: r for r in EV.per_class(df, "y", "p").collect()}
    assert pc[1].precision == 0.0 and pc[1].f1 == 0.0
    m = EV.classification_metrics(df, "y", "p").first()
    assert m.accuracy == pytest.approx(1 / 3)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(float(y), p) for y, p in zip(range(1, 6), [1.1, 1.9, 3.1, 3.9, 5.1])],
                               "y double, p double")
    m = EV.regression_metrics(df, "y", "p").first()
    assert m.mse == pytest.approx(0.01) and m.rmse ** 2 == pytest.approx(m.mse)
    z = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double")
    assert EV.regression_metrics(z, "y", "p").first().mape == float("inf")


def test_split_reproducible_and_stratified(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(300)], "id long, y boolean")
    a = SP.train_test_split(df, "y", ["id"], 0.2, 42)
    b = SP.train_test_split(df, "y", ["id"], 0.2, 42)
    c = SP.train_test_split(df, "y", ["id"], 0.2, 7)
    ta = {r.id for r in a.where("split = 'test'").collect()}
    assert ta == {r.id for r in b.where("split = 'test'").collect()}
    assert ta != {r.id for r in c.where("split = 'test'").collect()}
    counts = {r.y: r["count"] for r in a.where("split = 'test'").groupBy("y").count().collect()}
    assert counts == {True: 20, False: 40}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1.0, None, 1), (2.0, None, 0)], "f1 double, f2 string, y int")
    rows = {(r.check, r.column): r for r in Q.basic_quality(df, "y", min_rows=100).collect()}
    assert not rows[("min_rows", None)].passed
    assert not rows[("missing_ratio", "f2")].passed
    assert not rows[("min_class_size", "y")].passed
    assert not Q.is_valid(Q.basic_quality(df, "y", min_rows=100)).first().is_valid
    res = Q.run_checks(df, [Q.Check("values_in_set", "y", value_set=(0, 1)),
                            Q.Check("column_exists", "nope"),
                            Q.Check("values_between", "f1", 0, 1.5, mostly=0.5)])
    assert [r.success for r in res.orderBy("position").collect()] == [True, False, True]


def test_filter_dict(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "s string, n int")
    out = S.filter_eq(df, {"s": ["a", "b"], "n": True, "x": object()})
    assert [r.s for r in out.collect()] == ["a"]


def test_json_sources(spark):
    d = tempfile.mkdtemp(prefix="pf-json-")
    open(os.path.join(d, "lines.ndjson"), "w").write('{"a": 1}\n{"a": \n{"a": 3}\n\n')
    open(os.path.join(d, "empty.ndjson"), "w").write("")
    arr = os.path.join(d, "arr.json")
    open(arr, "w").write('[{"a": 1},\n {"a": 2}]')
    obj = os.path.join(d, "obj.json")
    open(obj, "w").write('{\n "a": 7\n}')
    sch = StructType([StructField("a", LongType())])
    obs = Observation("bad")
    df = FS.read_json(spark, os.path.join(d, "lines.ndjson"), sch, bad_records=obs)
    assert sorted(r.a for r in df.collect()) == [1, 3]
    assert obs.get["bad_lines"] == 1
    assert FS.read_json(spark, os.path.join(d, "empty.ndjson"), sch).count() == 0
    assert sorted(r.a for r in FS.read_json(spark, arr, sch, layout="document").collect()) == [1, 2]
    assert [r.a for r in FS.read_json(spark, obj, sch, layout="document").collect()] == [7]


def test_fhir_dir_skips_and_sample_patients(spark):
    d = tempfile.mkdtemp(prefix="pf-fhir-")
    bundle = '{"entry": [{"resource": {"resourceType": "Patient", "id": "%s"}}]}'
    open(os.path.join(d, "p1.json"), "w").write(bundle % "p1")
    open(os.path.join(d, "hospitalInformation1.json"), "w").write(bundle % "h")
    open(os.path.join(d, "notes.txt"), "w").write(bundle % "t")
    res = FL.explode_resources(FS.read_fhir_dir(spark, d))
    assert [r.id for r in FL.fhir_tables(res)["patients"].collect()] == ["p1"]
    sample = FS.read_resource(spark, "patients", tempfile.mkdtemp(prefix="pf-empty-"), schemas.PATIENT_ROW)
    assert sorted(r.id for r in sample.collect()) == ["patient-1", "patient-2"]
    other = FS.read_resource(spark, "encounters", tempfile.mkdtemp(prefix="pf-empty-"), schemas.PATIENT_ROW)
    assert other.count() == 0


def test_load_guard(spark):
    from pharmaflow.operators.profile import require_classes
    one = spark.createDataFrame([(1,), (1,), (None,)], "serious int")
    with pytest.raises(RuntimeError):
        require_classes(one, "serious")
    with pytest.raises(RuntimeError):
        require_classes(one.limit(0), "serious")
    two = spark.createDataFrame([(1,), (2,)], "serious int")
    assert require_classes(two, "serious") is two
    assert require_classes(two, "other") is two


def test_models_score_after_observation(spark):
    """A session that used an Observation can still score LR models."""
    from pharmaflow.ml import models as MD
    df = spark.createDataFrame([(float(i), "a" if i % 2 else "b", i % 2) for i in range(40)],
                               "x double, c string, y int")
    obs = Observation("o")
    df.observe(obs, F.count(F.lit(1)).alias("n")).collect()
    model = MD.train(df, "y", ["x"], ["c"], "logistic_regression")
    scored = MD.score(model, df, "lr", classes=[0, 1])
    assert MD.score_check(scored).first().bad_sum == 0


def test_report_sinks(spark):
    from pharmaflow.plans.registry import fresh_dir
    df = spark.createDataFrame([(1.0, "a"), (None, "b")], "x double, s string")
    out = fresh_dir(spark, "qreport")
    Q.write_quality_report(df, out, [Q.Check("not_null", "x", mostly=0.9)])
    assert spark.read.json(f"{out}/columns").count() == 2
    assert spark.read.json(f"{out}/summary").first().failed_expectations == 1
    pts = spark.createDataFrame([("m", "accuracy", i, v) for i, v in enumerate([0.9, 0.9, 0.7])],
                                "model string, metric string, ts int, value double")
    mout = fresh_dir(spark, "mreport")
    DR.write_monitoring_report(pts, mout)
    assert spark.read.json(f"{mout}/summary").first().performance_trend == "declining"
    assert spark.read.json(f"{mout}/points").where("drift_detected").count() == 1


def test_empty_reaction_is_null_and_text_codes(spark):
    rows = [_report("r1", ["", "  ", "Rash"], [_drug("A", "1", ["B"])])]
    flat = FL.flatten_reports(spark.createDataFrame(rows, schemas.REPORT))
    assert sorted([r.reaction for r in flat.collect()], key=str) == ["", None, "Rash"]
    ev = spark.createDataFrame([("30", "1", "1", "20240101"), ("31", "1", "2", "20240102"),
                                ("abc", "1", "x", "20240103")],
                               "patientonsetage string, patientsex string, serious string, receivedate string")
    h = {r.age_group: r["count"] for r in A.age_histogram(ev).collect()}
    assert h == {30: 2}  # unparsable age is left out, no ANSI error
    r = A.group_summary(ev, ["patientsex"], n=None).first()
    assert (r.event_count, r.serious_count, r.serious_true_count) == (3, 3, 1)
    t = {row.date.isoformat(): row.avg_value for row in A.trend(ev, limit=None).collect()}
    assert t["2024-01-02"] == 2.0 and t["2024-01-03"] is None


def test_prepare_resource_and_pretty_document(spark):
    import json
    d = tempfile.mkdtemp(prefix="pf-res-")
    os.makedirs(os.path.join(d, "patients"))
    open(os.path.join(d, "patients", "a.csv"), "w").write("id,birthDate,gender\np1,1970-01-01,female\np2,,male\n")
    out = FS.prepare_resource(spark, "patients", d, schemas.PATIENT_ROW)
    got = sorted((r.id, r.birthDate) for r in spark.read.schema(schemas.PATIENT_ROW).json(out).collect())
    assert got == [("p1", "1970-01-01"), ("p2", None)]
    assert FS.prepare_resource(spark, "patients", d, schemas.PATIENT_ROW) == out  # reused
    doc = {"results": [{"safetyreportid": "9", "receivedate": "20240101", "serious": "1",
                        "patient": {"patientsex": "2", "reaction": [{"reactionmeddrapt": "Rash"}],
                                    "drug": [{"medicinalproduct": "X", "drugauthorizationnumb": "1"}]}}]}
    path = os.path.join(tempfile.mkdtemp(prefix="pf-doc-"), "events.json")
    open(path, "w").write(json.dumps(doc, indent=2))
    ev = FL.reports_to_events(FS.read_report_files(spark, path, multi_line=True)).collect()
    assert [(r.safetyreportid, r.reaction, r.medicinalproduct, r.brand_name) for r in ev] == [("9", "Rash", "X", None)]


def test_hashed_categoricals(spark):
    from pharmaflow.ml import models as MD
    from pharmaflow.ml.prep import fit_preprocessor, preprocessor_stages
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(float(i), f"v{i % 50}", i % 2) for i in range(200)],
                               "x double, c string, y int")
    stages = preprocessor_stages(df, ["x"], ["c"], encoding="hash", hash_features=64)
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert out.select(F.size(vector_to_array("features")).alias("n")).first().n == 65
    unseen = spark.createDataFrame([(1.0, "never-seen", 0)], "x double, c string, y int")
    assert Pipeline(stages=stages).fit(df).transform(unseen).count() == 1
    model = MD.train(df, "y", ["x"], ["c"], "logistic_regression", encoding="hash")
    assert MD.score_check(MD.score(model, df, "lr", classes=[0, 1])).first().bad_sum == 0


def test_table_sinks(spark):
    from pharmaflow.plans.registry import fresh_dir
    from pharmaflow.sources.tables import Catalog, save_table
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = fresh_dir(spark, "tbl")
    assert save_table(df, path, table_name="pf_test_table") == 2
    assert save_table(df.limit(1), path, table_name="pf_test_table") == 1  # replace
    cat = Catalog(spark, {"t": "table:pf_test_table", "p": path})
    assert cat.table("t").count() == 1 and cat.table("p").count() == 1
    with pytest.raises(ValueError):
        cat.table("nope")
    assert FS.write_csv(df.limit(0), fresh_dir(spark, "csv")) is False  # empty input: skipped


def test_random_search_after_observation(spark):
    from pharmaflow.ml import models as MD
    df = spark.createDataFrame([(i, float(i % 7), "a" if i % 2 else "b", i % 2) for i in range(60)],
                               "id long, x double, c string, y int")
    df.observe(Observation("o2"), F.count(F.lit(1)).alias("n")).collect()
    hist, best = MD.random_search(df, "y", ["x"], ["c"], "logistic_regression",
                                  {"C": ("log", 0.1, 10.0)}, n_trials=2, folds=2, key_cols=["id"])
    assert [r.state for r in hist.collect()] == ["COMPLETE", "COMPLETE"] and best is not None
