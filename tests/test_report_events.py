"""Keep-first over reports: those that repeat keys are ranked, the others are not."""

import gzip
import json

import pytest
from pyspark.sql import Observation

from pharmaflow.operators import flatten as FL
from pharmaflow.sources import files as FS


def _report(key, date, reactions, drugs):
    """Drugs as (product, authorization); None is a missing field."""
    return {"safetyreportid": key, "receivedate": date, "serious": "1",
            "patient": {"patientonsetage": "40", "patientsex": "1",
                        "reaction": None if reactions is None else [{"reactionmeddrapt": r} for r in reactions],
                        "drug": None if drugs is None else [{"medicinalproduct": p, "drugauthorizationnumb": a, "openfda": None} for p, a in drugs]}}


REPORTS = [
    _report("alone", "20240101", ["R", "S"], [("A", "1"), ("A", "2")]),
    _report("drug twice", "20240102", ["R"], [(" A", "1"), ("A ", "1"), ("A", None), ("A", "")]),
    _report("reaction twice", "20240103", ["R ", "R", None, ""], [("A", "1")]),
    _report("joined", "20240104", ["R"], [("1:A", "B"), ("1", "A:B"), ("A:", "B"), ("A", ":B")]),
    _report("again", "20240105", ["R"], [("A", "1"), ("B", "1")]),
    _report("again", "20240106", ["R"], [("B", "1"), ("C", "1")]),
    _report(None, "20240107", ["R"], [("A", "1")]),
    _report(None, "20240108", ["R"], [("A", "1"), (None, None)]),
    _report("none", "20240109", None, [("A", "1")]),
    _report("empty", "20240110", ["R"], []),
]


@pytest.fixture
def documents(tmp_path):
    with gzip.open(tmp_path / "r.json.gz", "wt") as f:
        f.writelines(json.dumps({"results": [r]}) + "\n" for r in REPORTS)
    return str(tmp_path)


def test_events_are_those_of_ranking_every_row(spark, documents):
    reports = FS.read_report_files(spark, documents)
    got = sorted(map(str, FL.reports_to_events(reports).collect()))
    assert got == sorted(map(str, FL.dedup_events(FL.flatten_reports(reports)).collect())) and len(got) == 17


def test_only_reports_that_may_repeat_a_key_are_ranked(spark, documents, monkeypatch):
    ranked, keep = [], FL.keep_first
    monkeypatch.setattr(FL, "keep_first", lambda df, *a: ranked.append(df) or keep(df, *a))
    assert FL.reports_to_events(FS.read_report_files(spark, documents)).count() == 17
    ids = {r.safetyreportid for r in ranked[0].select("safetyreportid").distinct().collect()}
    assert ids == {"drug twice", "reaction twice", "again", None}


def test_bad_documents_are_still_counted(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"results": REPORTS[:1]}) + "\n{oops\n")
    seen = Observation("bad-reports")
    assert FL.reports_to_events(FS.read_report_files(spark, str(tmp_path), on_bad="skip", bad_records=seen)).count() == 4
    assert seen.get["bad_lines"] == 1
