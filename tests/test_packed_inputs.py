"""Report documents and bundles as gzipped files of bounded length."""

import gzip
import json

from pharmaflow import schemas
from pharmaflow.operators import flatten as FL
from pharmaflow.sources import files as FS


def test_documents_are_packed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "RECORDS_A_FILE", 300)
    reports = spark.createDataFrame([(f"r{i}", "20240101", "1", None) for i in range(1000)], schemas.REPORT).coalesce(1)
    FS.write_report_documents(reports, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("part-*.json.gz"))
    assert sorted(sum(1 for _ in gzip.open(f)) for f in files) == [100, 300, 300, 300]
    plain = sum(len(gzip.open(f).read()) for f in files)
    assert sum(f.stat().st_size for f in files) < plain / 4
    assert FS.read_report_files(spark, str(tmp_path / "out")).count() == 1000


def test_packed_bundles_are_read_and_skipped_by_name(spark, tmp_path):
    for name, key in (("a.json.gz", "1"), ("hospitalInformation1.json.gz", "2")):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(json.dumps({"entry": [{"resource": {"resourceType": "Encounter", "id": key}}]}) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({"entry": [{"resource": {"resourceType": "Encounter", "id": "3"}}]}) + "\n")
    (tmp_path / "c.txt").write_text("{}\n")
    got = FL.explode_resources(FS.read_fhir_dir(spark, str(tmp_path), multi_line=False, kinds=["Encounter"])).collect()
    assert sorted(r.id for r in got) == ["1", "3"]
