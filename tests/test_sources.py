"""JSON sources: layouts by content, malformed input, unreadable candidates."""

import pytest
from pyspark.sql import Observation

from pharmaflow.sources import files as FS

SCHEMA = "a int, b string"


@pytest.mark.parametrize("text, rows", [
    ('[{"a": 1, "b": "x"}, {"a": 2}]', [1, 2]), ('[\n {"a": 1},\n {"a": 2}\n]\n', [1, 2]),
    ('{\n "a": 7,\n "b": "y"\n}', [7]), ('{"a": 7}', [7]), ('\n{"a": 1}\n{"a": 2}\n', [1, 2]), ("", []),
    ('{"a": 1, "b": "cut\n{"a": 2}\n{"a": 3}', [2, 3]), (' \n\n  [\n{"a": 4}]', [4]), ('{"a":\n7\n}', [7]),
])
def test_layout_by_content(spark, tmp_path, text, rows):
    (tmp_path / "x.json").write_text(text)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert [r.a for r in FS.read_json(spark, str(tmp_path / "x.json"), schema).collect()] == rows
    assert [r.a for r in FS.read_resource(spark, "x", str(tmp_path), schema).collect()] == rows


def test_malformed_documents_raise_or_are_counted(spark, tmp_path):
    good = '{"results": [{"safetyreportid": "%d"}]}'
    (tmp_path / "r.json").write_text("\n".join([good % 1, '{"results": [{"safety', good % 2]))
    with pytest.raises(FS.READ_ERRORS):
        FS.read_report_files(spark, str(tmp_path)).collect()
    seen = Observation("bad")
    got = FS.read_report_files(spark, str(tmp_path), on_bad="skip", bad_records=seen).select("safetyreportid").collect()
    assert sorted(r[0] for r in got) == ["1", "2"] and seen.get["bad_lines"] == 1
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.json").write_text('{"entry": [')
    with pytest.raises(FS.READ_ERRORS):
        FS.read_fhir_dir(spark, str(tmp_path / "b")).collect()
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(FS.READ_ERRORS):
        FS.read_json(spark, str(tmp_path / "b" / "one.json"), schema, layout="document").collect()


def test_next_candidate_on_failure(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.json").write_text('[{"a": 1')
    (tmp_path / "x" / "b.csv").write_text("a,b\n5,z\n")
    assert [r.a for r in FS.read_resource(spark, "x", str(tmp_path), schema).collect()] == [5]


def test_every_file_of_a_mixed_folder_by_its_own_layout(spark, tmp_path):
    folder = tmp_path / "odd [1] name" / "x"
    folder.mkdir(parents=True)
    (folder / "array.json").write_text('[{"a": 1},\n{"a": 2}]')
    (folder / "lines.json").write_text('{"a": 3}\n{"a": 4}\n{oops\n{"a": 5}\n')
    (folder / "object.json").write_text('{\n "a": 6\n}')
    (folder / "cut first.json").write_text('{"a": 0, "b\n{"a": 7}\n')
    (folder / "empty.json").write_text("")
    schema = spark.createDataFrame([], SCHEMA).schema
    path = FS._as_path(str(folder))
    assert sorted(r.a for r in FS.read_json(spark, path, schema).collect()) == [1, 2, 3, 4, 5, 6, 7]
    seen = Observation("bad lines")
    got = FS.read_json(spark, path, schema, bad_records=seen).select("a", "b").collect()
    assert sorted(r.a for r in got) == [1, 2, 3, 4, 5, 6, 7] and seen.get["bad_lines"] == 2
    kinds = {r.file.rsplit("/", 1)[-1]: r.layout for r in FS.file_layouts(spark, path).collect()}
    assert kinds == {"array.json": "document", "lines.json": "ndjson", "object.json": "document", "cut%20first.json": "ndjson"}
    plain = tmp_path / "plain"
    (plain / "x").mkdir(parents=True)
    for f in folder.iterdir():
        (plain / "x" / f.name.replace(" ", "_")).write_text(f.read_text())
    assert sorted(r.a for r in FS.read_resource(spark, "x", str(plain), schema).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_only_fields_of_the_wanted_kinds_are_parsed(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": "p", '
                                       '"gender": "female", "code": {"text": 7}, "period": [1]}}]}')
    got = FS.read_fhir_dir(spark, str(tmp_path), kinds=["Patient"])
    assert got.schema["entry"].dataType.elementType["resource"].dataType.fieldNames() == [
        "resourceType", "id", "gender", "birthDate", "name", "address"]
    assert got.first().entry[0].resource.gender == "female"
