"""JSON whose layout drifts between files."""

import json

import pytest
from pyspark.sql import functions as F

from keypanel.sources.files import SourceSpec, read_source
from keypanel.sources.variant import field_report, layout_of, read_json_records, take_fields

FIELDS = {"id": ("$.id", "bigint"), "b": (["$.a.b", "$.b"], "int"), "d": ("$.d", "date")}


@pytest.fixture
def folder(tmp_path):
    """Two files of different layout: renamed, missing, null and re-typed fields, a line that is no record."""
    (tmp_path / "2001.json").write_text('{"id": 1, "a": {"b": 2}, "d": "2001-02-03"}\n\n{"id": "2", "a": {"b": "x"}}\nno record\n')
    (tmp_path / "2002.json").write_text('{"id": 3, "b": "7", "d": [1]}\n{"id": 4.0, "a": null, "b": null}\n{}\n')
    return str(tmp_path)


def test_layouts_in_one_read(spark, folder, rows):
    records = read_json_records(spark, folder)
    found = take_fields(records.where("broken IS NULL"), FIELDS)
    assert [(i, b, str(d), r) for _, _, i, b, d, r in rows(found, F.col("id").asc_nulls_last())] == [
        (1, 2, "2001-02-03", []), (2, None, "None", ["b"]), (3, 7, "None", ["d"]), (4, None, "None", []), (None, None, "None", [])]
    assert [r["broken"] for r in records.where("broken IS NOT NULL").collect()] == ["no record"]


def test_report_and_layout(spark, folder, rows):
    records = read_json_records(spark, folder).where("broken IS NULL")
    report = field_report(records, FIELDS)
    assert rows(report, "field") == [("b", 5, 2, 1, "VARIANT"), ("d", 5, 3, 1, "VARIANT"), ("id", 5, 1, 0, "VARIANT")]
    assert "b: " in layout_of(records) and layout_of(records).startswith("OBJECT<")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_documents(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2, "b": 5}], indent=1), "utf-16")
    (tmp_path / "b.json").write_text(json.dumps({"id": 3, "a": {"b": 6}}), "utf-16")
    (tmp_path / "c.json").write_text("[]", "utf-16")
    spec = SourceSpec(str(tmp_path), "json", json_layout="document", encoding="UTF-16", json_fields=FIELDS)
    assert rows(read_source(spark, spec).select("id", "b"), "id") == [(1, None), (2, 5), (3, 6)]
    with pytest.raises(ValueError, match="layout"):
        read_json_records(spark, str(tmp_path), "pages")
    with pytest.raises(ValueError, match="UTF-8"):
        read_json_records(spark, str(tmp_path), encoding="UTF-16")


def test_clashing_names_and_no_rows(spark, rows):
    df = spark.createDataFrame([("kept", "old", '{"id": 1}'), ("kept", "old", None)], "other string, id string, text string")
    found = take_fields(df.select("other", "id", F.try_parse_json("text").alias("record")), {"id": ("$.id", "int")})
    assert found.columns == ["other", "id", "retyped"]
    assert sorted(rows(found), key=str) == [("kept", 1, []), ("kept", None, [])]
    empty = df.limit(0).select(F.try_parse_json("text").alias("record"))
    assert take_fields(empty, FIELDS).count() == 0
    assert rows(field_report(empty, {"id": ("$.id", "int")}).select("records", "missing")) == [(0, 0)]
