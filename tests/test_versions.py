"""Publication: old or new, never half; checks in the pass that writes."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from keypanel.plans import publish, versions


@pytest.fixture
def panel(spark):
    return spark.createDataFrame([("01", 5, None, "s"), ("02", None, 2.5, "t")], "k string, n int, v double, ssn string")


def failing(df):
    """The table, with a job that fails in its last rows."""
    return df.unionByName(df.withColumn("k", F.raise_error(F.lit("broken source")).cast("string")))


def spec(tmp_path, **options):
    return publish.PackageSpec(str(tmp_path), "panel", **({"formats": ("parquet", "csv"), "personal_columns": ("ssn",)} | options))


def test_a_failed_write_leaves_the_old_version(spark, panel, tmp_path):
    one, root = spec(tmp_path), f"{tmp_path}/panel"
    publish.publish(panel, one)
    for attempt in (lambda: publish.publish(failing(panel), one), lambda: publish.publish(panel, one, expected_rows=9),
                    lambda: publish.publish(panel, one, totals={"n": (F.sum("n"), 6)})):
        with pytest.raises(Exception, match="broken source|expected 9 rows, found 2|unexpected totals"):
            attempt()
        assert versions.numbers(spark, root) == [1] and len(glob.glob(f"{root}/versions/*")) == 1
        assert sorted(r["k"] for r in versions.read_version(spark, root).collect()) == ["01", "02"]
        assert versions.read_version(spark, root, "csv").count() == 2


def test_versions_follow_each_other(spark, panel, tmp_path):
    one, root = spec(tmp_path), f"{tmp_path}/panel"
    with pytest.raises(FileNotFoundError):
        versions.manifest(spark, root)
    publish.publish(panel, one, expected_rows=2, totals={"n": (F.sum("n"), 5)})
    before = versions.read_version(spark, root)
    publish.publish(panel.where("k = '01'").withColumn("more", F.lit(1)), one)
    assert versions.read_version(spark, root).columns == ["k", "n", "v", "more"]
    assert before.count() == 2  # a reader of the old version goes on
    assert versions.read_version(spark, root, number=1).count() == 2
    assert versions.manifest(spark, root)["facts"] == {"rows": 1}
    assert versions.prune(spark, root, keep=1) == [1] and versions.numbers(spark, root) == [2]
    assert len(glob.glob(f"{root}/versions/*")) == 1 and versions.read_version(spark, root).count() == 1
    with pytest.raises(FileNotFoundError):
        versions.manifest(spark, root, 1)


def test_two_publishers_get_two_numbers(spark, tmp_path, monkeypatch):
    root, real = str(tmp_path / "r"), versions.numbers
    assert versions.commit(spark, root, versions.stage(), {}) == 1
    first = json.loads((tmp_path / "r/manifests/000000000001.json").read_text())
    seen = [[]]  # a slower publisher looked before the other was done
    monkeypatch.setattr(versions, "numbers", lambda s, r: seen.pop() if seen else real(s, r))
    assert versions.commit(spark, root, versions.stage(), {}) == 2
    assert json.loads((tmp_path / "r/manifests/000000000001.json").read_text()) == first


@pytest.mark.parametrize("formats", [("parquet",), ("csv",), ("csv", "json"), ("orc", "parquet", "csv")])
def test_the_table_is_computed_once(spark, panel, tmp_path, formats):
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    table = panel.mapInPandas(counted, panel.schema)
    paths, report = publish.publish(table, spec(tmp_path, formats=formats), expected_rows=2, critical=("k", "n"))
    assert sorted(paths) == sorted([*formats, "codebook"]) and computed.value == 2
    assert {r["column"]: (r["nulls"], r["status"]) for r in report.collect()} == {
        "k": (0, "ok"), "n": (1, "critical"), "v": (1, "warn"), "ssn": (0, "ok")}
    plain = publish.null_report(panel, ("k", "n"))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, plain.collect()))
    text = "\n".join(r[0] for r in spark.read.text(paths["codebook"]).collect())
    assert text.count("1 / 2 (50.0%)") == 2 and "ssn" not in text
    for kind in formats:
        assert versions.read_version(spark, f"{tmp_path}/panel", kind).count() == 2
    assert len(glob.glob(f"{tmp_path}/panel/versions/*/*")) == len(formats) + 1


def test_an_empty_table(spark, panel, tmp_path):
    paths, report = publish.publish(panel.where("false"), spec(tmp_path), expected_rows=0)
    assert spark.read.parquet(paths["parquet"]).count() == 0
    assert {(r["rows"], r["nulls"], r["status"]) for r in report.collect()} == {(0, 0, "ok")}


def test_a_failed_replacement_leaves_the_stored_table(spark, panel):
    publish.save_table(panel, "kept_panel")
    with pytest.raises(Exception, match="broken source"):
        publish.save_table(failing(panel), "kept_panel")
    assert spark.table("kept_panel").count() == 2
    publish.save_table(spark.table("kept_panel").where("k = '02'"), "kept_panel")  # reads what it replaces
    assert [r["k"] for r in spark.table("kept_panel").collect()] == ["02"]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_panel")] == ["kept_panel"]


@pytest.mark.parametrize("save", [publish.save_parquet, publish.save_csv])
def test_a_failed_file_leaves_the_old_one(spark, panel, tmp_path, save):
    path = f"{tmp_path}/file"
    save(panel, path)
    with pytest.raises(Exception, match="broken source"):
        save(failing(panel), path)
    read = spark.read.parquet if save is publish.save_parquet else spark.read.option("header", True).csv
    assert read(path).count() == 2
    save(panel.where("k = '01'"), path)
    assert read(path).count() == 1 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["file"]
