"""Pipelines on hand fixtures, expected values worked out by hand."""

import zipfile

import pytest
from pyspark.sql import functions as F

from keypanel.plans import attributes, events, history, master, publish, reference, testing, trend
from keypanel.plans.events import EventLayout, EventYear
from keypanel.sources import files

LAYOUT = EventLayout(key="STATE", event_id="ST_CASE", measure="FATALS", label="STATENAME", flag_column="DRUNK_DR",
                     side_code_column="DRIMPAIR", side_code=9)
OLD = [("01", "Alabama", 10001, 1, 0), ("01", "Alabama", 10002, 2, 1), ("01", "Alabama", 10003, 1, 2), ("02", " Alaska", 20001, 3, 0)]
SIDE = [("01", 10002, 1, 9), ("01", 10002, 2, 9), ("01", 10003, 1, 0), ("02", 20001, 1, 9)]


def old_year(spark):
    return spark.createDataFrame(OLD, "STATE string, STATENAME string, ST_CASE long, FATALS int, DRUNK_DR int")


def side_table(spark):
    return spark.createDataFrame(SIDE, "STATE string, ST_CASE long, VEH_NO int, DRIMPAIR int")


def test_event_layouts(spark, rows):
    new = old_year(spark).drop("DRUNK_DR")
    years = [EventYear(2020, old_year(spark)), EventYear(2021, new, side_table(spark)), EventYear(2022, new)]
    totals = events.event_totals(events.flagged_events(years, LAYOUT), LAYOUT)
    assert rows(totals, "year", "STATE") == [
        ("01", "Alabama", 2020, 3, 4, 2, 3, 75.0), ("02", "Alaska", 2020, 1, 3, 0, 0, 0.0),
        ("01", "Alabama", 2021, 3, 4, 1, 2, 50.0), ("02", "Alaska", 2021, 1, 3, 1, 3, 100.0),
        ("01", "Alabama", 2022, 3, 4, 0, 0, 0.0), ("02", "Alaska", 2022, 1, 3, 0, 0, 0.0)]
    assert [r["year"] for r in events.years_without_flag(spark, years, LAYOUT).collect()] == [2022]
    assert events.year_slice(totals, 2021).count() == 2


def test_event_archives(spark, rows, tmp_path):
    head = "STATENAME,ST_CASE,FATALS"
    with zipfile.ZipFile(tmp_path / "2020.zip", "w") as z:
        z.writestr("x/ACCIDENT.CSV", f"STATE,{head},DRUNK_DR\n" + "".join(
            f"{int(s)},{n},{c},{f},{d}\n" for s, n, c, f, d in OLD))
    with zipfile.ZipFile(tmp_path / "2021.zip", "w") as z:
        z.writestr("x/accident.csv", f"ï»¿STATE,{head}\n".encode("latin-1") + "".join(
            f"{int(s)},{n},{c},{f}\n" for s, n, c, f, d in OLD).encode())
        z.writestr("x/drimpair.csv", "STATE,ST_CASE,VEH_NO,DRIMPAIR\n" + "".join(
            f"{int(s)},{c},{v},{d}\n" for s, c, v, d in SIDE))
    (tmp_path / "2022.zip").write_bytes(b"not an archive")
    with zipfile.ZipFile(tmp_path / "2023.zip", "w") as z:
        z.writestr("x/person.csv", "A\n1\n")
    years, failed = events.read_event_years(spark, {y: str(tmp_path / f"{y}.zip") for y in range(2020, 2025)}, LAYOUT,
                                            "accident", "drimpair")
    assert [year for year, _ in failed] == [2022, 2023, 2024]
    assert "not a zip" in failed[0][1] and "no file like" in failed[1][1] and "2024" in failed[2][1]
    assert files.failure_report(spark, failed).count() == 3
    assert events.read_event_years(spark, {2024: str(tmp_path / "2024.zip")}, LAYOUT, "accident", "drimpair")[0] == []
    assert [(y.year, y.side is not None, "DRUNK_DR" in y.events.columns) for y in years] == [
        (2020, False, True), (2021, True, False)]
    totals = events.event_totals(events.flagged_events(years, LAYOUT), LAYOUT)
    assert [(r["STATE"], r["year"], r["pct_flagged"]) for r in totals.orderBy("year", "STATE").collect()] == [
        ("01", 2020, 75.0), ("02", 2020, 0.0), ("01", 2021, 50.0), ("02", 2021, 100.0)]


def test_test_rates(spark, rows):
    persons = spark.createDataFrame([
        (1, 1, 1, 1, 1, 4, 2, 1), (1, 1, 2, 1, 1, 0, 0, 0), (1, 2, 1, 1, 1, 4, 9, 0), (1, 2, 1, 2, 2, 4, 2, 1),
        (1, 3, 1, 1, 1, 3, 2, 3), (2, 4, 1, 1, 1, 0, 2, 10), (2, 5, 1, 1, 1, 0, 8, None)],
        "state int, st_case int, veh_no int, per_no int, per_typ int, inj_sev int, alc_status int, atst_typ int")
    found = testing.test_rates(persons, "state").orderBy("state").collect()
    expected = [
        dict(state=1, total=4, known=2, not_given=1, pct_known_all=50.0, killed=2, killed_known=1, pct_known_killed=50.0,
             surviving=2, surviving_known=1, pct_known_surviving=50.0, n_blood=1, n_breath=0, n_urine=1, n_vitreous=0,
             n_pbt=0, n_other=0, pct_blood=50.0),
        dict(state=2, total=2, known=1, not_given=0, pct_known_all=50.0, killed=0, killed_known=0, pct_known_killed=None,
             surviving=2, surviving_known=1, pct_known_surviving=50.0, n_blood=0, n_breath=0, n_urine=0, n_vitreous=0,
             n_pbt=1, n_other=0, pct_blood=0.0)]
    assert [r.asDict() for r in found] == expected
    lookup = spark.createDataFrame([(1, "a"), (2, "a")], "state int, zone string")
    zone = testing.test_rates(persons, "zone", lookup=lookup, via="state").first()
    assert (zone["total"], zone["known"], zone["pct_blood"], zone["pct_known_killed"]) == (6, 3, 33.3, 50.0)


def test_history(spark, rows):
    vehicles = spark.createDataFrame([(1, 1, 1, 0, 55), (1, 1, 2, 1, 70), (1, 2, 1, 99, 45), (1, 3, 1, None, 0), (1, 4, 1, 2, 98)],
                                     "STATE int, ST_CASE int, VEH_NO int, PREV_DWI int, VSPD_LIM int")
    impaired = spark.createDataFrame([(1, 1, 2), (1, 1, 2), (1, 3, 1)], "STATE int, ST_CASE int, VEH_NO int")
    profile = history.history_profile(vehicles, impaired, "STATE", ["STATE", "ST_CASE", "VEH_NO"], "PREV_DWI", "VSPD_LIM")
    assert profile.first().asDict() == dict(
        STATE=1, known_history=4, with_prior=2, impaired_known_history=2, impaired_with_prior=1,
        pct_impaired_with_prior=50.0, pct_all_with_prior=50.0, median_speed=55.0, mean_speed=56.7, pct_fast=66.7)
    keys = spark.createDataFrame([(1, None)], "STATE int, threshold int")
    assert rows(history.prior_share_by_threshold(profile, keys, "STATE", "threshold")) == [("none", 1, 1, 1, 50.0)]


def test_reference_tables(spark, rows, tmp_path):
    (tmp_path / "ref.csv").write_text(
        "state_fips,state_abbr,state_name,lat,lng,land_area_sq_mi\n1,AL,Alabama,32.7794,−86.8287,50645\n2,AK,Alaska,x,abc,570641\n",
        encoding="utf-8")
    ref = reference.key_reference(spark, str(tmp_path / "ref.csv"), "state_fips", whole=("land_area_sq_mi",))
    assert rows(ref, "state_fips") == [("01", "AL", "Alabama", 32.7794, -86.8287, 50645), ("02", "AK", "Alaska", None, None, 570641)]

    raw = spark.createDataFrame([("01", "AL", "Alabama", "1"), ("72", "PR", "Puerto Rico", "2")],
                                "STATE string, STUSAB string, STATE_NAME string, STATENS string")
    codes = reference.code_list(raw, {"state": "state_fips", "stusab": "state_abbr", "state_name": "state_name"}, "state_fips")
    assert rows(codes) == [("01", "AL", "Alabama")]

    wide = spark.createDataFrame([(10, 0, "US", 9, 9), (40, 1, "Alabama", 5, 6), (40, 72, "Puerto Rico", 3, 4)],
                                 "SUMLEV int, STATE int, NAME string, POPESTIMATE2020 int, POPESTIMATE2024 int")
    pop = reference.yearly_columns(wide, "sumlev", 40, "state", "state_fips", "popestimate", "pop_", {"name": "state_name"})
    assert pop.columns == ["state_fips", "state_name", "pop_2020", "pop_2024"] and rows(pop) == [("01", "Alabama", 5, 6)]

    states = reference.key_master(ref, [(pop, {"pop_2024": "pop_2024"})], "state_fips")
    assert [(r["state_fips"], r["pop_2024"]) for r in states.collect()] == [("01", 6), ("02", None)]

    fixed = reference.with_overrides(spark.createDataFrame([("NC", 3), ("OH", 3)], "k string, v int"),
                                     spark.createDataFrame([("NC", 4)], "k string, v int"), "k", "v")
    assert rows(fixed, "k") == [("NC", 4), ("OH", 3)]
    controls = reference.structural_controls(spark, "name", {"speed": {"Ohio": 70}, "miles": {"Ohio": 5, "Iowa": 6}})
    assert rows(controls) == [("Ohio", 70, 5)]


def test_page_to_attributes(spark, rows):
    values = ["Enacted", "Fifty five years", "0.15", "Third offense", "In compliance", "Permitted", "State utilizes",
              "Mandatory all offender", "Blood, Oral Fluids", "none", "none", "Statute permits"]
    page = "<body>" + "".join(f"<h3>{k}</h3>\n<p> {v} </p>" for k, v in zip(attributes.PAGE_LABELS, values)) + "</body>"
    pages = spark.createDataFrame([("01", page), ("02", "<p>empty</p>")], "state_fips string, html string")
    raw = attributes.page_attributes(pages, "html", ["state_fips"])
    assert raw.columns[0] == "state_fips" and raw.columns[1:] == sorted(raw.columns[1:]) and len(raw.columns) == 13
    table = {r["state_fips"]: r for r in attributes.enforcement_attributes(raw, ["state_fips"]).collect()}
    one, two = table["01"], table["02"]
    assert (one["checkpoints"], one["lookback_years"], one["high_bac_threshold"], one["felony_dui_threshold"]) == ("permitted", 55, 0.15, 3)
    assert (one["pbt_law"], one["iid_mandate"], one["allows_oral_fluid"], one["als_alr_enacted"]) == ("authorized", "mandatory_all", 1, 1)
    flags = ["checkpoints_permitted", "no_refusal_active", "pbt_authorized", "iid_all_offender", "has_felony_dui",
             "has_high_bac_penalty", "open_container_compliant"]
    assert [one[f] for f in flags] == [1] * 7 and [two[f] for f in flags] == [0] * 7
    assert two["checkpoints"] is None and two["allows_oral_fluid"] == 0


def test_penalties(spark, rows):
    amounts = spark.createDataFrame([("Ohio", "$600–$2,100", "10–180 days", "Up to 1 year", "All"), ("Utah", None, None, None, None)],
                                    "state string, fines string, jail string, suspension string, device string")
    windows = spark.createDataFrame([("Ohio", "10 years"), ("Iowa", "Lifetime")], "state string, lookback string")
    assert rows(attributes.penalties(amounts, windows, "state"), "state") == [
        ("Iowa", None, None, None, None, None, 99), ("Ohio", 600.0, 2100.0, 10.0, 365.0, "all_offenders", 10),
        ("Utah", None, None, None, None, "unknown", None)]


def test_mandatory(spark, rows):
    df = spark.createDataFrame([("yes", "mandatory"), ("yes", "discretionary"), ("no", None)], "a string, b string")
    assert rows(df.select(attributes.mandatory(F.col("a"), F.col("b")))) == [(1,), (0,), (0,)]


def test_master(spark, rows):
    spine = spark.createDataFrame([("01", "Alabama", 5157699), ("02", "Alaska", 740133), ("11", "DC", 0)], "k string, name string, pop long")
    deaths = spark.createDataFrame([("01", "dup", 962), ("02", "dup", 70), ("11", "dup", 5)], "k string, name string, deaths long")
    arrests = spark.createDataFrame([("01", 50, 0)], "k string, arrests long, reporting long")
    specs = [master.RateSpec("per_100k", "deaths", "pop"), master.RateSpec("arrest_rate", "arrests", "reporting")]
    rates = master.rates_table(spine, deaths.drop("name"), [arrests], "k", ["name"], specs)
    assert rows(rates, "k") == [("01", "Alabama", 18.65, None), ("02", "Alaska", 9.46, None), ("11", "DC", None, None)]
    wide = master.wide_master(spine, [(deaths, "k"), (rates, "k")], derived={"x": F.lit(1.239)}, drop=("pop",),
                              order_by="name", digits=2)
    assert wide.columns == ["k", "name", "deaths", "per_100k", "arrest_rate", "x"]
    assert [r["k"] for r in wide.collect()] == ["01", "02", "11"] and wide.first()["x"] == 1.24


def test_trend(spark, rows):
    series = spark.createDataFrame([("01", 2014, 1, 2, "own"), ("01", 2015, 30, 100, "own"), ("01", 2016, 5, 0, "own"),
                                    ("01", 2020, 1, 3, "side")], "k string, year int, part long, whole long, method string")
    keys = spark.createDataFrame([("01", "Alabama")], "k string, name string")
    args = (keys, "k", ["name"], 2015, 2020, "part", "whole")
    assert rows(trend.trend(series, *args, method="own")) == [("01", "Alabama", 2015, 30, 100, 30.0), ("01", "Alabama", 2016, 5, 0, None)]
    with pytest.raises(Exception, match="mix methods"):
        trend.trend(series, *args).collect()
    assert trend.trend(series.filter("year < 2020"), *args).count() == 2


# -- publishing ------------------------------------------------------------

@pytest.fixture
def panel(spark):
    return spark.createDataFrame([("01", 5, None, "s"), ("02", None, 2.5, "t")], "k string, n int, v double, ssn string")


def test_package(spark, panel, tmp_path, rows):
    spec = publish.PackageSpec(str(tmp_path), "panel", "Panel", ("csv", "parquet", "json", "orc"), personal_columns=("ssn", "phone"),
                               descriptions={"k": "Key"}, sections={"Identity": ["k"]}, caveats=["Careful."], notes="  Note.",
                               single_file=True)
    paths = publish.package(panel, spec)
    assert sorted(paths) == ["codebook", "csv", "json", "orc", "parquet"]
    assert rows(spark.read.parquet(paths["parquet"]), "k") == [("01", 5, None), ("02", None, 2.5)]
    assert rows(spark.read.option("header", True).csv(paths["csv"]), "k") == [("01", "5", None), ("02", None, "2.5")]
    assert spark.read.json(paths["json"]).count() == spark.read.orc(paths["orc"]).count() == 2
    text = "\n".join(r[0] for r in spark.read.text(paths["codebook"]).collect())
    for part in ("# Panel", "## Identity", "### `k`", "`string`", "2 / 2 (100.0%)", "1 / 2 (50.0%)", "## Other columns",
                 "1. Careful.", "## Notes\n\nNote."):
        assert part in text
    assert "ssn" not in text
    with pytest.raises(ValueError, match="xlsx"):
        publish.package(panel, publish.PackageSpec(str(tmp_path), "p", formats=("xlsx",)))


def test_publish_checks_first(spark, panel, tmp_path):
    spec = publish.PackageSpec(str(tmp_path), "checked", formats=("csv",), personal_columns=("ssn",))
    with pytest.raises(ValueError, match="expected 3 rows"):
        publish.publish(panel, spec, expected_rows=3)
    assert not (tmp_path / "checked.csv").exists()
    paths, report = publish.publish(panel, spec, expected_rows=2, critical=("k", "n"))
    assert sorted(paths) == ["codebook", "csv"]
    assert {r["column"]: r["status"] for r in report.collect()} == {"k": "ok", "n": "critical", "v": "warn", "ssn": "ok"}


def test_stored_table(spark, panel):
    publish.save_table(panel, "stored_panel")
    publish.save_table(panel, "stored_panel")
    assert spark.table("stored_panel").count() == 2
    with pytest.raises(Exception, match="already exists"):
        publish.save_table(panel, "stored_panel", replace=False)


def test_partitioned_parquet(spark, panel, tmp_path):
    path = publish.save_parquet(panel, f"{tmp_path}/p", ["k"])
    assert spark.read.parquet(path).filter("k = '02'").count() == 1


def test_provenance(spark, rows):
    record = publish.Provenance("a", "Source", "https://example.org", "public", "counted", "none", retrieved="2024-01-31")
    registry = publish.provenance(spark, [record])
    assert registry.columns == publish.PROVENANCE_COLUMNS
    tables = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert rows(publish.unregistered(tables, registry)) == [("b",)]
    with pytest.raises(ValueError, match="methodology"):
        publish.Provenance("a", "Source", "", "public", "", "none")
