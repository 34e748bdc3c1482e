"""From landed files to a published table: two keys, every stage once."""

import zipfile

from pyspark.sql import functions as F

from keypanel.operators import quality
from keypanel.plans import attributes, events, history, master, publish, reference, testing
from keypanel.plans.events import EventLayout
from keypanel.sources import files, zipped
from keypanel.sources.files import SourceSpec, read_source

REFERENCE = """state_fips,state_abbr,state_name,lat,lng,region
1,AL,Alabama,32.7794,−86.8287,South
2,AK,Alaska,64.0685,−152.2782,West
"""
POPULATION = """SUMLEV,STATE,NAME,POPESTIMATE2020,POPESTIMATE2024
10,0,United States,1,1
40,1,Alabama,100,200
40,2,Alaska,50,0
40,72,Puerto Rico,7,7
"""
LAWS = """state_fips,vehicle_impound_law,impound_mandatory,note
01,yes,mandatory,"a, b"
02,NA,,
"""
PERSON = """STATE,ST_CASE,VEH_NO,PER_NO,PER_TYP,INJ_SEV,ALC_STATUS,ATST_TYP
1,10,1,1,1,4,2,1
1,11,1,1,1,0,0,0
2,20,1,1,1,4,9,
2,20,1,2,2,0,2,1
"""
PAGE = "<html><body><h4>{label}</h4><div>{value}</div><h4>Felony DUI</h4><p>{felony}</p></body></html>"
LAYOUT = EventLayout(key="STATE", event_id="ST_CASE", measure="FATALS", flag_column="DRUNK_DR",
                     side_code_column="DRIMPAIR", side_code=9)


def test_landed_files_to_published_table(spark, tmp_path):
    (tmp_path / "reference.csv").write_text(REFERENCE, encoding="utf-8")
    (tmp_path / "population.csv").write_text(POPULATION)
    (tmp_path / "laws.csv").write_text(LAWS)
    with zipfile.ZipFile(tmp_path / "2023.zip", "w") as z:
        z.writestr("Nat/accident.csv", "STATE,ST_CASE,FATALS,DRUNK_DR\n1,10,1,0\n1,11,2,1\n")
    with zipfile.ZipFile(tmp_path / "2024.zip", "w") as z:
        z.writestr("Nat/ACCIDENT.CSV", "STATE,ST_CASE,FATALS\n1,10,1\n1,11,3\n2,20,2\n")
        z.writestr("Nat/drimpair.csv", "STATE,ST_CASE,VEH_NO,DRIMPAIR\n1,11,1,9\n2,20,1,0\n")
        z.writestr("Nat/person.csv", PERSON)
        z.writestr("Nat/vehicle.csv", "STATE,ST_CASE,VEH_NO,PREV_DWI,VSPD_LIM\n1,10,1,0,45\n1,11,1,2,65\n2,20,1,99,0\n")

    keys = reference.key_reference(spark, str(tmp_path / "reference.csv"), "state_fips")
    population = reference.yearly_columns(
        read_source(spark, SourceSpec(str(tmp_path / "population.csv"), "csv", {
            "SUMLEV": "int", "STATE": "int", "NAME": "string", "POPESTIMATE2020": "long", "POPESTIMATE2024": "long"})),
        "sumlev", 40, "state", "state_fips", "popestimate", "pop_", {"name": "state_name"})

    years, failed = events.read_event_years(
        spark, {y: str(tmp_path / f"{y}.zip") for y in (2023, 2024, 2025)}, LAYOUT, "accident", "drimpair")
    assert [year for year, _ in failed] == [2025]
    landed = publish.save_parquet(events.flagged_events(years, LAYOUT), str(tmp_path / "events"), ["year"])
    totals = events.event_totals(spark.read.parquet(landed), LAYOUT).withColumnRenamed("STATE", "state_fips")
    last = events.year_slice(totals, 2024, ["state_fips", "total_measure", "flagged_measure", "pct_flagged"])

    def member(part, columns):
        raw = zipped.read_zipped_csv(spark, str(tmp_path / "2024.zip"), part, columns)
        return files.typed(raw, dict.fromkeys(columns, "int"))

    ids = ["STATE", "ST_CASE", "VEH_NO"]
    rates = testing.test_rates(
        member("person", [*ids, "PER_NO", "PER_TYP", "INJ_SEV", "ALC_STATUS", "ATST_TYP"]).withColumnsRenamed(
            {c: c.lower() for c in ("STATE", "PER_NO", "PER_TYP", "INJ_SEV", "ALC_STATUS", "ATST_TYP")}), "state")
    past = history.history_profile(member("vehicle", [*ids, "PREV_DWI", "VSPD_LIM"]),
                                   member("drimpair", [*ids, "DRIMPAIR"]).filter("DRIMPAIR = 9"),
                                   "STATE", ids, "PREV_DWI", "VSPD_LIM")

    def padded(df, key):
        return df.withColumn("state_fips", F.format_string("%02d", F.col(key))).drop(key)

    pages = spark.createDataFrame(
        [("01", PAGE.format(label="Sobriety Checkpoints", value="Permitted", felony="Fourth offense")),
         ("02", PAGE.format(label="Ignition Interlocks", value="Mandatory all offender", felony="No felony DUI"))],
        "state_fips string, html string")
    coded = attributes.enforcement_attributes(attributes.page_attributes(pages, "html", ["state_fips"]), ["state_fips"])
    laws = files.read_delimited(spark, str(tmp_path / "laws.csv"), null_columns=("vehicle_impound_law",))

    wide = master.wide_master(
        reference.key_master(keys, [(population, {"pop_2024": "pop_2024"})], "state_fips"),
        [(last, "state_fips"), (padded(rates, "state").select("state_fips", "pct_known_killed", "pct_blood"), "state_fips"),
         (padded(past, "STATE").select("state_fips", "pct_all_with_prior", "median_speed"), "state_fips"),
         (coded.select("state_fips", "checkpoints_permitted", "iid_all_offender", "felony_dui_threshold"), "state_fips"),
         (laws, "state_fips")],
        derived={"rate_per_100k": master.RateSpec("rate_per_100k", "total_measure", "pop_2024").column(),
                 "has_mandatory_impound": attributes.mandatory(F.col("vehicle_impound_law"), F.col("impound_mandatory"))},
        drop=("note",), order_by="state_fips", digits=2)
    quality.expect_unique(wide, ["state_fips"])
    spec = publish.PackageSpec(str(tmp_path / "export"), "panel", "Panel", ("csv", "parquet"), single_file=True)
    paths, report = publish.publish(wide, spec, expected_rows=2, critical=("state_fips", "pop_2024"))

    one, two = [r.asDict() for r in spark.read.parquet(paths["parquet"]).orderBy("state_fips").collect()]
    assert one == {
        "state_fips": "01", "state_abbr": "AL", "state_name": "Alabama", "lat": 32.78, "lng": -86.83, "region": "South",
        "pop_2024": 200, "total_measure": 4, "flagged_measure": 3, "pct_flagged": 75.0, "pct_known_killed": 100.0,
        "pct_blood": 100.0, "pct_all_with_prior": 50.0, "median_speed": 55.0, "checkpoints_permitted": 1,
        "iid_all_offender": 0, "felony_dui_threshold": 4, "vehicle_impound_law": "yes", "impound_mandatory": "mandatory",
        "rate_per_100k": 2000.0, "has_mandatory_impound": 1}
    assert (two["pct_flagged"], two["pct_known_killed"], two["rate_per_100k"], two["has_mandatory_impound"]) == (0.0, 0.0, None, 0)
    assert (two["iid_all_offender"], two["felony_dui_threshold"], two["median_speed"], two["vehicle_impound_law"]) == (1, None, None, None)
    status = {r["column"]: r["status"] for r in report.collect()}
    assert status["pop_2024"] == "ok" and status["rate_per_100k"] == "warn"
