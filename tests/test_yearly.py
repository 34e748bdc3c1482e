"""Only changed years are computed; stored totals equal those computed at once."""

import os

import pytest
from pyspark.sql import functions as F

from keypanel.plans import events, versions, yearly

LAYOUT = events.EventLayout(key="state", event_id="case", measure="deaths", label="name", flag_column="drunk")
YEARS = range(2015, 2025)


def write_year(spark, folder, year, rows=6, extra=0):
    df = spark.range(rows).select((F.col("id") % 2).cast("string").alias("state"), F.concat(F.lit(" s"), F.col("id") % 2).alias("name"),
                                  (F.col("id") + year * 100).alias("case"), (F.col("id") + extra).alias("deaths"), (F.col("id") % 3).alias("drunk"))
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{year}")


@pytest.fixture
def sources(spark, tmp_path):
    for year in YEARS:
        write_year(spark, tmp_path, year)
    return {year: [f"{tmp_path}/{year}"] for year in YEARS}


def reader(spark, sources, asked):
    def read(years):
        flagged = events.flagged_events([events.EventYear(y, spark.read.parquet(*sources[y])) for y in years], LAYOUT)
        asked.append(sorted({f.split("/")[-2] for f in flagged.inputFiles()}))
        return flagged

    return read


def at_once(spark, sources):
    flagged = events.flagged_events([events.EventYear(y, spark.read.parquet(*p)) for y, p in sources.items()], LAYOUT)
    return sorted(map(tuple, events.event_totals(flagged, LAYOUT).select("state", "name", "year", *yearly.SUMS, "pct_flagged").collect()))


def kept(spark, root):
    df = yearly.stored_totals(spark, root, LAYOUT)
    return sorted(map(tuple, df.select("state", "name", "year", *yearly.SUMS, "pct_flagged").collect()))


def test_one_changed_year_of_ten(spark, sources, tmp_path):
    root, asked = f"{tmp_path}/totals", []
    read = reader(spark, sources, asked)
    assert yearly.refresh_totals(spark, root, sources, read, LAYOUT) == list(YEARS)
    assert kept(spark, root) == at_once(spark, sources)
    assert yearly.refresh_totals(spark, root, sources, read, LAYOUT) == [] and len(asked) == 1

    write_year(spark, tmp_path, 2019, rows=9, extra=5)
    assert yearly.refresh_totals(spark, root, sources, read, LAYOUT) == [2019]
    assert asked[1] == ["2019"]  # one year's scan
    assert kept(spark, root) == at_once(spark, sources)
    assert versions.numbers(spark, root) == [1, 2]
    assert versions.prune(spark, root, keep=1) == [1]  # the folder of the other nine years stays
    assert kept(spark, root) == at_once(spark, sources)


def test_years_come_and_go(spark, sources, tmp_path):
    root, asked = f"{tmp_path}/totals", []
    few = {y: sources[y] for y in (2015, 2016)}
    yearly.refresh_totals(spark, root, few, reader(spark, sources, asked), LAYOUT)
    write_year(spark, tmp_path, 2030, rows=0)
    more = {2016: few[2016], 2017: sources[2017], 2030: [f"{tmp_path}/2030"]}
    assert yearly.refresh_totals(spark, root, more, reader(spark, more, asked), LAYOUT) == [2017, 2030]
    assert kept(spark, root) == at_once(spark, more) and {r[2] for r in kept(spark, root)} == {2016, 2017}
    assert yearly.refresh_totals(spark, root, {2016: few[2016]}, reader(spark, more, asked), LAYOUT) == []
    assert {r[2] for r in kept(spark, root)} == {2016} and len(asked) == 2


def test_a_failed_refresh_changes_nothing(spark, sources, tmp_path):
    root = f"{tmp_path}/totals"
    yearly.refresh_totals(spark, root, sources, reader(spark, sources, []), LAYOUT)
    before = kept(spark, root)
    write_year(spark, tmp_path, 2020, rows=20)

    def broken(years):
        return reader(spark, sources, [])(years).withColumn("deaths", F.raise_error(F.lit("broken source")).cast("long"))

    with pytest.raises(Exception, match="broken source"):
        yearly.refresh_totals(spark, root, sources, broken, LAYOUT)
    assert kept(spark, root) == before and len(os.listdir(f"{root}/versions")) == 1
    assert yearly.refresh_totals(spark, root, sources, reader(spark, sources, []), LAYOUT) == [2020]
    assert kept(spark, root) == at_once(spark, sources) != before
