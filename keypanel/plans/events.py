"""Event files of many years, whose layout drifts, to totals per key and year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keypanel.functions.rates import flag, share, stable_sum
from keypanel.functions.text import pad_key, trimmed
from keypanel.operators.aggregate import count_where, profile_by_key, profile_through, sum_where
from keypanel.operators.joins import exists_flag
from keypanel.sources.files import read_yearly, union_by_name
from keypanel.sources.zipped import read_zipped_csv, zip_headers


@dataclass(frozen=True)
class EventLayout:
    """Column names of an event table and of its side table of flagged ids."""

    key: str
    event_id: str
    measure: str
    label: str | None = None
    flag_column: str | None = None
    side_code_column: str | None = None
    side_code: object = None

    def keys(self) -> list[str]:
        return [c for c in (self.key, self.label) if c]


@dataclass(frozen=True)
class EventYear:
    """One year of events; ``side`` holds the flags where the events do not.

    ``year`` is None for a file of several years that has a ``year`` column.
    """

    year: int | None
    events: DataFrame
    side: DataFrame | None = None

    def dated(self, df: DataFrame) -> DataFrame:
        return df if self.year is None else df.withColumn("year", F.lit(self.year))


def flagged_events(years: list[EventYear], layout: EventLayout) -> DataFrame:
    """Events of all years with a 0/1 ``flagged`` column.

    Old layout: the event carries a count, flagged when above zero.  New layout:
    flagged when the event's id has the code in the side table.  Neither: 0.
    All years of one layout go through the same join, so ten years cost one
    shuffle and not ten.
    """
    keep = ["year", *[c for c in (layout.key, layout.label, layout.event_id, layout.measure) if c]]
    flagged, lookups = [], {}
    for item in years:
        events = item.dated(item.events)
        if layout.flag_column in events.columns:
            flagged.append(events.select(*keep, flag(F.col(layout.flag_column) > 0).alias("flagged")))
        elif item.side is not None:
            on = ("year", layout.event_id) if item.year is not None else (layout.event_id,)
            hits = item.dated(item.side).filter(F.col(layout.side_code_column) == layout.side_code)
            lookups.setdefault(on, []).append((events.select(*keep), hits.select(*on)))
        else:
            flagged.append(events.select(*keep, F.lit(0).alias("flagged")))
    for on, pairs in lookups.items():
        events, ids = (union_by_name(list(frames)) for frames in zip(*pairs))
        flagged.append(exists_flag(events, ids, list(on), "flagged"))
    return union_by_name(flagged)


def years_without_flag(spark: SparkSession, years: list[EventYear], layout: EventLayout) -> DataFrame:
    """Years whose flags are unknown and were counted as 0."""
    rows = [(item.year, "no flag column and no side table") for item in years
            if layout.flag_column not in item.events.columns and item.side is None]
    return spark.createDataFrame(rows, "year int, reason string")


def partial_totals(flagged: DataFrame, layout: EventLayout) -> DataFrame:
    """Counts and sums per key and year; those of parts of a year add up."""
    keys = [c for c in layout.keys() if c in flagged.columns]
    hit, measure = F.col("flagged") == 1, F.col(layout.measure)
    return profile_by_key(flagged, [*keys, "year"], {
        "total_events": F.count(layout.event_id),
        "total_measure": F.coalesce(F.sum(measure), F.lit(0)),
        "flagged_events": count_where(hit),
        "flagged_measure": sum_where(measure, hit),
    })


def event_totals(flagged: DataFrame, layout: EventLayout, digits: int = 2) -> DataFrame:
    """Per key and year: events, measure, the flagged part of both, and its share."""
    result = partial_totals(flagged, layout).withColumn("pct_flagged", share(F.col("flagged_measure"), F.col("total_measure"), digits))
    if layout.label:
        result = result.withColumn(layout.label, trimmed(F.col(layout.label)))
    return result


def event_totals_through(flagged: DataFrame, via: str, lookup: DataFrame, keys: list[str],
                         event_id: str, measure: str, digits: int = 2) -> DataFrame:
    """As ``event_totals``, with the key found through a lookup on ``via``."""
    hit, value = F.col("flagged") == 1, F.col(measure)
    totals = profile_through(flagged, via, lookup, keys, {
        "total_events": F.count(event_id), "total_measure": stable_sum(value), "flagged_events": count_where(hit),
        "flagged_measure": F.coalesce(stable_sum(F.when(hit, value)), F.lit(0.0))}, extra_keys=("year",))
    return totals.withColumn("pct_flagged", share(F.col("flagged_measure"), F.col("total_measure"), digits))


def year_slice(df: DataFrame, year: int, columns: list[str] | None = None) -> DataFrame:
    """One year as a table of its own."""
    rows = df.filter(F.col("year") == year)
    return rows.select(*columns) if columns else rows


def read_event_years(spark: SparkSession, paths: dict[int, str], layout: EventLayout, event_member: str,
                     side_member: str) -> tuple[list[EventYear], list[tuple[int, str]]]:
    """Open yearly archives; the header of each year decides its layout.

    Returns the years and, for a year whose archive or a file of it cannot be
    read to its end, the reason (``sources.files.failure_report`` makes a table of them).
    Only headers are collected, one per archive.
    """
    found, failed = read_yearly(lambda year: spark.read.format("binaryFile").load(paths[year]), sorted(paths))
    opened = [paths[year] for year, _ in found]
    if not opened:
        return [], failed
    heads, sides = (zip_headers(spark, opened, member).collect() for member in (event_member, side_member))

    def of(rows: list, year: int):
        return next(r for r in rows if r["path"].endswith(paths[year].split(":", 1)[-1]))

    numbers = [c for c in (layout.event_id, layout.measure, layout.flag_column) if c]
    side_columns = [layout.event_id, layout.side_code_column]
    years = []
    for year, _ in found:
        head = of(heads, year)
        if head["member"] is None:
            failed.append((year, head["error"] or f"no file like {event_member!r} in the archive"))
            continue
        present = {c.lower() for c in head["columns"]}
        columns = [c for c in (layout.key, layout.label, *numbers)
                   if c and (c == layout.key or c.lower() in present)]
        events = read_zipped_csv(spark, paths[year], event_member, columns).select(*[
            pad_key(F.col(c)).alias(c) if c == layout.key
            else F.col(c).try_cast("long").alias(c) if c in numbers else F.col(c) for c in columns])
        side = None
        if of(sides, year)["error"] is not None:
            failed.append((year, of(sides, year)["error"]))
            continue
        if of(sides, year)["member"] is not None and layout.side_code_column:
            side = read_zipped_csv(spark, paths[year], side_member, side_columns).select(
                *[F.col(c).try_cast("long").alias(c) for c in side_columns])
        years.append(EventYear(year, events, side))
    return years, sorted(failed)
