"""Totals per key and year that are computed anew only for years whose files have changed.

The totals of a year are sums and counts, so years are stored apart and put together when
they are read.  A manifest (see ``versions``) says for every year which files it was computed
from, by name, length, time of change and, where the store has one, checksum, and in which folder
its totals lie.  A refresh compares the files with the manifest, computes the changed years in
one job into a new folder and commits a manifest that names it beside the old folders of the
other years.  A refresh that fails changes nothing.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.rates import share
from keypanel.functions.text import trimmed
from keypanel.plans import versions
from keypanel.plans.events import EventLayout, partial_totals

SUMS = ("total_events", "total_measure", "flagged_events", "flagged_measure")


def files_of(spark: SparkSession, paths: list[str]) -> list[list]:
    """Name, length, time of change and checksum of all files under the paths, in order."""
    found = []
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        listed = store.listFiles(folder, True)
        while listed.hasNext():
            status = listed.next()
            checksum = store.getFileChecksum(status.getPath())
            found.append([status.getPath().toString(), status.getLen(), status.getModificationTime(), checksum and checksum.toString()])
    return sorted(found, key=lambda f: f[0])


def refresh_totals(spark: SparkSession, root: str, sources: dict[int, list[str]],
                   read: Callable[[list[int]], DataFrame], layout: EventLayout) -> list[int]:
    """Bring the stored totals up to date; returns the years that were computed.

    ``sources`` names the files or folders of every year, ``read`` gives the flagged events
    (``events.flagged_events``) of the years it is asked for.  Years that are no longer among the
    sources leave the manifest.
    """
    known = versions.manifest(spark, root)["facts"]["years"] if versions.numbers(spark, root) else {}
    now = {str(year): files_of(spark, paths) for year, paths in sources.items()}
    changed = sorted(int(year) for year, files in now.items() if year not in known or known[year]["files"] != files)
    if not changed and known.keys() == now.keys():
        return []
    version = versions.stage()
    entry = {year: known[year] for year in now if int(year) not in changed}
    if changed:
        totals = partial_totals(read(changed), layout).where(F.col("year").isin(changed))
        path = f"{root}/{version}"
        try:
            totals.withColumn("_year", F.col("year")).write.partitionBy("_year").parquet(path)
            entry |= {str(year): {"files": now[str(year)], "folder": f"{version}/_year={year}"} for year in changed}
            versions.commit(spark, root, version, {}, {"years": entry, "schema": totals.schema.json()}, _used(entry))
        except Exception:
            versions.remove(spark, path)
            raise
    else:
        facts = versions.manifest(spark, root)["facts"]
        versions.commit(spark, root, version, {}, facts | {"years": entry}, _used(entry))
    return changed


def _used(years: dict[str, dict]) -> list[str]:
    return [y["folder"].rpartition("/")[0] for y in years.values()]


def stored_totals(spark: SparkSession, root: str, layout: EventLayout, digits: int = 2) -> DataFrame:
    """Per key and year: events, measure, the flagged part of both, and its share, from the stored years."""
    facts = versions.manifest(spark, root)["facts"]
    schema = T.StructType.fromJson(json.loads(facts["schema"]))
    folders = [f"{root}/{y['folder']}" for y in facts["years"].values()]
    present = [f for f in folders if versions.exists(spark, f)]  # a year without events has no folder
    rows = spark.read.schema(schema).parquet(*present) if present else spark.createDataFrame([], schema)
    merged = rows.groupBy(*layout.keys(), "year").agg(*[F.sum(c).alias(c) for c in SUMS])
    result = merged.withColumn("pct_flagged", share(F.col("flagged_measure"), F.col("total_measure"), digits))
    return result.withColumn(layout.label, trimmed(F.col(layout.label))) if layout.label else result
