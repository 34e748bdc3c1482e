"""Published data that readers never see half-written.

A version is a folder of its own under ``<root>/versions``.  When all of it is written
and checked, a manifest that names its files is put into ``<root>/manifests`` under the next
number, by a rename that fails if another publisher was faster.  Readers take the manifest
with the highest number, so they see the old version or the new one and nothing between;
a job that fails on the way leaves the old one as it is.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

TRIES = 20  # to get a number before other publishers


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    _store(spark, path).delete(_path(spark, path), True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have a folder written aside and put it in the place of the old one, which stays if the writing fails."""
    store, mark = _store(spark, path), uuid4().hex[:12]
    aside, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    try:
        write(aside)
    except Exception:
        remove(spark, aside)
        raise
    replaced = store.exists(_path(spark, path)) and store.rename(_path(spark, path), _path(spark, old))
    if not store.rename(_path(spark, aside), _path(spark, path)):
        if replaced:
            store.rename(_path(spark, old), _path(spark, path))
        raise OSError(f"cannot put {aside} in the place of {path}")
    if replaced:
        remove(spark, old)


def stage() -> str:
    """A folder for a version that no reader knows yet, relative to the root."""
    return f"versions/{uuid4().hex}"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, in order."""
    folder = _path(spark, f"{root}/manifests")
    store = _store(spark, root)
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(root: str, number: int) -> str:
    return f"{root}/manifests/{number:012d}.json"


def commit(spark: SparkSession, root: str, version: str, files: dict[str, str], facts: dict | None = None,
           uses: list[str] | None = None) -> int:
    """Make a staged version the current one; returns its number.

    ``files``: paths relative to the version.  ``uses``: older versions whose folders it goes on using.
    """
    entry = {"version": version, "uses": sorted({version, *(uses or [])}), "files": files, "facts": facts or {}, "at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
    store, hadoop = _store(spark, root), spark._jvm.org.apache.hadoop.fs
    aside = f"{root}/manifests/_{uuid4().hex}"
    out = store.create(_path(spark, aside), True)
    out.write(bytearray(json.dumps(entry, indent=1).encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(_path(spark, root).toUri() if "://" in root else store.getUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)  # without the option to overwrite
    for _ in range(TRIES):
        number = max(numbers(spark, root), default=0) + 1
        try:
            context.rename(store.makeQualified(_path(spark, aside)), store.makeQualified(_path(spark, _manifest(root, number))), keep)
            return number
        except Exception as problem:  # noqa: BLE001 - another publisher took the number
            if "FileAlreadyExists" not in str(problem):
                raise
    raise OSError(f"{root}: no number was free in {TRIES} tries")


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """The manifest of the current version, or of the one with a number."""
    known = numbers(spark, root)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"{root}: no such version")
    number = known[-1] if number is None else number
    path = _manifest(root, number)
    stream = _store(spark, root).open(_path(spark, path))
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    entry = json.loads(text)
    return entry | {"number": number, "files": {k: f"{root}/{entry['version']}/{f}" for k, f in entry["files"].items()}}


def read_version(spark: SparkSession, root: str, kind: str = "parquet", number: int | None = None) -> DataFrame:
    """A published table in one of its formats, as of the current version or the one with a number."""
    path = manifest(spark, root, number)["files"][kind]
    return spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.format(kind).load(path)


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all versions but the last ``keep``, and what was staged without being committed; returns the removed numbers.

    To be run when nobody publishes or reads an older version.
    """
    known = numbers(spark, root)
    gone, stay = known[:max(len(known) - keep, 0)], known[max(len(known) - keep, 0):]
    kept = {used.split("/")[1] for n in stay for used in manifest(spark, root, n)["uses"]}
    for number in gone:
        remove(spark, _manifest(root, number))
    store, folder = _store(spark, root), _path(spark, f"{root}/versions")
    for status in store.listStatus(folder) if store.exists(folder) else []:
        if status.getPath().getName() not in kept:
            store.delete(status.getPath(), True)
    return gone
