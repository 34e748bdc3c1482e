"""CSV members of ZIP archives.

An archive cannot be split, so each one is read by one task, in chunks.  Land the
result as Parquet partitioned by year (``publish.save_parquet``) and query that.
"""

from __future__ import annotations

import io
import sys
import zipfile
import zlib
from typing import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keypanel.operators.columns import repaired_header

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[repaired_header.__module__])

CHUNK_ROWS = 20_000


def _archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _member(archive: zipfile.ZipFile, part: str) -> str | None:
    """First CSV member whose name contains ``part``, ignoring case."""
    hits = [n for n in archive.namelist() if part.lower() in n.lower() and n.lower().endswith(".csv")]
    return hits[0] if hits else None


def zip_headers(spark: SparkSession, path: str | list[str], member: str,
                encoding: str = "latin-1") -> DataFrame:
    """Raw header of the member in each archive: ``(path, member, columns, error)``.

    ``member`` and ``columns`` are NULL where the archive has no such file or
    cannot be read to its end, checksum included; ``error`` says why it cannot.
    """

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                name = cells = error = None
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        name = _member(archive, member)
                        if name:
                            with archive.open(name) as stream:
                                cells = list(pd.read_csv(stream, encoding=encoding, nrows=0).columns)
                            with archive.open(name) as stream:
                                while stream.read(1 << 20):
                                    pass
                except (zipfile.BadZipFile, zlib.error, EOFError, ValueError, NotImplementedError) as problem:
                    name, cells, error = None, None, str(problem)
                rows.append((path, name, cells, error))
            yield pd.DataFrame(rows, columns=["path", "member", "columns", "error"])

    return _archives(spark, path).mapInPandas(
        headers, "path string, member string, columns array<string>, error string")


def read_zipped_csv(spark: SparkSession, path: str | list[str], member: str, columns: list[str],
                    encoding: str = "latin-1", key: str | None = None) -> DataFrame:
    """Rows of the member as text columns, plus the archive's ``source_path``.

    Header cells are matched without case and without a byte-order mark; the
    ``key`` (by default the first column) may also be the end of a garbled cell.
    A column the file lacks is NULL.  A missing member gives no rows.
    """
    key = key or columns[0]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    name = _member(archive, member)
                    if name is None:
                        continue
                    with archive.open(name) as stream:
                        chunks = pd.read_csv(stream, encoding=encoding, dtype=str, chunksize=CHUNK_ROWS)
                        for chunk in chunks:
                            chunk.columns = repaired_header(list(chunk.columns), key.lower())
                            out = chunk.reindex(columns=[c.lower() for c in columns])
                            out.columns = columns
                            out = out.astype(object).where(out.notna(), None)
                            yield out.assign(source_path=path)

    schema = ", ".join(f"`{c}` string" for c in [*columns, "source_path"])
    return _archives(spark, path).mapInPandas(rows, schema).select(
        *[F.col(f"`{c}`") for c in [*columns, "source_path"]])
