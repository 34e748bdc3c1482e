"""CSV members of ZIP archives of any size: one task for each member.

``zipped`` hands whole archives to tasks as single values, at most 2 GB each.  Here the
driver reads only the directories at the ends of the archives; every member that is
wanted becomes a partition of its own, whose task seeks to the member, inflates it block by
block and parses it in chunks of rows.  A task's memory is bounded by ``BLOCK`` and
``CHUNK_ROWS``, whatever the sizes of archive and member (ZIP64 included).

Archives must lie where Python or ``pyarrow.fs`` can open them at an offset: a shared or
local folder, HDFS, S3, GCS.  For other stores use ``zipped``.
"""

from __future__ import annotations

import io
import json
import sys
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from keypanel.operators.columns import repaired_header

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[repaired_header.__module__])

BLOCK = 1 << 20
CHUNK_ROWS = 20_000
LISTERS = 16  # archives whose directories the driver reads at a time

# Fixed values of the file format: length of a member's own header, where in it the lengths of
# its name and extra field are, and the flag of an encrypted member.
HEADER_BYTES, LENGTHS_AT, ENCRYPTED = 30, 26, 1


@dataclass
class Member(InputPartition):
    """Where a member lies and what it must come to."""

    path: str
    name: str
    offset: int
    compressed: int
    size: int
    checksum: int
    method: int
    flags: int

    def __post_init__(self):
        super().__init__((self.path, self.name))


def opened(path: str):
    """A seekable stream of a file named by path or URI."""
    uri = urlparse(path)
    if uri.scheme in ("", "file"):
        return open(unquote(uri.path) if uri.scheme else path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def members_of(path: str, part: str) -> list[Member]:
    """CSV members whose name contains ``part``, ignoring case, in the order of their names."""
    try:
        with opened(path) as file, zipfile.ZipFile(file) as archive:
            return [Member(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, i.flag_bits)
                    for i in sorted(archive.infolist(), key=lambda i: i.filename)
                    if part.lower() in i.filename.lower() and i.filename.lower().endswith(".csv")]
    except zipfile.BadZipFile as problem:
        raise ValueError(f"{path}: {problem}") from problem


class MemberStream(io.RawIOBase):
    """The inflated bytes of a member, a block at a time; length and checksum are held against the directory."""

    def __init__(self, file, member: Member):
        if member.flags & ENCRYPTED or member.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise ValueError(f"{member.path}, {member.name}: encrypted, or packed by method {member.method}")
        self.file, self.member = file, member
        file.seek(member.offset + LENGTHS_AT)
        lengths = file.read(4)
        file.seek(member.offset + HEADER_BYTES + int.from_bytes(lengths[:2], "little") + int.from_bytes(lengths[2:], "little"))
        self.left, self.size, self.checksum = member.compressed, 0, 0
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS) if member.method == zipfile.ZIP_DEFLATED else None
        self.waiting = b""

    def readable(self) -> bool:
        return True

    def _packed(self) -> bytes:
        block = self.file.read(min(BLOCK, self.left))
        if not block and self.left:
            raise ValueError(f"{self.member.path}, {self.member.name}: the archive ends inside the member")
        self.left -= len(block)
        return block

    def _next(self, wanted: int) -> bytes:
        """Up to ``wanted`` bytes more; none at the end."""
        if self.inflate is None:
            self.waiting = self.waiting or self._packed()
            out, self.waiting = self.waiting[:wanted], self.waiting[wanted:]
            return out
        while not self.inflate.eof:
            packed = self.inflate.unconsumed_tail or self._packed()
            try:
                out = self.inflate.decompress(packed, wanted)
            except zlib.error as problem:
                raise ValueError(f"{self.member.path}, {self.member.name}: {problem}") from problem
            if out:
                return out
            if not packed and not self.left:
                raise ValueError(f"{self.member.path}, {self.member.name}: the member is cut off")
        return b""

    def readinto(self, buffer) -> int:
        out = self._next(len(buffer))
        if not out and (self.size, self.checksum) != (self.member.size, self.member.checksum):
            raise ValueError(f"{self.member.path}, {self.member.name}: length or checksum is wrong")
        buffer[:len(out)] = out
        self.size += len(out)
        self.checksum = zlib.crc32(out, self.checksum)
        return len(out)


def member_rows(member: Member, columns: list[str], encoding: str, key: str, chunk_rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """The named columns of a member as texts, with ``source_path`` and ``source_member``."""
    schema = pa.schema([pa.field(c, pa.string()) for c in [*columns, "source_path", "source_member"]])
    with opened(member.path) as file, io.BufferedReader(MemberStream(file, member), BLOCK) as stream:
        try:
            chunks = pd.read_csv(stream, encoding=encoding, dtype=str, chunksize=chunk_rows)
        except pd.errors.EmptyDataError:
            return
        for chunk in chunks:
            chunk.columns = repaired_header(list(chunk.columns), key.lower())
            out = chunk.reindex(columns=[c.lower() for c in columns])
            out.columns = columns
            out = out.astype(object).where(out.notna(), None).assign(source_path=member.path, source_member=member.name)
            yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.columns = json.loads(options["paths"]), json.loads(options["columns"])
        self.member, self.encoding, self.key = options["member"], options["encoding"], options["key"]

    def partitions(self) -> list[Member]:
        with ThreadPoolExecutor(LISTERS) as listers:
            return [m for found in listers.map(lambda p: members_of(p, self.member), self.paths) for m in found]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # no member was found
            yield from member_rows(partition, self.columns, self.encoding, self.key)


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in [*json.loads(self.options["columns"]), "source_path", "source_member"])

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def _expanded(spark: SparkSession, paths: list[str]) -> list[str]:
    """All files that paths, folders and patterns name, as URIs."""
    jvm, found = spark._jvm, []
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        matches = store.globStatus(pattern) or []
        if not len(matches):
            raise FileNotFoundError(path)
        for status in matches:
            own = store.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s.getPath().toUri().toString() for s in own if s.isFile()]
    return sorted(found)


def read_archives(spark: SparkSession, path: str | list[str], member: str, columns: list[str],
                  encoding: str = "latin-1", key: str | None = None) -> DataFrame:
    """Rows of all CSV members whose name contains ``member``, one task each, as text columns.

    ``path`` names archives, folders of archives or patterns.  Columns are found by header as in
    ``zipped.read_zipped_csv``; ``source_path`` and ``source_member`` say where a row comes from.
    A member that is cut off, altered, encrypted or packed by another method than deflate
    fails its task with an error that names it; an archive without such a member gives no rows.
    """
    spark.dataSource.register(Archives)
    return (spark.read.format("zip_members")
            .option("paths", json.dumps(_expanded(spark, [path] if isinstance(path, str) else path)))
            .option("member", member).option("columns", json.dumps(columns)).option("encoding", encoding)
            .option("key", key or columns[0]).load())
