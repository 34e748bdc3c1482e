"""Archives read member by member."""

import io
import tracemalloc
import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from keypanel.sources import archives
from keypanel.sources.archives import MemberStream, member_rows, members_of, read_archives
from keypanel.sources.files import SourceSpec, read_source
from keypanel.sources.zipped import read_zipped_csv


@pytest.fixture
def archive(tmp_path):
    def write(name, members, method=zipfile.ZIP_DEFLATED):
        path = tmp_path / name
        with zipfile.ZipFile(path, "w", method) as z:
            for member, content in members.items():
                z.writestr(member, content if isinstance(content, bytes) else content.encode("latin-1"))
        return str(path)

    return write


HEAD = 'ï»¿STATE,St_Case,NAME\n1,10,"Doña, A"\n2,20,\n3,30,"two\nlines"\n'


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_equal_to_whole_archives(spark, archive, method):
    path = archive("y.zip", {"Nat/readme.txt": "x", "Nat/ACCIDENT.CSV": HEAD}, method)
    columns = ["STATE", "ST_CASE", "NAME", "DRUNK_DR"]
    found = read_archives(spark, path, "accident", columns).drop("source_member", "source_path")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, read_zipped_csv(spark, path, "accident", columns).drop("source_path").collect()))
    assert read_archives(spark, path, "vehicle", ["STATE"]).collect() == []


def test_every_member_has_its_own_task(spark, archive, tmp_path):
    for year in (1, 2):
        archive(f"{year}.zip", {f"person{i}.csv": "K,V\n" + "".join(f"{year},{i}\n" for _ in range(100)) for i in range(4)} | {"other.csv": "K\n9\n"})
    for path in (str(tmp_path), str(tmp_path / "*.zip"), [str(tmp_path / "1.zip"), str(tmp_path / "2.zip")]):
        df = read_archives(spark, path, "person", ["K", "V"])
        assert df.rdd.getNumPartitions() == 8
        each = df.groupBy(F.spark_partition_id().alias("p"), "source_path", "source_member").count().collect()
        assert len({r["p"] for r in each}) == 8 and {r["count"] for r in each} == {100}
    assert {r["source_member"] for r in each} == {f"person{i}.csv" for i in range(4)}


def test_as_a_declared_source(spark, archive):
    path = archive("y.zip", {"a1.csv": "K,V\n1,2\n", "a2.csv": "V,K\n3,4\n"})
    df = read_source(spark, SourceSpec(path, "csv_archive", {"K": "int", "V": "int"}, member="a"))
    assert sorted(map(tuple, df.collect())) == [(1, 2), (4, 3)]


def test_memory_is_bounded_by_a_block(archive, monkeypatch):
    """A member a hundred times as large as its archive and far larger than the memory used."""
    monkeypatch.setattr(archives, "BLOCK", 1 << 16)
    line = b"1,2,some text that repeats\n"
    path = archive("big.zip", {"small.csv": "A\n1\n", "big.csv": line * 6_000_000})
    member, = members_of(path, "big")
    assert member.size == 6_000_000 * len(line) > 100 * member.compressed
    tracemalloc.start()
    with open(path, "rb") as file, io.BufferedReader(MemberStream(file, member), 1 << 16) as stream:
        lines = sum(block.count(b"\n") for block in iter(lambda: stream.read(1 << 16), b""))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == 6_000_000 and most < 4 << 20


def test_rows_come_in_chunks(archive):
    path = archive("big.zip", {"p.csv": "K,V\n" + "".join(f"1,{i}\n" for i in range(1000))})
    batches = list(member_rows(members_of(path, "p")[0], ["K", "V"], "latin-1", "K", chunk_rows=300))
    assert [b.num_rows for b in batches] == [300, 300, 300, 100]
    assert batches[0].schema.names == ["K", "V", "source_path", "source_member"]


def test_members_beyond_four_gigabytes_are_found(tmp_path):
    """ZIP64 sizes and offsets come from the extra field of the directory."""
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("a.csv", "w", force_zip64=True) as out:
        out.write(b"K\n1\n")
    member, = members_of(str(path), "a")
    assert [b.to_pydict()["K"] for b in member_rows(member, ["K"], "latin-1", "K")] == [["1"]]


def test_empty_member(archive):
    member, = members_of(archive("e.zip", {"e.csv": ""}), "e")
    assert list(member_rows(member, ["K"], "latin-1", "K")) == []


def read_all(path, member):
    with open(path, "rb") as file:
        return io.BufferedReader(MemberStream(file, member)).read()


def test_damaged_members_are_named(spark, archive, tmp_path):
    path = archive("d.zip", {"d.csv": "K\n" + "".join(f"{i * 7919}\n" for i in range(5000))})
    whole = open(path, "rb").read()
    member, = members_of(path, "d")
    assert read_all(path, member).startswith(b"K\n0\n7919\n")

    broken = tmp_path / "b.zip"
    broken.write_bytes(whole[:200] + bytes([whole[200] ^ 255]) + whole[201:])
    with pytest.raises(ValueError, match="d.csv"):
        read_all(broken, member)
    with pytest.raises(Exception, match="d.csv"):
        read_archives(spark, str(broken), "d", ["K"]).collect()

    broken.write_bytes(whole[:300])
    with pytest.raises(ValueError, match="ends inside"):
        read_all(broken, member)
    with pytest.raises(Exception, match="b.zip"):
        read_archives(spark, str(broken), "d", ["K"]).collect()
    for change in ({"method": 12}, {"flags": 1}):
        with pytest.raises(ValueError, match="encrypted, or packed"):
            read_all(path, replace(member, **change))


def test_a_missing_archive_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_archives(spark, str(tmp_path / "none.zip"), "a", ["K"])
