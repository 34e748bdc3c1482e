"""Readers over small landed files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from keypanel.sources import files, html, lines, zipped
from keypanel.sources.files import SourceSpec, read_source


@pytest.fixture
def land(tmp_path):
    def write(name, content, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
        return str(path)
    return write


# -- delimited and JSON ----------------------------------------------------

def test_columns_are_found_by_name_and_keys_stay_text(spark, land, rows):
    path = land("a.csv", "NAME,STATE,POP,NOTE\nAlabama,01,5,\"x, y\"\nAlaska,02,,NA\n")
    df = files.read_delimited(spark, path, {"STATE": "string", "POP": "int", "NAME": "string", "NOTE": "string"},
                              null_columns=("NOTE",))
    assert df.dtypes == [("STATE", "string"), ("POP", "int"), ("NAME", "string"), ("NOTE", "string")]
    assert rows(df, "STATE") == [("01", 5, "Alabama", "x, y"), ("02", None, "Alaska", None)]


def test_separator_and_encoding(spark, land, rows):
    path = land("a.txt", "STATE|NAME\n01|Doña Ana\n", "latin-1")
    spec = SourceSpec(path, "csv", {"STATE": "string", "NAME": "string"}, separator="|", encoding="ISO-8859-1")
    assert rows(read_source(spark, spec)) == [("01", "Doña Ana")]


def test_byte_order_mark(spark, land):
    assert files.read_delimited(spark, land("a.csv", "﻿STATE,X\n01,1\n")).columns[0] == "STATE"


def test_json_is_flattened(spark, land, rows):
    path = land("a.json", json.dumps([{"id": 1, "a": {"b": 2, "c": {"d": "x"}}}, {"id": 2, "a": {"b": None}}]))
    df = read_source(spark, SourceSpec(path, "json", json_layout="document"))
    assert df.columns == ["a.b", "a.c.d", "id"]
    assert rows(df, "id") == [(2, "x", 1), (None, None, 2)]


def test_json_lines(spark, land, rows):
    path = land("l.json", '{"id": 1}\n{"id": 2, "n": "é"}\n{"id": 3}\n', "latin-1")
    found = read_source(spark, SourceSpec(path, "json", {"id": "int", "n": "string"}, encoding="ISO-8859-1"))
    assert rows(found, "id") == [(1, None), (2, "é"), (3, None)]
    assert read_source(spark, SourceSpec(path, "json", schema="id bigint", encoding="ISO-8859-1")).columns == ["id"]
    with pytest.raises(ValueError, match="more than one JSON value"):
        read_source(spark, SourceSpec(path, "json", json_layout="document", encoding="ISO-8859-1"))
    with pytest.raises(ValueError, match="layout"):
        read_source(spark, SourceSpec(path, "json", json_layout="pages"))


def test_json_column(spark, rows):
    df = spark.createDataFrame([(1, '{"k": 5, "n": {"m": "z"}}')], "id int, props string")
    flat = files.flatten_json_column(df, "props", "k int, n struct<m: string>")
    assert flat.columns == ["id", "props.k", "props.n.m"] and rows(flat) == [(1, 5, "z")]


def test_dispatch(spark, land):
    path = land("t.csv", "a\n1\n")
    with pytest.raises(ValueError, match="unknown source type 'pdf_table'"):
        read_source(spark, SourceSpec(path, "pdf_table"))
    with pytest.raises(ValueError, match="row_selector"):
        read_source(spark, SourceSpec(path, "html_scrape"))


def test_parquet_reads_only_its_columns(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{tmp_path}/t")
    df = read_source(spark, SourceSpec(f"{tmp_path}/t", "parquet", {"b": "int"}))
    assert df.columns == ["b"]


def test_inline_table_keeps_common_keys(spark, rows):
    df = files.inline_table(spark, "state_name", {"speed": {"Ohio": 70, "Utah": 80}, "vmt": {"Ohio": 117109}})
    assert rows(df) == [("Ohio", 70, 117109)]


def test_years(spark, rows, tmp_path):
    spark.createDataFrame([(1, 2)], "k int, a int").write.parquet(f"{tmp_path}/2015")
    spark.createDataFrame([(3, 4)], "k int, b int").write.parquet(f"{tmp_path}/2017")
    opened, failed = files.read_yearly(lambda y: spark.read.parquet(f"{tmp_path}/{y}"), [2015, 2016, 2017])
    union = files.union_by_name([df for _, df in opened])
    assert rows(union.select("k", "a", "b", "year"), "k") == [(1, 2, None, 2015), (3, None, 4, 2017)]
    report = files.failure_report(spark, failed).collect()
    assert [r["year"] for r in report] == [2016] and "2016" in report[0]["reason"]


def test_stored_tables_and_sql(spark, rows):
    views = {"some_view": spark.createDataFrame([(1,), (3,)], "v int")}
    assert rows(files.run_sql(spark, "SELECT avg(v) FROM some_view", views)) == [(2.0,)]
    names = [r["table_name"] for r in files.stored_tables(spark).collect()]
    assert "some_view" in names


# -- ZIP -------------------------------------------------------------------

@pytest.fixture
def archive(tmp_path):
    def write(name, members):
        path = tmp_path / name
        with zipfile.ZipFile(path, "w") as z:
            for member, content in members.items():
                z.writestr(member, content.encode("latin-1"))
        return str(path)
    return write


def test_zipped_csv(spark, archive, rows):
    path = archive("y.zip", {"Nat/readme.txt": "x", "Nat/ACCIDENT.CSV": 'ï»¿STATE,St_Case,NAME\n1,10,"Doña, A"\n2,20,\n'})
    df = zipped.read_zipped_csv(spark, path, "accident", ["STATE", "ST_CASE", "NAME", "DRUNK_DR"])
    assert rows(df.drop("source_path"), "STATE") == [("1", "10", "Doña, A", None), ("2", "20", None, None)]
    assert df.first()["source_path"].endswith("y.zip")
    assert zipped.read_zipped_csv(spark, path, "vehicle", ["STATE"]).count() == 0
    head = zipped.zip_headers(spark, path, "accident").first()
    assert head["member"] == "Nat/ACCIDENT.CSV" and head["columns"][1:] == ["St_Case", "NAME"]
    typed = read_source(spark, SourceSpec(path, "csv_zip", {"STATE": "int", "NAME": "string"},
                                          encoding="latin-1", member="accident"))
    assert rows(typed, "STATE") == [(1, "Doña, A"), (2, None)]


def test_zipped_csv_in_chunks(spark, archive):
    n = 45_000
    path = archive("big.zip", {"person.csv": "STATE,V\n" + "".join(f"1,{i}\n" for i in range(n))})
    total = zipped.read_zipped_csv(spark, path, "person", ["STATE", "V"]).agg(F.count("*"), F.sum(F.col("V").cast("long")))
    assert tuple(total.first()) == (n, n * (n - 1) // 2)


# -- HTML ------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>td{}</style></head><body>
<table><tr><th>A</th></tr></table>
<table><thead><tr><th> State Name </th><th>Max-Fine</th></tr></thead>
<tr><td>Ohio<td>$1,000 &ndash; $2,000<tr><td>Utah</td><td><b>none</b><script>var x = "<td>";</script></td></tr></table>
<table><tr class="data-row"><td class="name">A</td></tr><tr class="x data-row"><td class="name big">B</td><td class="val"> 2
 3</td></tr></table></body></html>"""


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, "<p>no table"), (3, None)], "page_id int, html string")


def test_tables(spark, pages, rows):
    second = html.page_tables(pages, table_index=1)
    assert html.table_header(second) == ["state_name", "max_fine"]
    assert rows(html.named_table(second), "state_name") == [(1, "Ohio", "$1,000 – $2,000"), (1, "Utah", "none")]
    assert {r["table_idx"] for r in html.page_tables(pages, largest=True).collect()} == {1}
    assert html.page_tables(pages).filter("row_idx = 0").count() == 3
    assert html.table_header(html.page_tables(pages, table_index=2)) == ["0", "1"]
    with pytest.raises(ValueError, match="no table"):
        html.table_header(html.page_tables(pages, table_index=9))
    missing = html.pages_without_table(pages, html.page_tables(pages, table_index=0))
    assert sorted(r["page_id"] for r in missing.collect()) == [2, 3]


def test_nested_tables(spark):
    page = "<table><tr><td>a<table><tr><td>b</td></tr></table></td><td>c</td></tr></table>"
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    tables = {r["table_idx"]: r["cells"] for r in html.page_tables(df).collect()}
    assert tables == {0: ["ab", "c"], 1: ["b"]}


def test_merged_cells_are_repeated(spark, rows):
    page = ("<table><tr><th colspan=2>A</th><th rowspan='2'>B</th></tr><tr><th>x</th><th>y</th></tr>"
            "<tr><td rowspan=3>1</td><td>2<br>3</td><td>4</td></tr><tr><td colspan=2>5</td></tr><tr><td>6</td><td>7</td></tr></table>")
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    found = rows(html.page_tables(df).select("is_header", "cells"), "row_idx")
    assert found == [(True, ["A", "A", "B"]), (True, ["x", "y", "B"]), (False, ["1", "2 3", "4"]),
                     (False, ["1", "5", "5"]), (False, ["1", "6", "7"])]


def test_records(spark, pages, rows):
    fields = {"name": "td.name", "value": "td.val", "all": ""}
    found = html.page_records(pages, "tr.data-row", fields)
    assert rows(found.drop("error"), "record_idx") == [(1, 0, "A", "", "A"), (1, 1, "B", "2\n 3", "B 2\n 3")]
    assert html.page_records(pages, "table .name.big", {"t": ""}).first()["t"] == "B"


def test_selectors(spark):
    page = """<div id=a class="x y"><p data-k="1 2">one<p>two</p><div><p class=deep>three</p></div></div><p id=b>four</p>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")

    def texts(selector):
        return [r["t"] for r in html.page_records(df, selector, {"t": ""}).orderBy("record_idx").collect()]

    assert texts("p") == ["one", "two", "three", "four"]
    assert texts("div p") == ["one", "two", "three"]
    assert texts("div div p") == texts(".x .deep") == texts("div.x.y div p.deep") == ["three"]
    assert texts("p.none") == texts("p .deep p") == []
    for wrong in ("p:first-child", "div > p", "", "p#a", "p, b"):
        with pytest.raises(ValueError, match="selector"):
            html.selector_chain(wrong)


def test_records_take_the_first_element_inside(spark, rows):
    """A field beyond its row is not taken; a row inside a row is a record too; equal pages give equal records."""
    page = "<ul><li class=r>a<b>1</b><ul><li class=r><b>2</b><i>z</i></ul><li class=r>c</ul><b>3</b>"
    df = spark.createDataFrame([(1, page), (1, page), (None, page)], "page_id int, html string").coalesce(1)
    found = rows(html.page_records(df, "ul li.r", {"b": "b", "i": "i", "own": ""}).drop("error"), "page_id", "record_idx")
    one = [(0, "1", "z", "a 1 2 z"), (1, "2", "z", "2 z"), (2, "", "", "c")]
    assert found == [(None, *r) for r in one] + [(1, *r) for r in one for _ in range(2)]


def test_merged_cells_of_many_rows(spark, rows):
    """A cell over all rows of a table longer than a block, and one over more rows than there are."""
    body = "".join(f"<tr><td>{i}</td></tr>" for i in range(1, 700))
    page = f"<table><tr><td rowspan=700>all</td><td>0</td></tr>{body}</table><table><tr><td rowspan=9>x<td>y</table>"
    tables = html.page_tables(spark.createDataFrame([(1, page)], "page_id int, html string"))
    assert rows(tables.where("table_idx = 0").select("cells"), "row_idx") == [(["all", str(i)],) for i in range(700)]
    assert rows(tables.where("table_idx = 1").select("cells")) == [(["x", "y"],)]


def test_tables_are_chosen_without_a_shuffle(spark, pages):
    plan = html.page_tables(pages, largest=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_one_page_never_fails_the_table(spark, rows):
    deep = "<div>" * 5000 + "<table><tr><td>x</td></tr></table>" + "</div>" * 5000
    wide = '<table><tr><td colspan="²">a</td><td colspan="1000000000">b</td><td rowspan="99999999">c</td></tr><tr><td>d</td></tr></table>'
    df = spark.createDataFrame([(1, deep), (2, wide), (3, None), (4, "")], "page_id int, html string")
    found = {(r["page_id"], r["row_idx"]): r["cells"] for r in html.page_tables(df).collect()}
    assert found[(1, 0)] == ["x"] and len(found[(2, 0)]) == 1002 and found[(2, 0)][:2] == ["a", "b"] and found[(2, 1)][0] == "d"
    assert html.page_records(df, "td", {"t": ""}).filter("page_id = 1").first()["t"] == "x"


def test_a_page_that_cannot_be_parsed_is_reported(spark, monkeypatch):
    def fails(page):
        if "bad" in page:
            raise RuntimeError("no way")
        return original(page)

    original = html.parse
    monkeypatch.setattr(html, "parse", fails)
    df = spark.createDataFrame([(1, "bad"), (2, "<table><tr><th>K<tr><td>1</table>")], "page_id int, html string")
    tables = html.page_tables(df)
    assert tables.filter("error IS NOT NULL").collect()[0]["page_id"] == 1
    assert html.named_table(tables).collect() == [(2, "1")]


def test_each_page_has_its_own_header(spark, rows):
    first = "<table><tr><th>x<th>y<tr><td>1<td>2</table>"
    second = "<table><tr><th>y<th>x<th>z<tr><td>3<td>4<td>5</table>"
    tables = html.page_tables(spark.createDataFrame([(0, first), (1, second)], "page_id int, html string"))
    assert html.table_header(tables) == ["x", "y", "z"]
    assert rows(html.named_table(tables), "page_id") == [(0, "1", "2", None), (1, "4", "3", "5")]
    assert rows(html.named_table(tables, ["z", "x"]), "page_id") == [(0, None, "1"), (1, "5", "4")]


def test_landed_pages(spark, land, rows):
    path = land("p.html", PAGE)
    table = read_source(spark, SourceSpec(path, "html_table", table_index=1))
    assert table.columns == ["page_id", "state_name", "max_fine"] and table.count() == 2
    largest = read_source(spark, SourceSpec(path, "html_table", largest=True))
    assert largest.exceptAll(table).isEmpty() and largest.columns == table.columns
    records = read_source(spark, SourceSpec(path, "html_scrape", row_selector=".data-row", field_map={"n": ".name"}))
    assert sorted(r["n"] for r in records.collect()) == ["A", "B"]


# -- label lines -----------------------------------------------------------

def test_label_values(spark, rows):
    text = "Felony DUI\n\n Third offense \nNo Refusal Programs\n  lacks\t\nFelony DUI\nFourth\nSocial Host Laws"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, text string")
    found = lines.label_values(df, "text", ["Felony DUI", "No Refusal Programs", "Social Host Laws"])
    assert found.columns == ["id", "text", "felony_dui", "no_refusal_programs", "social_host_laws"]
    assert rows(found.drop("text"), "id") == [(1, "Fourth", "lacks", None), (2, None, None, None), (3, None, None, None)]


def test_character_references(spark, rows):
    cases = {"&#00000065;&#x0000041;&check;": "AA✓", "a &amp;amp; b": "a &amp; b", "&lt;&gt;": "<>", "caf&eacute; &#233; &#xE9;": "café é é", "R&D; &nope; &": "R&D; &nope; &",
             "&ndash;&#8217;&#x1F600;": "–’😀", "&#0; &#99999999; &#xD800;": "&#0; &#99999999; &#xD800;", "plain": "plain", "": "",
             "x &amp": "x &amp", "&apos;&quot;": "'\""}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r[1] for r in rows(df.select("i", lines.decoded(F.col("t"))), "i")] == list(cases.values())


def test_plain_text(spark, rows):
    page = "<style>\nA\n</style><!-- x > y --><div>&nbsp;Felony&nbsp;DUI&nbsp;</div><p>A &amp;lt; B</p><script>if (a<b) {}</script>"
    df = spark.createDataFrame([(page,)], "h string").select(lines.filled_lines(lines.plain_text(F.col("h"))))
    assert rows(df) == [(["Felony\u00a0DUI", "A &lt; B"],)]
