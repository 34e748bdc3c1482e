"""HTML tables and records: tasks read the events of a page, columns do the rest.

A small reader lists cells and elements; which table, row or element is meant, what
a header is and where merged cells reach are Spark expressions.  The reader is the
only Python code that runs on executors apart from opening ZIP archives.
"""

from __future__ import annotations

import re
import sys
from functools import reduce
from html.parser import HTMLParser
from typing import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# The most columns and rows a cell may span.
SPAN_LIMITS = {"colspan": 1000, "rowspan": 65534}
# Characters of pages whose events are handed on at a time.
CHARS = 1 << 20
HIDDEN = frozenset(("script", "style", "head"))
# A start tag that ends an open one: <li> ends <li>, <td> ends <td> and <th>, ...
CLOSED_BY = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
# ... but not beyond the element that holds them.
BOUNDARY = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
            "dt": ("dl",), "dd": ("dl",), "option": ("select",), "p": ("td", "li", "div", "article")}


class Element:
    """A tag with its place in the page: parent, last descendant, and its stretch of pieces of text.

    ``inside`` names what surrounds its children: the table, its row, whether in a thead, the innermost hidden element.
    """

    __slots__ = ("tag", "attributes", "parent", "around", "inside", "last", "first_piece", "end_piece")

    def classes(self) -> list[str]:
        return (self.attributes.get("class") or "").split()

    def span(self, name: str) -> int:
        """Cells a cell spans, within the limits of the HTML standard."""
        value = (self.attributes.get(name) or "1").strip()
        digits = value.isascii() and value.isdecimal()
        return min(max(int(value[:9]), 1), SPAN_LIMITS[name]) if digits else 1


class Reader(HTMLParser):
    """Lists the elements of a page and its pieces of text, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements, self.pieces, self.open = [], [], -1

    def _inside(self, at: int) -> tuple[int, int, bool, int]:
        return self.elements[at].inside if at >= 0 else (-1, -1, False, -1)

    def _close_to(self, at: int) -> None:
        while self.open != at:
            element = self.elements[self.open]
            element.last, element.end_piece = len(self.elements) - 1, len(self.pieces)
            self.open = element.parent

    def handle_starttag(self, tag, attrs):
        at = self.open if tag in CLOSED_BY else -1
        while at >= 0 and self.elements[at].tag not in BOUNDARY[tag]:
            above = self.elements[at].parent
            if self.elements[at].tag in CLOSED_BY[tag]:
                self._close_to(above)
            at = above
        if tag == "br":
            self.handle_data("\n")
            return
        element, own = Element(), len(self.elements)
        element.tag, element.attributes, element.parent = tag, dict(attrs), self.open
        element.around = table, row, head, hidden = self._inside(self.open)
        if tag == "table":
            table, row, head = own, -1, False
        element.inside = (table, own if tag == "tr" else row, head or tag == "thead", own if tag in HIDDEN else hidden)
        element.first_piece = len(self.pieces)
        self.elements.append(element)
        self.open = own
        if tag in VOID:
            self._close_to(element.parent)

    def handle_endtag(self, tag):
        at = self.open
        while at >= 0 and self.elements[at].tag != tag:
            at = self.elements[at].parent
        if at >= 0:
            self._close_to(self.elements[at].parent)

    def handle_data(self, data):
        self.pieces.append((data, self._inside(self.open)[3]))

    def close(self):
        super().close()
        self._close_to(-1)

    def texts(self, at: int) -> list[str]:
        """Pieces of text under an element, without those in hidden elements below it."""
        element = self.elements[at]
        return [text for text, hidden in self.pieces[element.first_piece:element.end_piece] if hidden <= at]


def parse(page: str) -> Reader:
    reader = Reader()
    reader.feed(page)
    reader.close()
    return reader


def table_events(page: str) -> list[list[dict]]:
    """The cells of each table, row by row, as they are written; rows of a nested table are its own."""
    reader, tables = parse(page), {}
    for at, element in enumerate(reader.elements):
        table, row, _, _ = element.around
        if element.tag == "table":
            tables[at] = {}
        elif element.tag in ("td", "th") and table >= 0 and row >= 0:
            own = tables[table].setdefault(row, {"head": reader.elements[row].around[2], "cells": []})
            own["cells"].append({"text": " ".join("".join(reader.texts(at)).split()), "th": element.tag == "th",
                                 "colspan": element.span("colspan"), "rowspan": element.span("rowspan")})
    return [list(rows.values()) for rows in tables.values()]


def element_events(page: str, wanted: list[tuple[str, set[str]]], read: list[tuple[str, set[str]]]) -> list[dict]:
    """Elements that fit one of the simple selectors ``wanted``, in order; with text if they fit one of ``read``."""
    reader = parse(page)

    def fits(element, parts):
        return any(tag in ("", element.tag) and classes.issubset(element.classes()) for tag, classes in parts)

    return [{"node": at, "last": e.last, "tag": e.tag, "classes": e.classes(),
             "text": " ".join(t for t in map(str.strip, reader.texts(at)) if t) if fits(e, read) else None}
            for at, e in enumerate(reader.elements) if fits(e, wanted)]


SIMPLE = re.compile(r"([\w-]+)?((?:\.[\w-]+)*)")


def selector_chain(selector: str) -> list[tuple[str, set[str]]]:
    """Parse ``tag``, ``.class``, ``tag.class`` and descendants of them into ``(tag, classes)`` from the outside in."""
    chain = []
    for part in selector.split():
        simple = SIMPLE.fullmatch(part)
        if simple is None:
            raise ValueError(f"selector {selector!r}: cannot use {part!r}")
        chain.append((simple[1] or "", set(simple[2].split(".")[1:])))
    if not chain:
        raise ValueError("the selector is empty")
    return chain


def read_pages(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Landed HTML files as ``(page_id, html)``, one row per file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("page_id"), F.decode("content", encoding).alias("html"))


def dealt(pages: DataFrame) -> DataFrame:
    """The rows dealt evenly to all tasks, one after the other.

    For pages that are made of short rows, or lie in few row groups: reading a page takes
    long for its size, and one scan task would read a million of them.
    """
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _listed(kind: pa.DataType) -> pa.DataType:
    return pa.list_(pa.field("element", kind))


CELL = pa.struct([("text", pa.string()), ("th", pa.bool_()), ("colspan", pa.int32()), ("rowspan", pa.int32())])
TABLES = _listed(_listed(pa.struct([("head", pa.bool_()), ("cells", _listed(CELL))])))
TABLES_DDL = "array<array<struct<head:boolean,cells:array<struct<text:string,th:boolean,colspan:int,rowspan:int>>>>>"
ELEMENTS = _listed(pa.struct([("node", pa.int32()), ("last", pa.int32()), ("tag", pa.string()),
                              ("classes", _listed(pa.string())), ("text", pa.string())]))
ELEMENTS_DDL = "array<struct<node:int,last:int,tag:string,classes:array<string>,text:string>>"


def _events(pages: DataFrame, key: Column, html: str, of_page, kind: pa.DataType, ddl: str) -> DataFrame:
    """(key, events, error): what was read of every page, or why it could not be parsed."""
    source = pages.where(F.col(html).isNotNull()).select(key.alias("key"), F.col(html).alias("html"))

    def read(page):
        try:
            return of_page(page), None
        except Exception as error:  # noqa: BLE001 - one page must not end the job
            return None, f"{type(error).__name__}: {error}"

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, chars, found = 0, 0, []
            for at, page in enumerate(batch.column(1), 1):
                page = page.as_py()
                found.append(read(page))
                chars += len(page)
                if chars > CHARS or at == batch.num_rows:
                    events, errors = zip(*found)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, at - begin), pa.array(events, kind), pa.array(errors, pa.string())],
                                                     names=["key", "events", "error"])
                    begin, chars, found = at, 0, []

    return source.mapInArrow(read_batches, f"key {source.schema['key'].dataType.simpleString()}, events {ddl}, error string")


def _header_rows(rows: Column) -> Column:
    """The number of header rows: those in a thead or with header cells only, before the first row of data."""
    data = F.array_position(F.transform(rows, lambda r: r["head"] | F.forall(r["cells"], lambda c: c["th"])), F.lit(False))
    return F.when(data == 0, F.size(rows)).otherwise(data - 1).cast("int")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


ROW_DDL = "array<struct<text:string,below:int>>"
BLOCK = 256  # rows that are joined to a table at a time, so that copying stays linear


def _below(row: Column) -> Column:
    """What a row of cells leaves hanging into the next: (place, text, rows below that)."""
    placed = F.transform(row, lambda cell, place: F.struct(place.alias("place"), cell["text"].alias("text"), (cell["below"] - 1).alias("below")))
    return F.filter(placed, lambda cell: cell["below"] >= 0)


def _filled(row: Column, hanging: Column) -> Column:
    """The row with the cells from above that come next."""
    return F.aggregate(hanging, row, lambda r, h: F.when(h["place"] == F.size(r), F.concat(r, F.array(F.struct(h["text"], h["below"])))).otherwise(r))


def _next_row(above: Column, cells: Column) -> Column:
    """A row's cells at their places, each repeated over the columns it spans, under the row above."""
    def placed(hanging):
        own = F.aggregate(cells, F.array().cast(ROW_DDL), lambda row, cell: F.concat(
            _filled(row, hanging), F.array_repeat(F.struct(cell["text"].alias("text"), (cell["rowspan"] - 1).alias("below")), cell["colspan"])))
        return _filled(own, hanging)

    return _let(_below(above), placed)


def _grid(rows: Column) -> Column:
    """The texts of a table's rows; a merged cell is repeated where it reaches.

    Tables with a cell over several rows are folded row by row, each row under the one before.
    """
    start = F.struct(F.array().cast(ROW_DDL).alias("row"), F.array().cast(f"array<{ROW_DDL}>").alias("done"))

    def step(state, row):
        return _let(_next_row(state["row"], row["cells"]), lambda placed: F.struct(
            placed.alias("row"), F.concat(state["done"], F.array(placed)).alias("done")))

    def block(state, first):
        part = F.aggregate(F.slice(rows, first, F.lit(BLOCK)), F.struct(state["row"].alias("row"), F.array().cast(f"array<{ROW_DDL}>").alias("done")), step)
        return _let(part, lambda p: F.struct(p["row"].alias("row"), F.concat(state["done"], F.array(p["done"])).alias("done")))

    blocks = F.struct(F.array().cast(ROW_DDL).alias("row"), F.array().cast(f"array<array<{ROW_DDL}>>").alias("done"))
    folded = F.flatten(F.aggregate(F.sequence(F.lit(1), F.size(rows), F.lit(BLOCK)), blocks, block)["done"])
    merged = F.exists(rows, lambda r: F.exists(r["cells"], lambda c: c["rowspan"] > 1))
    return F.when(merged, F.transform(folded, lambda row: F.transform(row, lambda cell: cell["text"]))).otherwise(
        F.transform(rows, lambda r: F.flatten(F.transform(r["cells"], lambda c: F.array_repeat(c["text"], c["colspan"])))))


def page_tables(pages: DataFrame, table_index: int | None = None, largest: bool = False,
                page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Cells of HTML tables: ``(page_id, table_idx, row_idx, is_header, cells, header, error)``.

    ``header`` holds the tidy names of the row's own table (NULL without a header
    row); ``error`` is set on the one row of a page that cannot be parsed.
    ``table_index`` keeps one table per page, ``largest`` the one with the most
    rows of data (the first of equals); by default all are kept.

    Tasks read cells and their spans; choice, headers and merged cells are array
    functions on the page's own row, without a shuffle.
    """
    found = _events(pages, F.col(page_id), html, table_events, TABLES, TABLES_DDL)
    found = found.select("key", "error", F.transform("events", lambda rows, i: F.struct(
        i.alias("table_idx"), _header_rows(rows).alias("headers"), rows.alias("rows"))).alias("tables"))
    if largest:
        sizes = F.transform("tables", lambda t: F.struct((F.size(t["rows"]) - t["headers"]).alias("data"), (-t["table_idx"]).alias("place")))
        found = found.withColumn("most", -F.array_max(sizes)["place"])
        found = found.withColumn("tables", F.filter("tables", lambda t: t["table_idx"] == F.col("most")))
    elif table_index is not None:
        found = found.withColumn("tables", F.filter("tables", lambda t: t["table_idx"] == table_index))
    tables = found.select("key", "error", F.explode_outer("tables").alias("t")).where("error IS NOT NULL OR size(t.rows) > 0")
    tables = tables.select("key", "error", "t.table_idx", "t.headers", _grid(F.col("t.rows")).alias("grid"))
    names = F.transform(F.get("grid", F.lit(0)), lambda c: F.regexp_replace(F.lower(c), "[ -]", "_"))
    rows = tables.withColumn("header", F.when(F.col("headers") > 0, names)).select(
        "key", "error", "table_idx", "headers", "header", F.posexplode_outer("grid").alias("row_idx", "cells"))
    return rows.select(F.col("key").alias(page_id), "table_idx", "row_idx", (F.col("row_idx") < F.col("headers")).alias("is_header"),
                       "cells", "header", "error")


def pages_without_table(pages: DataFrame, tables: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Pages on which the wanted table does not exist."""
    return pages.select(page_id).join(tables.select(page_id).distinct(), page_id, "left_anti")


def table_header(tables: DataFrame) -> list[str]:
    """Names of all columns that any of the tables has, by place; numbers for a table without a header.

    One row per name comes to the driver, where the names become the schema.
    """
    numbers = F.transform(F.sequence(F.lit(0), F.size("cells") - 1), lambda i: i.cast("string"))
    places = tables.filter("error IS NULL AND size(cells) > 0").select(F.posexplode(F.coalesce("header", numbers)).alias("place", "name"))
    found = places.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()
    if not found:
        raise ValueError("no table found")
    return [r["name"] for r in found]


def named_table(tables: DataFrame, columns: list[str] | None = None,
                page_id: str = "page_id") -> DataFrame:
    """Rows of data as named columns: each table's cells by its own header, or by place if it has none.

    Names are those of all tables unless given; a column that a table lacks is NULL there.
    """
    names = columns or table_header(tables)

    def cell(place: int, name: str) -> Column:
        own = F.nullif(F.array_position("header", F.lit(name)), F.lit(0))
        return F.try_element_at("cells", F.when(F.col("header").isNull(), place).otherwise(own).cast("int")).alias(name)

    return tables.filter("error IS NULL AND NOT is_header").select(page_id, *[cell(i, n) for i, n in enumerate(names, 1)])


def page_records(pages: DataFrame, row_selector: str, field_map: dict[str, str],
                 page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One record per element matched by the row selector.

    ``field_map`` maps output columns to selectors inside the row; an empty
    selector is the row's own text, an element that is not there gives "".  A page
    that cannot be parsed gives one row with its ``error``.

    Tasks read the elements that a part of a selector names; which of them match is
    found by windows over a page's elements: one lies inside another if the other
    starts before and its last descendant does not.
    """

    row_chain = selector_chain(row_selector)
    chains = {name: selector_chain(selector) if selector else None for name, selector in field_map.items()}
    read = [chain[-1] if chain else row_chain[-1] for chain in chains.values()]
    wanted = [part for chain in (row_chain, *chains.values()) if chain for part in chain]

    # Equal pages under one id have equal events; they share a window or not, with the same result.
    copy = F.concat_ws("-", F.md5(F.col(html).cast("binary")), F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
    key = F.struct(F.col(page_id).alias("id"), copy.alias("copy"))
    found = _events(pages, key, html, lambda page: element_events(page, wanted, read), ELEMENTS, ELEMENTS_DDL)
    elements = found.select(F.col("key.id").alias("id"), F.col("key.copy").alias("copy"), "error", F.inline_outer("events"))
    of_page = Window.partitionBy("id", "copy")
    before = of_page.orderBy("node").rangeBetween(Window.unboundedPreceding, -1)
    after = of_page.orderBy(F.desc("node")).rangeBetween(Window.unboundedPreceding, -1)

    def fits(part: tuple[str, set[str]]) -> Column:
        tag, classes = part
        tests = [F.col("tag") == tag] * bool(tag) + [F.array_contains("classes", c) for c in sorted(classes)]
        return reduce(Column.__and__, tests, F.col("node").isNotNull())

    def matched(df: DataFrame, name: str, chain: list[tuple[str, set[str]]]) -> DataFrame:
        """Add whether an element fits the last part of the chain and lies in elements that fit the others, in order."""
        df = df.withColumn(name, fits(chain[0]))
        for part in chain[1:]:
            reach = F.max(F.when(F.col(name), F.col("last"))).over(before)
            df = df.withColumn(name, fits(part) & F.coalesce(reach >= F.col("node"), F.lit(False)))
        return df

    elements = matched(elements, "_row", row_chain)
    values = []
    for number, (name, chain) in enumerate(chains.items()):
        if chain is None:
            values.append(F.col("text").alias(name))
            continue
        elements = matched(elements, f"_hit{number}", chain)
        hit = F.when(F.col(f"_hit{number}"), F.struct("node", "text"))
        elements = elements.withColumn(f"_field{number}", F.last(hit, ignorenulls=True).over(after))
        field = F.col(f"_field{number}")
        values.append(F.when(F.col("error").isNull(), F.coalesce(F.when(field["node"] <= F.col("last"), field["text"]), F.lit(""))).alias(name))
    records = elements.where("_row OR error IS NOT NULL")
    index = F.when(F.col("error").isNull(), F.dense_rank().over(of_page.orderBy("node")) - 1)
    return records.select(F.col("id").alias(page_id), index.cast("int").alias("record_idx"), *values, "error")


def heading(html: Column, tag: str = "h1") -> Column:
    """Raw inner HTML of the first such element, without Python."""
    return F.regexp_extract(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)
