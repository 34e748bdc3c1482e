"""File readers.  Keys are never inferred: every column is read as text and cast."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.text import null_tokens
from keypanel.operators.clean import safe_cast
from keypanel.operators.columns import flatten_structs
from keypanel.sources import archives, html, variant, zipped

SOURCE_TYPES = ("csv", "json", "html_table", "html_scrape", "csv_zip", "csv_archive", "parquet")


@dataclass(frozen=True)
class SourceSpec:
    """Where a landed source lies and how to read it.

    ``columns`` maps column names to types; it is also the set of columns read.
    ``json_layout`` is ``lines`` (a record per line) or ``document`` (each file is
    one record or one array of records); ``schema`` spares JSON the inference pass.
    ``json_fields`` is for JSON whose layout drifts: names with their paths and types
    (``variant.take_fields``).
    """

    path: str
    type: str
    columns: dict[str, str] = field(default_factory=dict)
    separator: str = ","
    encoding: str = "UTF-8"
    null_columns: tuple[str, ...] = ()
    member: str = ""
    table_index: int | None = 0
    largest: bool = False
    row_selector: str | None = None
    field_map: dict[str, str] | None = None
    json_layout: str = "lines"
    schema: str | None = None
    json_fields: dict[str, tuple[str | list[str], str]] | None = None


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select the named columns and cast them, by name and never by position."""
    if not columns:
        return df
    return df.select(*[safe_cast(df, name, wanted).alias(name) for name, wanted in columns.items()])


def read_delimited(spark: SparkSession, path: str | list[str], columns: dict[str, str] | None = None,
                   separator: str = ",", encoding: str = "UTF-8",
                   null_columns: tuple[str, ...] = ()) -> DataFrame:
    """Delimited text with a header.

    A declared schema would be applied by position; reading text and selecting
    by header name keeps a reordered file right.  ``null_columns`` lists the
    columns in which "NA" and the like mean missing.
    """
    raw = (spark.read.option("header", True).option("sep", separator)
           .option("encoding", encoding).option("inferSchema", False).csv(path))
    for name in null_columns:
        raw = raw.withColumn(name, null_tokens(F.col(f"`{name}`")))
    return typed(raw, columns or {})


JSON_LAYOUTS = ("lines", "document")


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
              layout: str = "lines", encoding: str = "UTF-8") -> DataFrame:
    """JSON records with nested objects flattened to dotted columns.

    With ``lines`` every line is a record, files are split and a line that is not a
    record raises.  With ``document`` a file is one record or an array of records;
    a file whose first value is followed by another one raises, as the reader would
    leave the rest out.
    """
    if layout not in JSON_LAYOUTS:
        raise ValueError(f"unknown JSON layout {layout!r}; use one of {', '.join(JSON_LAYOUTS)}")
    reader = spark.read.option("encoding", encoding).option("mode", "FAILFAST")
    if layout == "lines":
        reader = reader.option("lineSep", "\n")
    else:
        reader = reader.option("multiLine", True)
        paths = [path] if isinstance(path, str) else path
        _one_value_each(spark, paths, encoding)
    return flatten_structs((reader.schema(schema) if schema else reader).json(path))


def _one_value_each(spark: SparkSession, paths: list[str], encoding: str) -> None:
    """Raise for a file that holds more than one JSON value, naming it."""

    def several(batches):
        import json

        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                text = content.decode(encoding).lstrip("\ufeff").strip()
                if text and text[json.JSONDecoder().raw_decode(text)[1]:].strip():
                    rows.append(name)
            yield batch.iloc[:0][["path"]] if not rows else batch[batch["path"].isin(rows)][["path"]]

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    found = files.mapInPandas(several, "path string").first()
    if found is not None:
        raise ValueError(f"{found['path']} holds more than one JSON value; read it with layout='lines'")


def flatten_json_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Parse a JSON text column and flatten it to ``column.field`` columns."""
    return flatten_structs(df.withColumn(column, F.from_json(F.col(column), schema)))


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a landed source by its declared type."""
    if spec.type == "csv":
        return read_delimited(spark, spec.path, spec.columns, spec.separator, spec.encoding,
                              spec.null_columns)
    if spec.type == "json" and spec.json_fields:
        return variant.take_fields(variant.read_json_records(spark, spec.path, spec.json_layout, spec.encoding), spec.json_fields)
    if spec.type == "json":
        records = read_json(spark, spec.path, spec.schema, spec.json_layout, spec.encoding)
        return typed(records, spec.columns)
    if spec.type == "parquet":
        table = spark.read.parquet(spec.path)
        return table.select(*spec.columns) if spec.columns else table
    if spec.type == "csv_zip":
        return typed(zipped.read_zipped_csv(spark, spec.path, spec.member, list(spec.columns),
                                            spec.encoding), spec.columns)
    if spec.type == "csv_archive":
        return typed(archives.read_archives(spark, spec.path, spec.member, list(spec.columns), spec.encoding), spec.columns)
    if spec.type == "html_table":
        pages = html.read_pages(spark, spec.path, spec.encoding)
        return html.named_table(html.page_tables(pages, spec.table_index, spec.largest), list(spec.columns))
    if spec.type == "html_scrape":
        if spec.row_selector is None or spec.field_map is None:
            raise ValueError("html_scrape needs row_selector and field_map")
        pages = html.read_pages(spark, spec.path, spec.encoding)
        return html.page_records(pages, spec.row_selector, spec.field_map)
    raise ValueError(f"unknown source type {spec.type!r}; use one of {', '.join(SOURCE_TYPES)}")


def inline_table(spark: SparkSession, key: str, columns: dict[str, dict]) -> DataFrame:
    """Small literal table from dictionaries that share their keys; a key must be in all."""
    first, *others = columns.values()
    shared = [k for k in first if all(k in values for values in others)]
    return spark.createDataFrame([(k, *[values[k] for values in columns.values()]) for k in shared], [key, *columns])


def read_yearly(read: Callable[[int], DataFrame], years: list[int]) -> tuple[list[tuple[int, DataFrame]], list[tuple[int, str]]]:
    """Open one source per year; a year that cannot be opened is reported, not fatal."""
    opened, failed = [], []
    for year in years:
        try:
            opened.append((year, read(year).withColumn("year", F.lit(year))))
        except Exception as error:  # noqa: BLE001 - any unreadable year is reported
            failed.append((year, str(error).splitlines()[0]))
    return opened, failed


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Concatenate tables by column name; a column a table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def failure_report(spark: SparkSession, failed: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(failed, "year int, reason string")


def stored_tables(spark: SparkSession) -> DataFrame:
    """Names of the stored tables and views."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean")


def run_sql(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Any SQL over stored tables and the given views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
