"""JSON whose layout drifts between files: records as VARIANT, fields taken by path.

No schema is declared and no pass infers one.  A field may lie at other paths or have
another type in some files; what cannot be read as the wanted type is NULL and reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUTS = ("lines", "document")


def json_records(text: Column) -> Column:
    """A JSON text as VARIANT; NULL for one that is not JSON or beyond Spark's size of a VARIANT."""
    return F.try_parse_json(text)


def read_json_records(spark: SparkSession, path: str | list[str], layout: str = "lines", encoding: str = "UTF-8") -> DataFrame:
    """``(file, record, broken)``: a record per line (of UTF-8), or per element of a file that is an array.

    A line or file that is not JSON gives a row with its beginning in ``broken``; empty
    lines and files give none.  Documents must fit into one VARIANT; ``files.read_json`` takes larger ones.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown JSON layout {layout!r}; use one of {', '.join(LAYOUTS)}")
    if layout == "lines" and encoding.upper() not in ("UTF-8", "UTF8"):
        raise ValueError("lines are read as UTF-8; read other encodings as documents")
    if layout == "lines":
        lines = spark.read.text(path)
        texts = lines.select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("text"))
    else:
        files = spark.read.format("binaryFile").load(path)
        texts = files.select(F.col("path").alias("file"), F.decode("content", encoding).alias("text"))
    texts = texts.withColumn("text", F.regexp_replace("text", r"^\x{FEFF}", "")).where("trim(text) <> ''")
    parsed = texts.withColumn("whole", json_records(F.col("text")))
    broken = F.when(F.col("whole").isNull(), F.substring("text", 1, 100)).alias("broken")
    if layout == "lines":
        return parsed.select("file", F.col("whole").alias("record"), broken)
    elements = F.when(F.schema_of_variant("whole").startswith("ARRAY"), F.col("whole").cast("array<variant>")).otherwise(F.array("whole"))
    return parsed.select("file", F.explode(elements).alias("record"), broken)


def _found(record: str, path: str) -> Column:
    """The value at a path, NULL if it is missing or null there."""
    value = F.try_variant_get(record, path, "variant")
    return F.when(value.isNotNull() & ~F.is_variant_null(value), value)


def take_fields(records: DataFrame, fields: dict[str, tuple[str | list[str], str]], record: str = "record") -> DataFrame:
    """The records with a column per field and ``retyped``, in place of the VARIANT.

    ``fields`` maps a name to its paths (the first that gives a value of the type counts) and type.
    A field that no path finds, or finds as null, is NULL; one that is there in another type is cast
    if its value allows, else it is NULL and named in ``retyped``.
    """
    values, retyped = [], []
    for name, (paths, wanted) in fields.items():
        paths = [paths] if isinstance(paths, str) else list(paths)
        value = F.coalesce(*[F.try_variant_get(record, path, wanted) for path in paths])
        there = reduce(Column.__or__, [_found(record, path).isNotNull() for path in paths])
        values.append(value.alias(name))
        retyped.append(F.when(value.isNull() & there, F.lit(name)))
    others = [F.col(f"`{c}`") for c in records.columns if c != record and c not in fields and c != "retyped"]
    return records.select(*others, *values, F.array_compact(F.array(*retyped)).alias("retyped"))


def field_report(records: DataFrame, fields: dict[str, tuple[str | list[str], str]], record: str = "record") -> DataFrame:
    """Per field: records, those without it, those in which it is not of the wanted type, and the layout of its values.

    One aggregate over the records.
    """
    taken = take_fields(records.withColumn("_record", F.col(f"`{record}`")), fields, record)
    measures = []
    for name, (paths, _) in fields.items():
        paths = [paths] if isinstance(paths, str) else list(paths)
        value = F.coalesce(*[_found("_record", path) for path in paths])
        bad = F.array_contains("retyped", name)
        measures.append(F.struct(
            F.lit(name).alias("field"), F.count("*").alias("records"), F.count_if(value.isNull()).alias("missing"),
            F.count_if(bad).alias("retyped"), F.schema_of_variant_agg(value).alias("layout")))
    return taken.agg(F.array(*measures).alias("fields")).select(F.inline("fields"))


def layout_of(records: DataFrame, record: str = "record") -> str:
    """The layout that covers all records, as text; parts whose type differs are VARIANT."""
    return records.agg(F.schema_of_variant_agg(record).alias("layout")).first()["layout"]
