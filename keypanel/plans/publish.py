"""Sinks: stored tables, files, packages with a codebook, the provenance registry."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from textwrap import dedent
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.rates import share
from keypanel.operators.quality import MAX_NULL_SHARE, null_audit, null_shares
from keypanel.plans import versions

FORMATS = ("csv", "parquet", "json", "orc")

# The wording of a codebook.
NO_DESCRIPTION = "_No description provided._"
CODEBOOK_TITLE = "# {title} — Dataset Codebook\nGenerated: {today}\n"
CODEBOOK_ENTRY = ("### `{column}`\n- **Type**: `{type}`\n- **Non-null**: {non_null:,} / {total:,} ({known})\n"
                  "- **Description**: {description}\n")


def save_table(df: DataFrame, name: str, replace: bool = True) -> None:
    """Store a table; without ``replace`` an existing one is an error.

    A new table is written under another name first.  The old one stays as it is while
    that lasts, if it fails, and may be read by ``df`` itself.
    """
    spark, mark = df.sparkSession, uuid4().hex[:12]
    if not replace or not spark.catalog.tableExists(name):
        df.write.mode("errorifexists").saveAsTable(name)
        return
    aside, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        df.write.saveAsTable(aside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        raise
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet in place of what is there, which stays if the writing fails."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    versions.replace_folder(df.sparkSession, path, writer.parquet)
    return path


def save_csv(df: DataFrame, path: str, single_file: bool = False, encoding: str = "UTF-8") -> str:
    """CSV with a header; ``single_file`` is for small published tables."""
    out = df.coalesce(1) if single_file else df
    versions.replace_folder(df.sparkSession, path, out.write.option("header", True).option("encoding", encoding).csv)
    return path


def strip_columns(df: DataFrame, listed: tuple[str, ...]) -> DataFrame:
    """Drop the listed (personal) columns that are present."""
    return df.drop(*listed)


def codebook(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """Per column: type, known values, rows, percentage known, description."""
    counts = df.agg(F.count("*").alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _codebook_of(counts, df.schema, descriptions)


def _codebook_of(counts: DataFrame, schema: T.StructType, descriptions: dict[str, str] | None) -> DataFrame:
    """The codebook from one row with ``total`` and the known values ``n0``, ``n1``, ... of the columns."""
    texts = descriptions or {}
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"n{i}").alias("non_null"), F.lit(texts.get(f.name, NO_DESCRIPTION)).alias("description"))
        for i, f in enumerate(schema.fields)])
    return (counts.select("total", F.explode(entries).alias("e")).select("e.*", "total")
            .select("position", "column", "type", "non_null", "total",
                    share(F.col("non_null"), F.col("total"), 1).alias("pct"), "description"))


def render_codebook(book: DataFrame, title: str, notes: str = "",
                    sections: dict[str, list[str]] | None = None, caveats: list[str] | None = None) -> str:
    """Codebook as Markdown: one entry per column, grouped when sections are given.

    Collects one row per column of the table.
    """
    rows = {r["column"]: r for r in book.orderBy("position").collect()}
    groups = sections or {"Columns": list(rows)}
    grouped = {c for cs in groups.values() for c in cs}
    rest = [c for c in rows if c not in grouped]
    if rest:
        groups = {**groups, "Other columns": rest}
    parts = [CODEBOOK_TITLE.format(title=title, today=date.today().isoformat())]
    for heading, columns in groups.items():
        parts.append(f"## {heading}\n")
        for c in columns:
            known = "n/a" if rows[c]["pct"] is None else f"{rows[c]['pct']:.1f}%"
            parts.append(CODEBOOK_ENTRY.format(known=known, **rows[c].asDict()))
    if caveats:
        numbered = "\n".join(f"{i}. {text}" for i, text in enumerate(caveats, 1))
        parts.append(f"## Caveats\n\n{numbered}\n")
    if notes:
        parts.append(f"## Notes\n\n{dedent(notes).strip()}\n")
    return "\n".join(parts)


@dataclass(frozen=True)
class PackageSpec:
    """What to publish and where."""

    folder: str
    name: str
    title: str = ""
    formats: tuple[str, ...] = ("csv", "parquet")
    personal_columns: tuple[str, ...] = ()
    descriptions: dict[str, str] = field(default_factory=dict)
    sections: dict[str, list[str]] | None = None
    caveats: list[str] | None = None
    notes: str = ""
    include_codebook: bool = True
    encoding: str = "UTF-8"
    single_file: bool = False


def package(df: DataFrame, spec: PackageSpec) -> dict[str, str]:
    """Strip personal columns, write every format and the codebook as a new version; returns the paths."""
    return publish(df, spec)[0]


def publish(df: DataFrame, spec: PackageSpec, expected_rows: int | None = None,
            critical: tuple[str, ...] = (), max_null_share: float = MAX_NULL_SHARE,
            totals: dict[str, tuple[Column, float]] | None = None) -> tuple[dict[str, str], DataFrame]:
    """Check a table while it is written, then make it the current version; returns the paths and the null report.

    The table is computed once: rows, known values of every column and the ``totals``
    (aggregates with the value each must have) are observed in the pass that writes
    the first format, and the codebook and the report are made of them.  Other formats are copied
    from the first.  A wrong number of rows or total raises before the version is
    committed, and the one before stays current (``versions.read_version``).  The report
    marks critical columns with any null and other columns above the null share.
    """
    unknown = [f for f in spec.formats if f not in FORMATS]
    if unknown:
        raise ValueError(f"unknown formats {unknown}; use {', '.join(FORMATS)}")
    spark, root, version = df.sparkSession, f"{spec.folder}/{spec.name}", versions.stage()
    base = f"{root}/{version}/{spec.name}"
    try:
        seen = Observation()
        wanted = totals or {}
        observed = df.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
                              *[column.alias(f"t{i}") for i, (column, _) in enumerate(wanted.values())])
        table = strip_columns(observed, spec.personal_columns)
        # Several formats without Parquet are copied from a Parquet copy that is not published.
        first = spec.formats[0] if len(spec.formats) == 1 else "parquet"
        _write(table, first, f"{base}.{first}", spec)
        found = seen.get
        wrong = {n: (found[f"t{i}"], want) for i, (n, (_, want)) in enumerate(wanted.items()) if found[f"t{i}"] != want}
        if expected_rows is not None and found["total"] != expected_rows:
            raise ValueError(f"expected {expected_rows} rows, found {found['total']}")
        if wrong:
            raise ValueError(f"unexpected totals (found, expected): {wrong}")
        for kind in [f for f in spec.formats if f != first]:
            _write(spark.read.schema(table.schema).parquet(f"{base}.parquet"), kind, f"{base}.{kind}", spec)
        if first not in spec.formats:
            versions.remove(spark, f"{base}.{first}")
        files = {f: f"{spec.name}.{f}" for f in spec.formats}
        if spec.include_codebook:
            kept = [i for i, c in enumerate(df.columns) if c in table.columns]
            counts = spark.createDataFrame([(found["total"], *[found[f"n{i}"] for i in kept])],
                                           ", ".join(["total bigint", *[f"n{j} bigint" for j in range(len(kept))]]))
            text = render_codebook(_codebook_of(counts, table.schema, spec.descriptions), spec.title or spec.name,
                                   spec.notes, spec.sections, spec.caveats)
            files["codebook"] = f"{spec.name}_codebook"
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}_codebook")
    except Exception:
        versions.remove(spark, f"{root}/{version}")
        raise
    number = versions.commit(spark, root, version, files, {"rows": found["total"]})
    nulls = spark.createDataFrame([(found["total"], *[found["total"] - found[f"n{i}"] for i in range(len(df.columns))])],
                                  ", ".join(["rows bigint", *[f"n{i} bigint" for i in range(len(df.columns))]]))
    return versions.manifest(spark, root, number)["files"], _with_status(null_shares(nulls, df.columns), critical, max_null_share)


def _write(table: DataFrame, kind: str, path: str, spec: PackageSpec) -> None:
    out = table.coalesce(1) if spec.single_file and kind != "parquet" else table
    writer = out.write.option("header", True).option("encoding", spec.encoding) if kind == "csv" else out.write
    writer.format(kind).save(path)


def null_report(table: DataFrame, critical: tuple[str, ...] = (), max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """Nulls per column; critical columns with any, and others above the share, are marked."""
    return _with_status(null_audit(table), critical, max_null_share)


def _with_status(audit: DataFrame, critical: tuple[str, ...], max_null_share: float) -> DataFrame:
    status = (F.when(F.col("column").isin(*critical) & (F.col("nulls") > 0), "critical")
              .when(F.col("raw_share") > max_null_share, "warn").otherwise("ok"))
    return audit.withColumn("status", status).drop("raw_share")


@dataclass(frozen=True)
class Provenance:
    """Where a stored table comes from.  Method and series breaks are required."""

    table_name: str
    source_name: str
    url: str
    license: str
    methodology: str
    series_breaks: str
    notes: str = ""
    retrieved: str = field(default_factory=lambda: date.today().isoformat())

    def __post_init__(self):
        if not self.methodology or not self.series_breaks:
            raise ValueError(f"{self.table_name}: methodology and series_breaks must be stated")


PROVENANCE_COLUMNS = ["table_name", "source_name", "url", "license", "notes", "retrieved",
                      "methodology", "series_breaks"]


def provenance(spark: SparkSession, records: list[Provenance]) -> DataFrame:
    """The registry as a table."""
    rows = [tuple(getattr(r, c) for c in PROVENANCE_COLUMNS) for r in records]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PROVENANCE_COLUMNS))


def unregistered(tables: DataFrame, registry: DataFrame) -> DataFrame:
    """Stored tables without a source."""
    return tables.join(registry.select("table_name"), "table_name", "left_anti")
