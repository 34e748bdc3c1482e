"""Cleaning, quality reports, profiles, codebooks and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.operators.clean import clean
from keypanel.operators.profile import numeric_summary, value_counts
from keypanel.operators.columns import lower_names, tidy_names
from keypanel.operators.quality import (absent_keys, audit_tables, expect_rows, expect_values, quality, repeated_keys,
                                        sparse_columns, unsupported_values)
from keypanel.plans.publish import Provenance, codebook, null_report, provenance, strip_columns
from keypanel.sources.files import run_sql, stored_tables
from workload.keys import CUSTOMER_SQL, customer_panel
from workload.registry import query, table

DIRTY = {
    "status": "o_orderstatus",
    "priority": "concat('  ', o_orderpriority, ' ')",
    "year": "concat(CAST(year(o_orderdate) AS STRING), CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END)",
    "level": "concat(CAST(year(o_orderdate) - 1990 AS STRING), '.7')",
    "amount": "concat('−', CAST(CAST(floor(o_totalprice / 100000) AS INT) AS STRING), '.5')",
}
DIRTY_SQL = ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in DIRTY.items())


@query(f"""
SELECT DISTINCT status, trim(priority) AS priority, TRY_CAST(year AS INTEGER) AS year, TRY_CAST(level AS INTEGER) AS level,
  TRY_CAST(replace(amount, '−', '-') AS DOUBLE) AS amount
FROM (SELECT {DIRTY_SQL} FROM orders) WHERE status <> 'O' AND year <> '1996'
""")
def clean_pass(spark, sf):
    dirty = table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in DIRTY.items()])
    return clean(dirty, casts={"year": "int", "level": "int", "amount": "double"}, strips=["priority"],
                 where="status <> 'O' AND year <> '1996'")


LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@query(f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1
""")
def clean_keep_first(spark, sf):
    return clean(table(spark, sf, "lineitem"), subset=["l_orderkey", "l_linenumber"], order_by=LINE_ORDER)


def labelled_documents(spark, sf) -> DataFrame:
    """Documents with their labels.  Texts are compared by digest, so the join carries digests alone."""
    texts = table(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("text"))
    return texts.join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED_SQL = """
WITH d AS (SELECT documents.doc_id, lang, source, text, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
     c AS (SELECT count(*) AS n, {nulls} FROM d)
"""
_COLUMNS = ["doc_id", "lang", "source", "text", "quality", "toxic"]
LABELLED_SQL = LABELLED_SQL.format(nulls=", ".join(f"count({c}) AS n_{c}" for c in _COLUMNS))


def _share_sql(column: str) -> str:
    return f"CAST(round(CAST((n - n_{column}) / CAST(n AS DOUBLE) AS DECIMAL(18,6)), 4) AS DOUBLE)"


@query(LABELLED_SQL + """
SELECT 'row_count' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(n AS DOUBLE) AS value, 'ok' AS status FROM c
UNION ALL SELECT 'duplicate_count', NULL, CAST(n - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS DOUBLE), 'ok' FROM c
""" + "".join(f"""UNION ALL SELECT 'null_share', '{c}', {_share_sql(c)},
  CASE WHEN (n - n_{c}) / CAST(n AS DOUBLE) > 0.1 THEN 'warn' ELSE 'ok' END FROM c
""" for c in _COLUMNS) + "UNION ALL SELECT 'missing_column', 'license', NULL, 'warn'")
def quality_report(spark, sf):
    return quality(labelled_documents(spark, sf), required=["lang", "license"])


@query("""
""" + " UNION ALL ".join(f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
  CAST(round(CAST((count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS DECIMAL(18,6)), 4) AS DOUBLE) AS null_share FROM {source}
""" for t, columns, source in (
    ("labels", ("doc_id", "quality", "toxic"), "labels"),
    ("panel", ("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", "orders", "spent", "pending"), f"({CUSTOMER_SQL} SELECT * FROM panel)"))
    for c in columns))
def audit_of_tables(spark, sf):
    return audit_tables({"labels": table(spark, sf, "labels"), "panel": customer_panel(spark, sf)})


@query(LABELLED_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", n AS rows, n - n_{c} AS nulls, {_share_sql(c)} AS null_share FROM c
        WHERE (n - n_{c}) / CAST(n AS DOUBLE) > 0.1""" for c in _COLUMNS))
def sparse_column_report(spark, sf):
    return sparse_columns(labelled_documents(spark, sf), max_null_share=0.1)


@query("""SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS total_price FROM orders""")
def tidy_column_names(spark, sf):
    return tidy_names(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" Order Key "), F.col("o_orderstatus").alias("Order-Status"), F.col("o_totalprice").alias("Total Price")))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def lower_column_names(spark, sf):
    return lower_names(table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("S_SuppKey"), F.col("s_name").alias("S_Name"), F.col("s_nationkey").alias("S_NATIONKEY"), "s_acctbal"))


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def listed_columns_dropped(spark, sf):
    return strip_columns(table(spark, sf, "customer"), ("c_name", "c_acctbal", "c_phone"))


@query("SELECT * FROM nation")
def expected_number_of_rows(spark, sf):
    return expect_rows(table(spark, sf, "nation"), 25)


@query("SELECT * FROM region")
def expected_totals(spark, sf):
    return expect_values(table(spark, sf, "region"), {
        "keys": (F.sum("r_regionkey"), 10), "names": (F.count_distinct("r_name"), 5)})


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, {share} AS null_share,
  CASE WHEN '{c}' IN ('doc_id', 'quality') AND count(*) > count({c}) THEN 'critical'
       WHEN (count(*) - count({c})) / CAST(count(*) AS DOUBLE) > 0.1 THEN 'warn' ELSE 'ok' END AS status
  FROM documents LEFT JOIN labels USING (doc_id)""" for c in _COLUMNS
  for share in [f"CAST(round(CAST((count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS DECIMAL(18,6)), 4) AS DOUBLE)"]))
def critical_columns(spark, sf):
    return null_report(labelled_documents(spark, sf), ("doc_id", "quality"), 0.1)


@query(" UNION ALL ".join(f"SELECT 'panel_{t}' AS table_name, true AS is_temporary, count(*) AS rows FROM {t}"
                          for t in ("nation", "orders", "supplier")))
def stored_table_sizes(spark, sf):
    names = ["nation", "orders", "supplier"]
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(f"panel_{name}")
    sizes = reduce(DataFrame.unionByName, [spark.table(f"panel_{n}").agg(F.count("*").alias("rows")).select(
        F.lit(f"panel_{n}").alias("table_name"), "rows") for n in names])
    return stored_tables(spark).join(sizes, "table_name").select("table_name", "is_temporary", "rows")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def keys_without_values(spark, sf):
    return absent_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def keys_not_unique(spark, sf):
    return repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(CUSTOMER_SQL + "SELECT c_custkey, pending FROM panel WHERE pending IS NOT NULL AND c_acctbal < 0")
def value_without_its_condition(spark, sf):
    panel = customer_panel(spark, sf).withColumn("credit", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return unsupported_values(panel, F.col("pending"), F.col("credit")).select("c_custkey", "pending")


@query("""
WITH long AS (
  SELECT 'p_name' AS "column", p_name AS value FROM part UNION ALL SELECT 'p_brand', p_brand FROM part
  UNION ALL SELECT 'p_type', CASE WHEN p_type <> 'PROMO' THEN p_type END FROM part
  UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part),
counts AS (SELECT "column", value, count(*) AS n FROM long GROUP BY 1, 2)
SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC NULLS LAST) AS INTEGER) AS rank
FROM counts QUALIFY rank <= 5
""")
def frequent_values(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_name", "p_brand", F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("p_type"), "p_size")
    return value_counts(parts, top=5)


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std,
  round(min({c}), 2) AS min, round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
  round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max FROM lineitem"""
                          for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def numeric_profile(spark, sf):
    return numeric_summary(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


_TYPES = {"doc_id": "bigint", "lang": "string", "source": "string", "text": "string", "quality": "int", "toxic": "int"}
DESCRIPTIONS = {"doc_id": "Document id", "lang": "Language code"}


@query(LABELLED_SQL + " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{_TYPES[c]}' AS type, n_{c} AS non_null, n AS total,
        round(n_{c} * CAST(100 AS DOUBLE) / n, 1) AS pct,
        '{DESCRIPTIONS.get(c, "_No description provided._")}' AS description FROM c""" for i, c in enumerate(_COLUMNS)))
def codebook_table(spark, sf):
    return codebook(labelled_documents(spark, sf).select(*_COLUMNS), DESCRIPTIONS)


# Tables of the data set; those in the first row have a registered source.
REGISTERED = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]
UNREGISTERED = ["benchmark", "conversations", "documents", "embeddings", "events", "labels", "pages"]
RETRIEVED = "2024-01-31"


@query(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows,
        {"'sales star schema'" if t in REGISTERED else 'CAST(NULL AS VARCHAR)'} AS source_name,
        {f"'{RETRIEVED}'" if t in REGISTERED else 'CAST(NULL AS VARCHAR)'} AS retrieved,
        {int(t not in REGISTERED)} AS unregistered""" for t in REGISTERED + UNREGISTERED))
def provenance_of_tables(spark, sf):
    registry = provenance(spark, [Provenance(
        t, "sales star schema", "", "public domain", methodology="generated with a fixed seed",
        series_breaks="none", retrieved=RETRIEVED) for t in REGISTERED])
    sizes = reduce(DataFrame.unionByName, [
        table(spark, sf, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in REGISTERED + UNREGISTERED])
    return sizes.join(registry, "table_name", "left").select(
        "table_name", "rows", "source_name", "retrieved", F.col("source_name").isNull().cast("int").alias("unregistered"))


@query("""
SELECT c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 2) AS avg_acctbal FROM customer GROUP BY 1
""")
def sql_over_views(spark, sf):
    return run_sql(spark, """
        SELECT c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 2) AS avg_acctbal
        FROM panel_customer GROUP BY c_mktsegment""", {"panel_customer": table(spark, sf, "customer")})
