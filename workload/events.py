"""Event facts to totals per key and year: counts, shares, flags, profiles, trends."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import flag, money, share
from keypanel.operators.aggregate import (count_where, median_of_counts, profile_by_key,
                                          profile_through)
from keypanel.operators.charts import long_series
from keypanel.operators.joins import exists_flag
from keypanel.plans.events import EventLayout, EventYear, event_totals_through, flagged_events
from keypanel.plans.history import history_profile, prior_share_by_threshold
from keypanel.plans.layout import expect_stored_by, save_bucketed
from keypanel.plans.testing import TestCodes, test_rates
from keypanel.plans.trend import trend
from keypanel.plans.yearly import refresh_totals, stored_totals
from keypanel.session import ensure_checkpoint_dir, removed_at_exit, stored
from keypanel.sources.files import flatten_json_column, union_by_name
from keypanel.sources.variant import json_records, take_fields
from workload.registry import in_years, query, table

# Up to this year the event carries its own flag, later a side table does.
LAST_OWN_FLAG = 1998
# Buckets of tables stored by id; for a size of one's own, layout.buckets_for.
BUCKETS = 16


def own_flag():
    """Orders of the old layout; those without a date count as new."""
    return F.coalesce(F.col("o_orderdate") < F.lit(f"{LAST_OWN_FLAG + 1}-01-01").cast("timestamp_ntz"), F.lit(False))


def customer_nation(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                               F.col("c_nationkey").alias("n_nationkey"))


def supplier_nation(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                               F.col("s_nationkey").alias("n_nationkey"))


def nation_names(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", "n_name")


@query("""
SELECT o_orderkey, o_custkey, o_totalprice
FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def slice_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter((F.col("o_orderstatus") == "F") & in_years("o_orderdate", 1997)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


def order_profile(spark, sf) -> DataFrame:
    """Orders per nation: count, amount, closed orders."""
    orders = table(spark, sf, "orders").withColumn("amount", money(F.col("o_totalprice")))
    return profile_through(orders, "o_custkey", customer_nation(spark, sf), ["n_nationkey"], {
        "orders": F.count("o_orderkey"),
        "amount": F.sum("amount"),
        "closed": count_where(F.col("o_orderstatus") == "F"),
    })


@query("""
SELECT c_nationkey AS n_nationkey, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS closed,
       round(count(*) FILTER (WHERE o_orderstatus = 'F') * CAST(100 AS DOUBLE) / count(*), 2) AS pct_closed
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1
""")
def events_by_key(spark, sf):
    profile = order_profile(spark, sf)
    return profile.select("n_nationkey", "orders", F.col("amount").cast("double").alias("amount"), "closed",
                          share(F.col("closed"), F.col("orders")).alias("pct_closed"))


def flagged_order_totals(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    flagged = exists_flag(orders, returned, "o_orderkey", "flagged")
    return event_totals_through(flagged, "o_custkey", customer_nation(spark, sf), ["n_nationkey"],
                                "o_orderkey", "o_totalprice")


def _published(totals: DataFrame, names: DataFrame) -> DataFrame:
    return totals.join(names, "n_nationkey").select(
        "n_name", "year", "total_events", F.col("total_measure").cast("double").alias("total_measure"),
        "flagged_events", F.col("flagged_measure").cast("double").alias("flagged_measure"), "pct_flagged")


@query("""
WITH flagged AS (
  SELECT o.*, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS hit,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders o),
totals AS (
  SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total_events, sum(amount) AS total_measure,
         count(*) FILTER (WHERE hit) AS flagged_events,
         coalesce(sum(amount) FILTER (WHERE hit), 0) AS flagged_measure
  FROM flagged JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)
SELECT n_name, year, total_events, CAST(total_measure AS DOUBLE) AS total_measure, flagged_events,
       CAST(flagged_measure AS DOUBLE) AS flagged_measure,
       round(CAST(flagged_measure AS DOUBLE) * 100 / nullif(CAST(total_measure AS DOUBLE), 0), 2) AS pct_flagged
FROM totals
""")
def flagged_events_by_key_year(spark, sf):
    return _published(flagged_order_totals(spark, sf), nation_names(spark, sf))


def drifting_orders(spark, sf) -> DataFrame:
    """Orders as two files of different layout, flagged in one table."""
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    returned = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    layout = EventLayout(key="o_custkey", event_id="o_orderkey", measure="o_totalprice",
                         flag_column="closed", side_code_column="l_returnflag", side_code="R")
    closed = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    old = orders.filter(own_flag()).withColumn("closed", closed)
    new = orders.filter(~own_flag())
    return flagged_events([EventYear(None, old), EventYear(None, new, returned)], layout)


def own_flag_series(spark, sf, first: int, last: int) -> DataFrame:
    """Totals of the years that carry their own flag; the side table is not read."""
    closed = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    orders = table(spark, sf, "orders").filter(in_years("o_orderdate", first, last) & own_flag()).withColumns(
        {"year": F.year("o_orderdate"), "closed": closed})
    layout = EventLayout(key="o_custkey", event_id="o_orderkey", measure="o_totalprice", flag_column="closed")
    totals = event_totals_through(flagged_events([EventYear(None, orders)], layout), "o_custkey",
                                  customer_nation(spark, sf), ["n_nationkey"], "o_orderkey", "o_totalprice")
    return totals.withColumn("method", F.lit("own_field"))


def drift_series(spark, sf) -> DataFrame:
    totals = event_totals_through(drifting_orders(spark, sf), "o_custkey", customer_nation(spark, sf),
                                  ["n_nationkey"], "o_orderkey", "o_totalprice")
    method = F.when(F.col("year") <= LAST_OWN_FLAG, "own_field").otherwise("side_table")
    return totals.withColumn("method", method)


DRIFT_SQL = """
WITH flagged AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN year(o_orderdate) <= 1998 THEN o_orderstatus = 'F'
              ELSE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') END AS hit
  FROM orders WHERE o_orderdate IS NOT NULL),
series AS (
  SELECT c_nationkey AS n_nationkey, year, count(*) AS total_events, sum(amount) AS total_measure,
         count(*) FILTER (WHERE hit) AS flagged_events, coalesce(sum(amount) FILTER (WHERE hit), 0) AS flagged_measure,
         CASE WHEN year <= 1998 THEN 'own_field' ELSE 'side_table' END AS method
  FROM flagged JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
"""


@query(DRIFT_SQL + """
SELECT n_nationkey, year, method, total_events, CAST(total_measure AS DOUBLE) AS total_measure, flagged_events,
       CAST(flagged_measure AS DOUBLE) AS flagged_measure,
       round(CAST(flagged_measure AS DOUBLE) * 100 / nullif(CAST(total_measure AS DOUBLE), 0), 2) AS pct_flagged
FROM series
""")
def totals_across_layouts(spark, sf):
    return drift_series(spark, sf).select(
        "n_nationkey", "year", "method", "total_events", F.col("total_measure").cast("double").alias("total_measure"),
        "flagged_events", F.col("flagged_measure").cast("double").alias("flagged_measure"), "pct_flagged")


@query(DRIFT_SQL + """
SELECT s.n_nationkey, n_name, year, flagged_events, total_events,
       round(flagged_events * CAST(100 AS DOUBLE) / nullif(total_events, 0), 1) AS pct
FROM series s JOIN nation n ON s.n_nationkey = n.n_nationkey
WHERE year BETWEEN 1996 AND 2000 AND method = 'own_field'
""")
def comparable_trend(spark, sf):
    return trend(own_flag_series(spark, sf, 1996, 2000), nation_names(spark, sf), "n_nationkey", ["n_name"], 1996, 2000,
                 "flagged_events", "total_events", method="own_field")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS orders
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
""")
def union_of_years(spark, sf):
    orders = table(spark, sf, "orders")
    slices = [part.select(F.year("o_orderdate").alias("year"), "o_orderstatus")
              for part in (orders.filter(own_flag()), orders.filter(~own_flag()))]
    return profile_by_key(union_by_name(slices), ["year", "o_orderstatus"], {"orders": F.count("*")})


LINE_TESTS = TestCodes(
    person="l_orderkey", person_type=None, injury="l_linestatus", status="l_returnflag", test="l_linenumber",
    killed="F", known="R", not_given="N",
    tests={"n_blood": 1, "n_breath": 2, "n_urine": 3, "n_vitreous": 4, "n_pbt": 7})


def line_test_rates(spark, sf) -> DataFrame:
    return test_rates(table(spark, sf, "lineitem"), "n_nationkey", LINE_TESTS,
                      lookup=supplier_nation(spark, sf), via="l_suppkey")


@query("""
WITH c AS (
  SELECT s_nationkey AS n_nationkey, count(*) AS total,
    count(*) FILTER (WHERE l_returnflag = 'R') AS known, count(*) FILTER (WHERE l_returnflag = 'N') AS not_given,
    count(*) FILTER (WHERE l_linestatus = 'F') AS killed,
    count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') AS killed_known,
    count(*) FILTER (WHERE l_linestatus <> 'F') AS surviving,
    count(*) FILTER (WHERE l_linestatus <> 'F' AND l_returnflag = 'R') AS surviving_known,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 1) AS n_blood,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 2) AS n_breath,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 3) AS n_urine,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 4) AS n_vitreous,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 7) AS n_pbt,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber NOT IN (1, 2, 3, 4, 7)) AS n_other
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT *, round(known * CAST(100 AS DOUBLE) / total, 1) AS pct_known_all,
  round(killed_known * CAST(100 AS DOUBLE) / nullif(killed, 0), 1) AS pct_known_killed,
  round(surviving_known * CAST(100 AS DOUBLE) / nullif(surviving, 0), 1) AS pct_known_surviving,
  round(n_blood * CAST(100 AS DOUBLE) / nullif(n_blood + n_breath + n_urine + n_vitreous + n_pbt + n_other, 0), 1) AS pct_blood
FROM c
""")
def test_rates_by_key(spark, sf):
    return line_test_rates(spark, sf)


def line_history(spark, sf) -> DataFrame:
    """Lines as vehicles: the line number gives the prior count, the quantity the speed."""
    lines = table(spark, sf, "lineitem")
    vehicles = lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                            F.nullif(F.col("l_linenumber") - 1, F.lit(3)).alias("prior"))
    impaired = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return history_profile(vehicles, impaired, "n_nationkey", ["l_orderkey", "l_linenumber"], "prior",
                           "l_quantity", unknown=[5, 6], speed_below=49, fast_from=30,
                           lookup=supplier_nation(spark, sf), via="l_suppkey")


HISTORY_SQL = """
WITH v AS (
  SELECT s_nationkey AS n_nationkey, nullif(l_linenumber - 1, 3) AS prior,
    CASE WHEN l_quantity > 0 AND l_quantity < 49 THEN l_quantity END AS speed,
    (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R') AS hit
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
k AS (SELECT *, prior IS NULL OR prior NOT IN (5, 6) AS known, coalesce(prior > 0, false) AS has_prior FROM v),
profile AS (
  SELECT n_nationkey, count(*) FILTER (WHERE known) AS known_history,
    count(*) FILTER (WHERE known AND has_prior) AS with_prior,
    count(*) FILTER (WHERE known AND hit) AS impaired_known_history,
    count(*) FILTER (WHERE known AND hit AND has_prior) AS impaired_with_prior,
    median(speed) AS median_speed, round(avg(speed), 1) AS mean_speed,
    round(count(*) FILTER (WHERE speed >= 30) * CAST(100 AS DOUBLE) / nullif(count(speed), 0), 1) AS pct_fast
  FROM k GROUP BY 1)
"""


@query(HISTORY_SQL + """
SELECT *, round(impaired_with_prior * CAST(100 AS DOUBLE) / nullif(impaired_known_history, 0), 1) AS pct_impaired_with_prior,
  round(with_prior * CAST(100 AS DOUBLE) / nullif(known_history, 0), 1) AS pct_all_with_prior
FROM profile
""")
def prior_history_by_key(spark, sf):
    return line_history(spark, sf)


@query(HISTORY_SQL + """
SELECT coalesce(threshold, 'none') AS threshold, count(*) AS keys,
  CAST(sum(impaired_with_prior) AS BIGINT) AS with_prior,
  CAST(sum(impaired_known_history) - sum(impaired_with_prior) AS BIGINT) AS without_prior,
  round(sum(impaired_with_prior) * CAST(100 AS DOUBLE) / nullif(sum(impaired_known_history), 0), 1) AS pct_with_prior
FROM profile JOIN (SELECT n_nationkey, CASE WHEN n_regionkey < 4 THEN CAST(n_regionkey AS VARCHAR) END AS threshold
                   FROM nation) USING (n_nationkey)
GROUP BY 1
""")
def prior_share(spark, sf):
    keys = table(spark, sf, "nation").select(
        "n_nationkey", F.when(F.col("n_regionkey") < 4, F.col("n_regionkey")).alias("threshold"))
    return prior_share_by_threshold(line_history(spark, sf), keys, "n_nationkey", "threshold")


@query("""
SELECT l_returnflag, count(*) AS n_speed, median(l_quantity) AS median_speed,
  round(avg(l_quantity), 1) AS mean_speed,
  round(count(*) FILTER (WHERE l_quantity >= 30) * CAST(100 AS DOUBLE) / count(*), 1) AS pct_fast
FROM lineitem WHERE l_quantity > 0 AND l_quantity < 49 GROUP BY 1
""")
def speed_profile(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_quantity > 0 AND l_quantity < 49")
    counted = lines.groupBy("l_returnflag", "l_quantity").agg(F.count("*").alias("n"))
    total, fast = F.sum("n"), F.sum(F.when(F.col("l_quantity") >= 30, F.col("n")))
    return counted.groupBy("l_returnflag").agg(
        total.alias("n_speed"), median_of_counts("l_quantity", "n").alias("median_speed"),
        F.round(F.sum(F.col("l_quantity") * F.col("n")) / total, 1).alias("mean_speed"),
        share(fast, total, 1).alias("pct_fast"))


@query("""
SELECT x, series, CAST(y AS DOUBLE) AS y FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS x, count(*) AS orders,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS closed,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
  FROM orders GROUP BY 1)
UNPIVOT (y FOR series IN (orders, closed, urgent))
""")
def long_series_by_year(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    yearly = profile_by_key(orders, ["year"], {
        "orders": F.count("*"),
        "closed": count_where(F.col("o_orderstatus") == "F"),
        "urgent": count_where(F.col("o_orderpriority") == "1-URGENT")})
    return long_series(yearly, "year", ["orders", "closed", "urgent"])


@query("""
SELECT event_type, count(*) AS events, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k
FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1
""")
def json_flatten(spark, sf):
    flat = flatten_json_column(table(spark, sf, "events"), "props", "k int")
    k = F.col("`props.k`")
    return profile_by_key(flat, ["event_type"], {
        "events": F.count("*"), "with_k": F.count(k), "sum_k": F.sum(k), "min_k": F.min(k), "max_k": F.max(k)})


@query("""
SELECT event_type, count(*) AS events, count(k) FILTER (event_type <> 'error') AS with_k,
  CAST(sum(k) FILTER (event_type <> 'error') AS BIGINT) AS sum_k, count(k) FILTER (event_type = 'error') AS retyped,
  CAST(sum(CASE WHEN user_id % 2 = 1 THEN user_id END) AS BIGINT) AS users_named
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1
""")
def drifting_json_fields(spark, sf):
    """Records in three layouts: k at the top, k as text inside an object beside the user, k as a text that is no number."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    newer = F.to_json(F.struct(F.struct(k.alias("k")).alias("data"), F.col("user_id").alias("user")))
    text = F.when(F.col("user_id") % 2 == 1, newer).otherwise(F.col("props"))
    text = F.when(F.col("event_type") == "error", F.regexp_replace(text, r'"k":\s*"?(\d+)"?', '"k": "no $1"')).otherwise(text)
    records = events.select("event_type", json_records(text).alias("record"))
    fields = take_fields(records, {"k": (["$.k", "$.data.k"], "int"), "user": ("$.user", "bigint")})
    return profile_by_key(fields, ["event_type"], {
        "events": F.count("*"), "with_k": F.count("k"), "sum_k": F.sum("k"),
        "retyped": count_where(F.array_contains("retyped", "k")), "users_named": F.sum("user")})


@query("""
SELECT o_orderpriority, count(*) AS orders, count(*) FILTER (hit) AS flagged FROM (
  SELECT o_orderpriority, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS hit FROM orders) GROUP BY 1
""")
def flags_of_tables_stored_by_id(spark, sf):
    """Orders and lines stored in buckets of the order's key, then flagged without dealing either of them again."""
    names = [f"keypanel_{part}_{uuid4().hex}" for part in ("orders", "lines")]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    try:
        orders = save_bucketed(orders, names[0], "o_orderkey", BUCKETS)
        lines = save_bucketed(lines, names[1], "l_orderkey", BUCKETS)
        returned = lines.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
        flagged = expect_stored_by(exists_flag(orders, returned, "o_orderkey", "flagged"), "o_orderkey", "l_orderkey")
        return stored(profile_by_key(flagged, ["o_orderpriority"], {"orders": F.count("*"), "flagged": F.sum("flagged").cast("bigint")}))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
       count(CASE WHEN year(o_orderdate) <= 1998 THEN o_orderpriority END) AS with_priority
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
""")
def union_with_missing_columns(spark, sf):
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate").alias("year")
    slices = [orders.filter(own_flag()).select(year, "o_orderpriority"), orders.filter(~own_flag()).select(year)]
    return profile_by_key(union_by_name(slices), ["year"], {
        "orders": F.count("*"), "with_priority": F.count("o_orderpriority")})


@query("""
SELECT l_returnflag, count(*) AS lines,
  CAST(sum(CAST(l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 480000) AS INTEGER)) AS BIGINT) AS in_large_orders
FROM lineitem GROUP BY 1
""")
def rarely_flagged_events(spark, sf):
    """Lines of the few largest orders: a bit array of their keys spares the other lines the join."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    large = table(spark, sf, "orders").filter("o_totalprice > 480000").select(F.col("o_orderkey").alias("l_orderkey"))
    flagged = exists_flag(lines, large, "l_orderkey", "large", hot_rows=None, prefilter=True)
    return profile_by_key(flagged, ["l_returnflag"], {"lines": F.count("*"), "in_large_orders": F.sum("large")})


@query("""
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total_events, CAST(sum(cents) AS BIGINT) AS total_measure,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS flagged_events,
  CAST(coalesce(sum(cents) FILTER (WHERE o_orderstatus = 'F'), 0) AS BIGINT) AS flagged_measure,
  round(coalesce(sum(cents) FILTER (WHERE o_orderstatus = 'F'), 0) * CAST(100 AS DOUBLE) / sum(cents), 2) AS pct_flagged
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) GROUP BY 1, 2
""")
def totals_of_stored_years(spark, sf):
    """Totals kept by year: a first refresh computes all years, a second one none."""
    layout = EventLayout(key="o_orderpriority", event_id="o_orderkey", measure="cents")
    year = F.year("o_orderdate")
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", year.alias("year"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
                                               flag(F.col("o_orderstatus") == "F").alias("flagged"))
    years = [r["year"] for r in orders.select("year").dropna().distinct().collect()]  # a few years
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/totals-{uuid4().hex}"
    removed_at_exit(spark, root)
    sources = {y: [f"{sf}/orders.parquet"] for y in years}
    for _ in range(2):
        refresh_totals(spark, root, sources, lambda wanted: orders.where(F.col("year").isin(wanted)), layout)
    return stored_totals(spark, root, layout)
