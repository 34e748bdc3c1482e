"""Key tables: master tables, rates, classes, cohorts, rankings and map data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import fixed_round, flag, money, share, sufficient
from keypanel.functions.rules import penalty_class
from keypanel.functions.sql import register
from keypanel.functions.text import pad_key
from keypanel.operators.aggregate import (count_where, distinct_values, mean_with_error,
                                          profile_by_key, profile_through)
from keypanel.operators.charts import map_categories, map_values, scatter_points, value_domain
from keypanel.operators.cohorts import bucket_counts, compare_cohorts, flag_matrix, summarize
from keypanel.operators.joins import label_join, outer_merge, unmatched_labels
from keypanel.operators.profile import table_stats
from keypanel.operators.ranking import largest, top_bottom
from keypanel.plans.attributes import mandatory
from keypanel.plans.master import RateSpec, rates_table, wide_master
from keypanel.plans.reference import (code_list, key_master, structural_controls, with_overrides,
                                      yearly_columns)
from keypanel.sources.files import run_sql
from workload.events import customer_nation, order_profile
from workload.registry import query, table


def customers_by_nation(spark, sf) -> DataFrame:
    customers = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return profile_by_key(customers, ["n_nationkey"], {
        "customers": F.count("*"), "customers_in_debt": count_where(F.col("c_acctbal") < 0)})


def lines_by_nation(spark, sf) -> DataFrame:
    """Lines, quantity, and lines of suppliers in debt (NULL without any), in one pass."""
    by_supplier = profile_by_key(table(spark, sf, "lineitem"), ["l_suppkey"], {
        "lines": F.count("*"), "quantity": F.sum(money(F.col("l_quantity")))})
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    joined = by_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return profile_by_key(joined, ["n_nationkey"], {
        "lines": F.sum("lines"), "quantity": F.sum("quantity"),
        "debtor_lines": F.sum(F.when(F.col("s_acctbal") < 0, F.col("lines")))})


def line_facts(spark, sf) -> DataFrame:
    """Test rates, median speed and debtors' lines per nation: one scan, one aggregate.

    Speeds are a short list of values, so the state of their median is a short list of counts.
    """
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"), "s_acctbal")
    known, killed = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    speed = F.when((F.col("l_quantity") > 0) & (F.col("l_quantity") < 49), F.col("l_quantity"))
    debtor = count_where(F.col("s_acctbal") < 0)
    facts = profile_by_key(table(spark, sf, "lineitem").join(suppliers, "l_suppkey"), ["n_nationkey"], {
        "total": F.count("l_orderkey"), "known": count_where(known), "killed": count_where(killed),
        "killed_known": count_where(known & killed), "median_speed": F.percentile(speed, F.lit(0.5)),
        "debtor_lines": F.nullif(debtor, F.lit(0))})
    return facts.select("n_nationkey", "total", share(F.col("known"), F.col("total"), 1).alias("pct_known_all"),
                        share(F.col("killed_known"), F.col("killed"), 1).alias("pct_known_killed"),
                        "median_speed", "debtor_lines")


def nations(spark, sf) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name")


@query("""
WITH c AS (SELECT c_nationkey, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS d FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
SELECT printf('%02d', n_nationkey) AS key, n_name, r_name, c.n AS population, c.d AS population_in_debt,
       s.n AS suppliers
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN c ON c_nationkey = n_nationkey LEFT JOIN s ON s_nationkey = n_nationkey
""")
def key_master_table(spark, sf):
    reference = nations(spark, sf)
    master = key_master(reference, [(customers_by_nation(spark, sf), {
        "customers": "population", "customers_in_debt": "population_in_debt"})], "n_nationkey")
    # The supplier counts are keyed by a name in another spelling, not by the code.
    suppliers = (table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey"))
                 .agg(F.count("*").alias("suppliers")).join(reference, "n_nationkey")
                 .select(F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("name"), "suppliers"))
    return label_join(master, suppliers, "n_name", "name").select(
        pad_key(F.col("n_nationkey")).alias("key"), "n_name", "r_name", "population", "population_in_debt",
        "suppliers")


@query("""
SELECT n_name FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)
""")
def labels_without_match(spark, sf):
    nation = table(spark, sf, "nation")
    debtors = table(spark, sf, "supplier").filter("s_acctbal < 0").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.upper("n_name").alias("name"))
    return unmatched_labels(nation, debtors, "n_name", "name")


@query("""
WITH o AS (SELECT c_nationkey AS k, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
     c AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1),
     l AS (SELECT s_nationkey AS k, count(*) AS lines, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
                  nullif(count(*) FILTER (WHERE s_acctbal < 0), 0) AS debtor_lines
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT n_nationkey, n_name, round(orders * CAST(100000 AS DOUBLE) / nullif(customers, 0), 2) AS orders_per_100k,
       round(debtor_lines * CAST(100 AS DOUBLE) / nullif(lines, 0), 1) AS pct_debtor_lines,
       round(lines * CAST(100 AS DOUBLE) / nullif(CAST(quantity AS DOUBLE), 0), 2) AS lines_per_100_units
FROM nation JOIN o ON o.k = n_nationkey LEFT JOIN c ON c.k = n_nationkey LEFT JOIN l ON l.k = n_nationkey
""")
def rates_by_key(spark, sf):
    return rates_table(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), order_profile(spark, sf),
        [customers_by_nation(spark, sf), lines_by_nation(spark, sf)], "n_nationkey", ["n_name"], [
            RateSpec("orders_per_100k", "orders", "customers"),
            RateSpec("pct_debtor_lines", "debtor_lines", "lines", 100.0, 1),
            RateSpec("lines_per_100_units", "lines", "quantity", 100.0, 2)])


MASTER_SQL = """
WITH o AS (SELECT c_nationkey AS k, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
                  count(*) FILTER (WHERE o_orderstatus = 'F') AS closed
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
     c AS (SELECT c_nationkey AS k, count(*) AS customers, count(*) FILTER (WHERE c_acctbal < 0) AS customers_in_debt
           FROM customer GROUP BY 1),
     t AS (SELECT s_nationkey AS k, count(*) AS total,
             round(count(*) FILTER (WHERE l_returnflag = 'R') * CAST(100 AS DOUBLE) / count(*), 1) AS pct_known_all,
             round(count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') * CAST(100 AS DOUBLE)
                   / nullif(count(*) FILTER (WHERE l_linestatus = 'F'), 0), 1) AS pct_known_killed,
             median(l_quantity) FILTER (WHERE l_quantity > 0 AND l_quantity < 49) AS median_speed
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
     d AS (SELECT s_nationkey AS k, count(*) AS debtor_lines
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 0 GROUP BY 1)
"""


@query(MASTER_SQL + """
SELECT n_nationkey, n_name, r_name, customers, customers_in_debt, orders, amount, closed, total, pct_known_all,
       pct_known_killed, median_speed, debtor_lines,
       round(orders * CAST(100000 AS DOUBLE) / nullif(customers, 0), 2) AS orders_per_100k,
       CASE WHEN coalesce(customers_in_debt > 0, false) AND coalesce(debtor_lines > 0, false) THEN 'both_jail_and_fine'
            WHEN coalesce(customers_in_debt > 0, false) THEN 'mandatory_jail_only'
            WHEN coalesce(debtor_lines > 0, false) THEN 'fine_only' ELSE 'minimal' END AS profile,
       CAST(coalesce(debtor_lines, 0) >= 15 AS INTEGER) AS debtors_sufficient
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN c ON c.k = n_nationkey LEFT JOIN o ON o.k = n_nationkey LEFT JOIN t ON t.k = n_nationkey
LEFT JOIN d ON d.k = n_nationkey
""")
def wide_master_table(spark, sf):
    parts = [customers_by_nation(spark, sf), order_profile(spark, sf), line_facts(spark, sf)]
    return wide_master(
        nations(spark, sf), [(p, "n_nationkey") for p in parts],
        derived={
            "amount": F.col("amount").cast("double"),
            "orders_per_100k": RateSpec("orders_per_100k", "orders", "customers").column(),
            "profile": penalty_class(F.col("customers_in_debt"), F.col("debtor_lines")),
            "debtors_sufficient": sufficient(F.col("debtor_lines"), 15)},
        order_by="n_name", digits=2)


def _by_customer(spark, sf, condition: str, prefix: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(condition)
    return profile_by_key(orders, ["o_custkey"], {
        f"{prefix}_orders": F.count("*"), f"{prefix}_amount": F.sum(money(F.col("o_totalprice")))})


@query("""
WITH p AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders
           WHERE o_orderstatus = 'P' GROUP BY 1),
     u AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders
           WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT coalesce(p.o_custkey, u.o_custkey) AS o_custkey, p.n AS pending_orders, CAST(p.a AS DOUBLE) AS pending_amount,
       u.n AS urgent_orders, CAST(u.a AS DOUBLE) AS urgent_amount
FROM p FULL JOIN u ON p.o_custkey = u.o_custkey
""")
def outer_merge_by_key(spark, sf):
    merged = outer_merge(_by_customer(spark, sf, "o_orderstatus = 'P'", "pending"),
                         _by_customer(spark, sf, "o_orderpriority = '1-URGENT'", "urgent"), "o_custkey")
    return merged.select("o_custkey", "pending_orders", F.col("pending_amount").cast("double").alias("pending_amount"),
                         "urgent_orders", F.col("urgent_amount").cast("double").alias("urgent_amount"))


def customer_panel(spark, sf) -> DataFrame:
    """Customers with balance, orders, spending and pending orders (NULL without any)."""
    orders = table(spark, sf, "orders")
    spent = profile_by_key(orders, ["o_custkey"], {
        "orders": F.count("*"), "spent": F.sum(money(F.col("o_totalprice"))),
        "pending": F.nullif(count_where(F.col("o_orderstatus") == "P"), F.lit(0))})
    customers = table(spark, sf, "customer")
    joined = customers.join(spent, customers.c_custkey == spent.o_custkey, "left")
    return joined.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "orders",
                         F.col("spent").cast("double").alias("spent"), "pending")


CUSTOMER_SQL = """
WITH s AS (SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
                  nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS pending FROM orders GROUP BY 1),
     panel AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, orders, spent, pending
               FROM customer LEFT JOIN s ON o_custkey = c_custkey)
"""


@query(CUSTOMER_SQL + """
SELECT c_custkey, CASE WHEN coalesce(c_acctbal > 0, false) AND coalesce(pending > 3, false) THEN 'both_jail_and_fine'
  WHEN coalesce(c_acctbal > 0, false) THEN 'mandatory_jail_only'
  WHEN coalesce(pending > 3, false) THEN 'fine_only' ELSE 'minimal' END AS profile
FROM panel
""")
def two_number_class(spark, sf):
    panel = customer_panel(spark, sf)
    return panel.select("c_custkey", penalty_class(F.col("c_acctbal"), F.col("pending") - 3).alias("profile"))


@query(CUSTOMER_SQL + """
SELECT c_mktsegment,
  round(fsum(c_acctbal) / count(c_acctbal), 2) AS c_acctbal_mean,
  round(median(c_acctbal), 2) AS c_acctbal_median, count(c_acctbal) AS c_acctbal_count,
  round(fsum(spent) / count(spent), 2) AS spent_mean,
  round(median(spent), 2) AS spent_median, count(spent) AS spent_count,
  round(CAST(sum(pending) AS DOUBLE) / count(pending), 2) AS pending_mean,
  round(median(pending), 2) AS pending_median, count(pending) AS pending_count
FROM panel GROUP BY 1
""")
def group_summary(spark, sf):
    return summarize(customer_panel(spark, sf), "c_mktsegment", ["c_acctbal", "spent", "pending"])


def _cohort_sql(first: str, second: str, names: tuple[str, str]) -> str:
    a, b = names
    parts = []
    for metric in ("spent", "orders", "pending"):
        parts.append(f"""SELECT '{metric}' AS metric,
  round(fsum({metric}) FILTER (WHERE {first}) / nullif(count({metric}) FILTER (WHERE {first}), 0), 2) AS {a}_mean,
  round(median({metric}) FILTER (WHERE {first}), 2) AS {a}_median,
  round(fsum({metric}) FILTER (WHERE {second}) / nullif(count({metric}) FILTER (WHERE {second}), 0), 2) AS {b}_mean,
  round(median({metric}) FILTER (WHERE {second}), 2) AS {b}_median,
  count(*) FILTER (WHERE {first}) AS {a}_n, count(*) FILTER (WHERE {second}) AS {b}_n FROM panel""")
    return CUSTOMER_SQL + " UNION ALL ".join(parts)


@query(_cohort_sql("c_acctbal < 0", "NOT (c_acctbal < 0)", ("debt", "credit")))
def cohorts_by_flag(spark, sf):
    panel = customer_panel(spark, sf).withColumn("in_debt", flag(F.col("c_acctbal") < 0))
    return compare_cohorts(panel, ["spent", "orders", "pending"], F.col("in_debt") == 1, F.col("in_debt") == 0,
                           ("debt", "credit"))


@query(_cohort_sql("pending IS NULL", "pending IS NOT NULL", ("settled", "open")))
def cohorts_by_null(spark, sf):
    panel = customer_panel(spark, sf)
    return compare_cohorts(panel, ["spent", "orders", "pending"], F.col("pending").isNull(),
                           F.col("pending").isNotNull(), ("settled", "open"))


@query("""
WITH r AS (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1)
SELECT CAST(coalesce(returned, 0) >= 200 AS INTEGER) AS sufficient,
       CASE WHEN s_acctbal > 0 AND s_acctbal > 5000 THEN 1 ELSE 0 END AS mandatory, count(*) AS n
FROM supplier LEFT JOIN r ON l_suppkey = s_suppkey GROUP BY 1, 2
""")
def flag_matrix_2x2(spark, sf):
    returned = profile_by_key(table(spark, sf, "lineitem"), ["l_suppkey"], {
        "returned": count_where(F.col("l_returnflag") == "R")})
    suppliers = table(spark, sf, "supplier")
    law = F.when(F.col("s_acctbal") > 0, "yes").otherwise("no")
    kind = F.when(F.col("s_acctbal") > 5000, "mandatory").otherwise("discretionary")
    flags = suppliers.join(returned, suppliers.s_suppkey == returned.l_suppkey, "left").select(
        sufficient(F.col("returned"), 200).alias("sufficient"), mandatory(law, kind).alias("mandatory"))
    return flag_matrix(flags, "sufficient", "mandatory")


@query("""
SELECT CASE WHEN p_type = 'PROMO' THEN 'none' WHEN p_size <= 7 THEN 'short' WHEN p_size <= 15 THEN 'standard'
            WHEN p_size >= 40 THEN 'lifetime' END AS bucket, count(*) AS n FROM part GROUP BY 1
""")
def value_buckets(spark, sf):
    parts = table(spark, sf, "part")
    years = F.when(F.col("p_type") != "PROMO", F.col("p_size"))
    return bucket_counts(parts, years, [
        ("short", years <= 7), ("standard", years <= 15), ("lifetime", years >= 40)], "none")


@query("""
SELECT coalesce(CAST(CASE WHEN p_size <= 4 THEN p_size END AS VARCHAR), 'none') AS threshold, count(*) AS n
FROM part GROUP BY 1
""")
def keys_by_threshold(spark, sf):
    threshold = F.when(F.col("p_size") <= 4, F.col("p_size")).cast("string")
    return table(spark, sf, "part").groupBy(F.coalesce(threshold, F.lit("none")).alias("threshold")).agg(
        F.count("*").alias("n"))


@query("""
SELECT o_orderpriority, round(avg(o_totalprice), 2) AS mean, round(stddev_samp(o_totalprice), 2) AS std, count(*) AS n,
       CAST(round(CAST(stddev_samp(o_totalprice) / sqrt(count(*)) AS DECIMAL(18,6)), 4) AS DOUBLE) AS se
FROM orders GROUP BY 1
""")
def mean_with_standard_error(spark, sf):
    stats = mean_with_error(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return stats.select("o_orderpriority", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"), "n",
                        fixed_round(F.col("se"), 4).alias("se"))


@query("""
SELECT 'l_quantity' AS "column", round(fsum(l_quantity), 2) AS sum, min(l_quantity) AS min,
  max(l_quantity) AS max, round(fsum(l_quantity) / count(l_quantity), 2) AS mean,
  round(median(l_quantity), 2) AS median FROM lineitem
UNION ALL
SELECT 'l_extendedprice', round(fsum(l_extendedprice), 2), min(l_extendedprice),
  max(l_extendedprice), round(fsum(l_extendedprice) / count(l_extendedprice), 2),
  round(median(l_extendedprice), 2) FROM lineitem
""")
def whole_table_stats(spark, sf):
    return table_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey, o_totalprice LIMIT 5")
def first_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        "o_orderdate", "o_orderkey", "o_totalprice").limit(5)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal DESC, c_custkey LIMIT 5")
def top_n(spark, sf):
    return largest(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 5)


@query("""
WITH t AS (SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
     hi AS (SELECT * FROM t ORDER BY orders DESC, n_name LIMIT 5),
     lo AS (SELECT * FROM t ORDER BY orders, n_name LIMIT 5)
SELECT n_name, orders, CASE WHEN n_name IN (SELECT n_name FROM lo) THEN 'bottom' ELSE 'top' END AS side,
       CAST(n_name IN ('NATION_0', 'NATION_7') AS INTEGER) AS highlight
FROM (SELECT * FROM hi UNION SELECT * FROM lo)
""")
def top_and_bottom(spark, sf):
    ranked = order_profile(spark, sf).join(table(spark, sf, "nation"), "n_nationkey")
    return top_bottom(ranked, "n_name", "orders", 5, 5, highlight=["NATION_0", "NATION_7"])


def debtors_by_nation(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").filter("s_acctbal < 0").groupBy(
        F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("debtors"))


@query("""
SELECT n_nationkey, debtors, CAST(debtors IS NULL AS INTEGER) AS is_missing
FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS debtors FROM supplier WHERE s_acctbal < 0 GROUP BY 1)
  ON s_nationkey = n_nationkey
""")
def map_values_by_key(spark, sf):
    return map_values(table(spark, sf, "nation"), debtors_by_nation(spark, sf), "n_nationkey", "debtors")


@query("""
SELECT CAST(0 AS DOUBLE) AS domain_min, CAST(max(n) AS DOUBLE) AS domain_max
FROM (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
""")
def map_colour_domain(spark, sf):
    return value_domain(order_profile(spark, sf), "orders", low=0)


@query("""
SELECT p_brand, CAST((row_number() OVER (ORDER BY p_brand) - 1) % 6 AS INTEGER) AS palette_index
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)
""")
def map_category_palette(spark, sf):
    return map_categories(table(spark, sf, "part"), "p_brand")


@query("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def distinct_sorted(spark, sf):
    return distinct_values(table(spark, sf, "orders"), "o_orderpriority")


@query("""
SELECT CAST(customers AS DOUBLE) AS x, CAST(orders AS DOUBLE) AS y, r_name AS color_by
FROM (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c
JOIN (SELECT c_nationkey, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) o
  ON c.c_nationkey = o.c_nationkey
JOIN nation ON c.c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def scatter_by_key(spark, sf):
    points = nations(spark, sf).join(customers_by_nation(spark, sf), "n_nationkey").join(
        order_profile(spark, sf), "n_nationkey")
    return scatter_points(points, F.col("customers").cast("double"), F.col("orders").cast("double"),
                          F.col("r_name"))


# Two small literal tables; only the names in both are kept.
REGION_LIMITS = {"limit_mph": {"AFRICA": 70, "AMERICA": 65, "ASIA": 75, "EUROPE": 80, "ANTARCTICA": 5},
                 "miles": {"AFRICA": 71816, "AMERICA": 346954, "ASIA": 5640, "EUROPE": 32543, "MIDDLE EAST": 9}}


@query("""
WITH o AS (SELECT r_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
     controls(r_name, limit_mph, miles) AS (VALUES ('AFRICA', 70, 71816), ('AMERICA', 65, 346954), ('ASIA', 75, 5640), ('EUROPE', 80, 32543))
SELECT r_name, orders, CAST(limit_mph AS BIGINT) AS limit_mph, CAST(miles AS BIGINT) AS miles,
       round(orders * CAST(100 AS DOUBLE) / nullif(miles, 0), 2) AS orders_per_100_miles
FROM o LEFT JOIN controls USING (r_name)
""")
def inline_controls(spark, sf):
    controls = structural_controls(spark, "r_name", REGION_LIMITS)
    by_region = profile_by_key(order_profile(spark, sf).join(nations(spark, sf), "n_nationkey"), ["r_name"],
                               {"orders": F.sum("orders")})
    per_mile = RateSpec("orders_per_100_miles", "orders", "miles", 100.0).column()
    return wide_master(by_region, [(controls, "r_name")], derived={"orders_per_100_miles": per_mile})


@query("""
SELECT 'fee' AS "column", round(fsum(fee), 6) AS sum, min(fee) AS min, max(fee) AS max,
  round(fsum(fee) / count(fee), 6) AS mean, round(median(fee), 6) AS median
FROM (SELECT round(l_extendedprice / 1000000, 5) AS fee FROM lineitem)
""")
def fine_measure_stats(spark, sf):
    """A measure with five decimals, most of it below a hundredth or a tenth."""
    lines = table(spark, sf, "lineitem").select(F.round(F.col("l_extendedprice") / 1_000_000, 5).alias("fee"))
    return table_stats(lines, ["fee"], digits=6)


@query("""
SELECT 'fee' AS "column", round(fsum(fee) * 1e13, 3) AS sum, round(min(fee) * 1e13, 3) AS min, round(max(fee) * 1e13, 3) AS max,
  round(fsum(fee) / count(fee) * 1e13, 3) AS mean, round(median(fee) * 1e13, 3) AS median
FROM (SELECT floor(l_extendedprice) * 1e-17 AS fee FROM lineitem)
""")
def tiny_measure_stats(spark, sf):
    """A measure near 1e-13; shown in units of that size."""
    lines = table(spark, sf, "lineitem").select((F.floor("l_extendedprice") * F.lit(1e-17)).alias("fee"))
    stats = table_stats(lines, ["fee"], digits=30)
    return stats.select("column", *[F.round(F.col(c) * 1e13, 3).alias(c) for c in ("sum", "min", "max", "mean", "median")])


@query("SELECT printf('%02d', p_size) AS code, p_name AS name FROM part WHERE p_size <= 20")
def valid_code_list(spark, sf):
    raw = table(spark, sf, "part").select(F.col("p_size").cast("string").alias("P CODE"), F.col("p_name").alias("P-Name"))
    return code_list(raw, {"p_code": "code", "p_name": "name"}, "code", last=20)


@query("""
SELECT printf('%02d', c_nationkey) AS code, n_name AS name,
""" + ", ".join(f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS orders_{y}" for y in range(1995, 2002)) + """
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey = 2 AND c_nationkey <= 20 GROUP BY 1, 2
""")
def yearly_columns_by_key(spark, sf):
    orders = table(spark, sf, "orders")
    years = sorted(r["y"] for r in orders.select(F.year("o_orderdate").alias("y")).dropna().distinct().collect())
    per_year = {f"POPESTIMATE{y}": count_where(F.year("o_orderdate") == y) for y in years}
    counts = profile_through(orders, "o_custkey", customer_nation(spark, sf), ["n_nationkey"], per_year)
    raw = counts.join(table(spark, sf, "nation"), "n_nationkey").withColumnsRenamed(
        {"n_nationkey": "STATE", "n_name": "NAME", "n_regionkey": "SUMLEV"})
    return yearly_columns(raw, "sumlev", 2, "state", "code", "popestimate", "orders_", {"name": "name"}, last=20)


@query("""
SELECT c_custkey, c_name, CASE c_custkey WHEN 3 THEN 4 WHEN 7 THEN 5 ELSE c_nationkey END AS c_nationkey FROM customer
""")
def hand_checked_overrides(spark, sf):
    checked = spark.createDataFrame([(3, 4), (7, 5)], "c_custkey long, c_nationkey int")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return with_overrides(customers, checked, "c_custkey", "c_nationkey")


@query("""
SELECT n_name, count(*) AS orders, CAST(sum(CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER)) AS BIGINT) AS closed,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * CAST(100 AS DOUBLE) / count(*), 2) AS pct_closed,
  CAST(count(*) >= 100 AS INTEGER) AS enough
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def library_functions_in_sql(spark, sf):
    """Ad-hoc SQL over views that calls the library's own functions."""
    register(spark)
    views = {f"sql_{name}": table(spark, sf, name) for name in ("orders", "customer", "nation")}
    return run_sql(spark, """
        SELECT n_name, count(*) AS orders, sum(panel_flag(o_orderstatus = 'F')) AS closed,
          panel_share(sum(panel_flag(o_orderstatus = 'F')), count(*)) AS pct_closed, panel_sufficient(count(*), 100) AS enough
        FROM sql_orders JOIN sql_customer ON o_custkey = c_custkey JOIN sql_nation ON c_nationkey = n_nationkey
        GROUP BY n_name""", views)
