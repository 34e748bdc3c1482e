"""SQL functions give what the column functions give, and stay inside the plan."""

from pyspark.sql import functions as F

from keypanel.functions import rates, sql, text
from keypanel.sources.files import run_sql

TEXTS = ["$1,200–$2,500", "$15", "none", "None (standard)", "10–180 days", "48 hrs", "24 hrs–6 months", "Up to 2 years", "6 months min.", "5 years",
         "Lifetime", " −3.5 ", "1e3", "abc", "", None, "30", "12 Year look-back", "it's a \\ $7 'quote'", "a\u00a0b"]


def test_texts(spark):
    sql.register(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    df.createOrReplaceTempView("texts")
    found = spark.sql("SELECT t, panel_number(t) a, panel_first_amount(t) b, panel_last_amount(t) c, panel_duration_days(t) d, "
                      "panel_years_back(t) e, panel_mentions(t, 'year') f, panel_pad(t, 3) g FROM texts")
    c = F.col("t")
    plain = df.select("t", text.number(c), text.first_amount(c), text.last_amount(c), text.duration_days(c), text.years_back(c), text.mentions(c, "year"), text.pad_key(c, 3))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_numbers(spark):
    sql.register(spark)
    df = spark.createDataFrame([(1, 3), (0, 0), (None, 5), (7, None), (2, 40)], "a int, b int")
    df.createOrReplaceTempView("numbers")
    found = spark.sql("SELECT panel_rate(a, b, 1000) r, panel_share(a, b) s, panel_flag(a > 1) f, panel_sufficient(b, 5) n FROM numbers")
    a, b = F.col("a"), F.col("b")
    plain = df.select(rates.rate(a, b, 1000.0), rates.share(a, b), rates.flag(a > 1), rates.sufficient(b, 5))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_aggregates_and_plan(spark):
    assert "panel_share" in sql.register(spark)
    views = {"t": spark.createDataFrame([("x", 1), ("x", None), ("y", 1)], "k string, hit int")}
    df = run_sql(spark, "SELECT k, panel_share(sum(panel_flag(hit = 1)), count(*)) AS pct FROM t GROUP BY k", views)
    assert sorted(map(tuple, df.collect())) == [("x", 50.0), ("y", 100.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "panel_share" not in plan
