"""Tables stored by id join without an exchange on it."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from keypanel.operators.joins import exists_flag
from keypanel.plans.history import history_profile
from keypanel.plans.layout import buckets_for, exchanges_on, expect_stored_by, save_bucketed


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def save(spark):
    names = []

    def add(df, on, buckets=8, **options):
        names.append(f"t_{uuid4().hex}")
        return save_bucketed(df, names[-1], on, buckets, **options)

    yield add
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def vehicles(spark):
    return spark.range(2000).select((F.col("id") % 700).alias("vehicle"), (F.col("id") % 3).alias("key"),
                                    (F.col("id") % 2).cast("int").alias("prior"), (F.col("id") % 90).cast("int").alias("speed"))


def test_flag_and_history_exchange_nothing_by_id(spark, save, no_broadcast, rows):
    plain, ids = vehicles(spark), spark.range(0, 700, 5).select(F.col("id").alias("vehicle"))
    kept, side = save(plain, "vehicle"), save(ids, "vehicle")
    flagged = exists_flag(kept, side, "vehicle", "hit")
    assert exchanges_on(flagged, "vehicle") == [] and exchanges_on(exists_flag(plain, ids, "vehicle", "hit"), "vehicle")
    assert sorted(flagged.collect()) == sorted(exists_flag(plain, ids, "vehicle", "hit").collect())
    profile = history_profile(kept, side, "key", ["vehicle"], "prior", "speed")
    assert exchanges_on(profile, "vehicle") == [] and exchanges_on(profile, "key")
    assert rows(profile, "key") == rows(history_profile(plain, ids, "key", ["vehicle"], "prior", "speed"), "key")


def test_a_plan_that_exchanges_is_refused(spark, save, no_broadcast):
    kept, other = save(vehicles(spark), "vehicle"), spark.range(700).withColumnRenamed("id", "vehicle")
    with pytest.raises(ValueError, match="exchanges rows by vehicle"):
        expect_stored_by(kept.join(other, "vehicle"), "vehicle")


def test_a_hot_id_is_written_by_many_tasks(spark, save, no_broadcast):
    """A third of the rows under one id, some without: buckets of several files, joins as right as before."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("vehicle"), "id")
    kept = save(df, "vehicle", hot_rows=1000)
    sizes = kept.groupBy(F.input_file_name().alias("f")).count()
    assert sizes.agg(F.max("count")).first()[0] < 600 and kept.count() == 6000
    assert kept.exceptAll(df).isEmpty()
    ids = save(spark.createDataFrame([(7,), (1,), (None,)], "vehicle long"), "vehicle")
    flagged = exists_flag(kept, ids, "vehicle", "hit", hot_rows=None)
    assert exchanges_on(flagged, "vehicle") == []
    assert flagged.agg(F.sum("hit")).first()[0] == 2002  # 2,000 and one more of id 7, one of id 1


def test_empty_table_and_bucket_numbers(spark, save):
    assert save(vehicles(spark).limit(0), "vehicle").count() == 0
    assert [buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 10 << 30)] == [1, 1, 1, 2, 64]
