from keypanel import session


def test_settings_grow_with_the_shuffle():
    small = session.settings_for(10 ** 6, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    large = session.settings_for(2 * 1024 ** 4, cores=4000)
    assert large["spark.sql.shuffle.partitions"] == str(2 * 1024 ** 4 // session.REDUCER_BYTES)
    huge = session.settings_for(100 * 1024 ** 4, cores=4000)
    assert huge["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // session.REDUCER_BYTES)
    assert int(huge["spark.sql.files.maxPartitionBytes"]) > int(large["spark.sql.files.maxPartitionBytes"])


def test_stored_and_checkpointed_tables_keep_their_rows(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
    for copy in (session.stored(df), session.checkpointed(df)):
        assert copy.dtypes == df.dtypes and copy.exceptAll(df).isEmpty() and copy.count() == 100
