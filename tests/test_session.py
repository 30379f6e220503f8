from tidelake.session import configure


def test_a_task_reads_little_of_an_exchange_and_settings_that_are_finer_stay(spark):
    read, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(read), spark.conf.get(first, None)
    try:
        spark.conf.set(read, "64MB")
        spark.conf.unset(first)
        configure(spark)
        assert spark.conf.get(read) == f"{32 << 20}b" and spark.conf.get(first) == "200"
        spark.conf.set(read, "8m")
        spark.conf.set(first, "300")
        configure(spark)
        assert spark.conf.get(read) == "8m" and spark.conf.get(first) == "300"
    finally:
        spark.conf.set(read, before[0])
        spark.conf.set(first, before[1]) if before[1] else spark.conf.unset(first)
