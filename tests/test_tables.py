"""A table of one split is dealt to all cores; larger tables are left alone."""

from matchlog.sources.tables import deal_single_split


def test_only_a_single_split_is_dealt(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(1000).coalesce(1).write.parquet(one)
    spark.range(1000).repartition(3).write.parquet(many)
    cores = spark.sparkContext.defaultParallelism
    dealt = deal_single_split(spark.read.parquet(one))
    assert dealt.rdd.getNumPartitions() == cores and dealt.count() == 1000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # several splits
    try:
        left = spark.read.parquet(many)
        assert deal_single_split(left) is left
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
