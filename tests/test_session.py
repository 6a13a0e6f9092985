"""Tasks stay small, whatever the files and shuffles are packed to."""

import math
import os

from pyspark.sql import functions as F

from ledgerloom.session import configure

MB = 1 << 20


def test_scans_and_shuffles_are_cut_small(spark, tmp_path):
    configure(spark)
    path = str(tmp_path / "amounts")
    spark.range(0, 5_000_000, numPartitions=1).select(F.rand(3).alias("x")).write.option("parquet.block.size", 4 * MB).parquet(path)
    size = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.endswith(".parquet"))
    assert size > 32 * MB
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        read = spark.read.parquet(path)
        assert read.rdd.getNumPartitions() >= math.ceil(size / (16 * MB))
        # 40 MB through a shuffle: the tasks after it read 16 MB each, not 64.
        dealt = read.groupBy("x").count()._jdf.queryExecution()
        dealt.executedPlan().execute().count()
        assert dealt.executedPlan().execute().getNumPartitions() >= 2
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
