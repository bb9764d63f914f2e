"""The test tables are built in tasks that hold a bounded number of lines."""

import pytest
from pyspark.sql import functions as F

from earshot.suite import tables as T


@pytest.mark.parametrize("build", [T.plays, T.order_brands, T.order_plays])
def test_lines_of_a_task_are_bounded(spark, tmp_path, monkeypatch, build):
    monkeypatch.setattr(T, "TASK_LINES", 500, raising=False)
    folder, n = str(tmp_path), 12_000
    lines = spark.range(n).select(
        F.expr("id div 4").alias("l_orderkey"), (F.col("id") * 7 % 900).alias("l_partkey"), F.lit(6.0).alias("l_quantity"),
        F.lit("2000-01-01").cast("timestamp").alias("l_shipdate"),
    )
    orders = spark.range(n // 4).select(F.col("id").alias("o_orderkey"), (F.col("id") % 1500).alias("o_custkey"))
    part = spark.range(900).select(F.col("id").alias("p_partkey"), F.concat(F.lit("B"), (F.col("id") % 30).cast("string")).alias("p_brand"))
    for name, df in [("lineitem", lines), ("orders", orders), ("part", part)]:
        df.write.parquet(f"{folder}/{name}.parquet")
    sizes = [r["count"] for r in build(spark, folder).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4 * 500 and sum(sizes) > 500 * 12
