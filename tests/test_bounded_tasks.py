"""Steps of many lines run in tasks of bounded rows."""

import re

import pytest

from earshot.operators import itemsets as I
from earshot.suite import tables as T

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [T.order_brands, T.order_plays, T.plays])
def test_many_lines_are_joined_in_bounded_tasks(spark, monkeypatch, rows):
    monkeypatch.setattr(T, "TASK_LINES", 200)
    tasks = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 200 + 1
    assert tasks > T.PLAIN_TASKS
    plan = rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    for key in ("l_orderkey", "o_orderkey"):
        assert re.search(rf"RepartitionByExpression \[{key}#\d+L?\], {tasks}\b", plan)


def test_rows_of_baskets_are_not_broadcast(spark, tmp_path):
    baskets = [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "c"), (3, "b"), (None, "a"), (4, None)]
    spark.createDataFrame(baskets, "basket_id bigint, item string").write.parquet(f"{tmp_path}/rows")
    spark.createDataFrame([("a", "b", "c")], "i1 string, i2 string, i3 string").write.parquet(f"{tmp_path}/sets")
    found = I.contained_sets(spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/sets"), 3)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [basket_id" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)
    assert [tuple(r) for r in found.collect()] == [(1, "a", "b", "c")]
