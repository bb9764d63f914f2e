"""A key with most of the rows is split where statistics are joined back."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import features as X
from earshot.operators import itemsets as I
from earshot.operators import ordering as O
from earshot.operators import ratings as R

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """70 of 100 rows belong to one listener, and to one song."""
    path = str(tmp_path_factory.mktemp("hot") / "plays")
    key = F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 5000)
    spark.range(0, 200_000, 1, 16).select(
        key.alias("user_id"), key.alias("song_id"), F.col("id").alias("line"), (F.col("id") % 17).alias("play_count"),
        F.rand(1).alias("rating"), F.rand(2).alias("a"),
    ).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(path)
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


JOINED = {
    "minmax_label": lambda df: X.minmax_label(df),
    "impute_mean": lambda df: X.impute_mean(df, ["a"]),
    "label_and_impute": lambda df: X.label_and_impute(df, ["a"]),
    "min_user_items": lambda df: R.min_user_items(df, 3),
    "min_item_support": lambda df: R.min_item_support(df, 3),
    "center_by_item": lambda df: R.center_by_item(df),
    "unit_rows": lambda df: R.unit_rows(df),
    "positional_split": lambda df: O.positional_split(df, 5, order="line"),
}


@pytest.mark.parametrize("name", JOINED)
def test_hot_key_is_split(hot, name):
    df = JOINED[name](hot)
    df.write.format("noop").mode("overwrite").save()
    df = JOINED[name](hot)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_parts_of_a_basket_are_dealt_out(hot):
    rows = hot.select(F.col("user_id").alias("basket_id"), F.col("line").alias("item"))
    parts = I.to_baskets(rows, limit=1000)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert parts.agg(F.sum(F.size("items"))).first()[0] == rows.count()


def test_funnel_comes_from_the_run_of_the_filters(spark):
    """Counts equal those of the kept rows, and reading them opens no play again."""
    plays = spark.createDataFrame(
        [(u, s, 1) for u in range(30) for s in range(u % 9)] + [(None, 1, 1), (1, None, 1), (2, 2, 1)],
        "user_id int, song_id int, play_count int",
    )
    kept, funnel = R.counted_plays(plays, 10, 5)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, R.qualified_plays(plays, 10, 5).collect()), key=str)
    rows = kept.collect()
    wanted = {
        "lines": plays.count(), "songs_kept": R.min_item_support(plays, 10).select("song_id").distinct().count(),
        "users_kept": len({r.user_id for r in rows}), "lines_kept": len(rows),
    }
    assert {r.stage: r.n for r in funnel.collect()} == wanted and rows
    plan = funnel._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ExistingRDD" not in plan
    assert {r.n for r in R.counted_plays(plays.limit(0))[1].collect()} == {0}
