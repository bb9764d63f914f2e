"""Rows go through shuffles with no more than the step needs."""

import re

from earshot.operators import ordering as O
from earshot.plans import profiles as P


def test_order_goes_through_dedup_once(spark):
    rows = spark.createDataFrame(
        [(1, "b", 2, 5), (1, "a", 1, 6), (1, None, 3, 7), (2, None, None, 8), (None, "c", 1, 9), (None, "d", 2, 10)],
        "k int, v string, line int, n int",
    )
    assert {tuple(r) for r in O.dedup(rows, ["k"], ["line"]).collect()} == {(1, "a", 1, 6), (2, None, None, 8), (None, "c", 1, 9)}
    last = O.dedup(rows, ["k"], ["line"], keep="last")
    assert last.columns == rows.columns
    assert {tuple(r) for r in last.collect()} == {(1, None, 3, 7), (2, None, None, 8), (None, "d", 2, 10)}
    assert {tuple(r) for r in O.dedup(rows.select("k", "line"), ["k"], ["line"]).collect()} == {(1, 1), (2, None), (None, 1)}
    plan = O.dedup(rows, ["k"], ["line"]).drop("line")._jdf.queryExecution().optimizedPlan().toString()
    picked = re.search(r"min_by\(struct\((.*?)\), struct\(", plan).group(1)
    assert "v, v#" in picked and "line" not in picked and not re.search(r"\bmin\(", plan)


def test_errors_read_only_what_models_need(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(u, s, f"p{s}", "x" * 50, s % 5, float(s % 3), 0.1 * s) for u in range(3) for s in range(30)],
        "user_id int, song_id int, path string, track_id string, play_count int, a double, label double",
    )
    staged = []
    monkeypatch.setattr(P, "stage", lambda df, tag: staged.append(df.columns) or df)
    errors = P.profile_errors(rows, ["a"]).collect()
    assert [sorted(c) for c in staged] == [["a", "is_train", "label", "song_id", "user_id"]]
    assert {r.n for r in errors} == {9} and len(errors) == 3
