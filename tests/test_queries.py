"""Every query of the suite against its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

# at this size no brand sets are frequent enough to make rules, and no recommendation hits a hidden play
EMPTY_HERE = {
    "recommendation_hits", "association_rules", "ranked_rules", "best_rules", "rule_items", "associated_items", "matched_rules",
    "rule_recommendations", "rule_recommendations_with_heard", "surviving_items",
}


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, name):
    problem = difference(QUERIES[name](spark, FOLDER), tables, ORACLES[name])
    if name in EMPTY_HERE:
        assert problem in (None, "no rows on either side")
    else:
        assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["user_id", "song_id", "score"]
    assert rows.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
