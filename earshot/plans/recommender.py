"""The recommender end to end: predictions and rules on visible plays, scored on hidden ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.blend import blend, evaluate
from earshot.operators.itemsets import basket_count, frequent_itemsets
from earshot.operators.ratings import to_ratings
from earshot.operators.rules import association_rules, filter_rules, rule_recommendations
from earshot.operators.similarity import predict_from_ratings
from earshot.session import stage


def mine_rules(
    rows: DataFrame, min_support: int = 15, min_confidence: float = 0.04, min_interest: float = 0.01
) -> DataFrame:
    """Frequent itemsets of the baskets and the rules that pass both thresholds."""
    itemsets = frequent_itemsets(rows, min_support, 4)
    n_baskets = basket_count(rows)
    return filter_rules(association_rules(itemsets, max(n_baskets, 1)), min_confidence, min_interest)


def recommend(
    plays: DataFrame, users: DataFrame, scale: str = "raw", cap: int = 500, k: int = 50,
    min_neighbours: int = 5, min_item_users: int = 10, min_user_songs: int = 5, min_support: int = 15,
    min_confidence: float = 0.04, min_interest: float = 0.01,
) -> DataFrame:
    """``(user_id, song_id, source, place)``: the blended list of each listener in ``users``."""
    ratings = stage(to_ratings(plays, scale, min_item_users, min_user_songs), "ratings")
    predictions = predict_from_ratings(ratings, users=users, k=k, min_neighbours=min_neighbours)
    rows = ratings.select(F.col("user_id").alias("basket_id"), F.col("song_id").alias("item"))
    rules = mine_rules(rows, min_support, min_confidence, min_interest)
    wanted = rows.join(users.select(F.col("user_id").alias("basket_id")), "basket_id", "left_semi")
    by_rule = rule_recommendations(wanted, rules).select(
        F.col("basket_id").alias("user_id"), F.col("item").alias("song_id")
    )
    return blend(by_rule, predictions, cap)


def recommend_and_evaluate(plays: DataFrame, hidden: DataFrame, users: DataFrame, **settings) -> DataFrame:
    """Hits, list sizes and precision of the blended list of each listener."""
    listed = recommend(plays, users, **settings)
    return evaluate(listed, hidden.join(users, "user_id", "left_semi"))


__all__ = ["mine_rules", "recommend", "recommend_and_evaluate"]
