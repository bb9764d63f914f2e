"""Association rules of three items to one, and what they recommend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.itemsets import occurrences, set_columns
from earshot.session import stage


def association_rules(itemsets: DataFrame, n_baskets: int, size: int = 4) -> DataFrame:
    """Every rule of ``size - 1`` items to one item from the frequent sets of ``size`` items.

    Confidence is the support of the set over that of the antecedent; interest
    is the confidence less the share of baskets that hold the consequent.
    """
    whole = itemsets.where(F.col("size") == size)
    split = whole.select(
        F.explode("itemset").alias("consequent"), "itemset", F.col("support").alias("whole_support")
    ).select(F.array_remove("itemset", F.col("consequent")).alias("antecedent"), "consequent", "whole_support")
    parts = itemsets.where(F.col("size") == size - 1).select(
        F.col("itemset").alias("antecedent"), F.col("support").alias("part_support")
    )
    singles = itemsets.where(F.col("size") == 1).select(
        F.get("itemset", F.lit(0)).alias("consequent"), F.col("support").alias("single_support")
    )
    confidence = F.col("whole_support") / F.col("part_support")
    return (
        split.join(parts, "antecedent")
        .join(singles, "consequent")
        .select("antecedent", "consequent", confidence.alias("confidence"), "single_support")
        .select(
            "antecedent", "consequent", "confidence",
            (F.col("confidence") - F.col("single_support") / F.lit(n_baskets)).alias("interest"),
        )
    )


def filter_rules(rules: DataFrame, min_confidence: float = 0.04, min_interest: float = 0.01) -> DataFrame:
    return rules.where((F.col("confidence") >= min_confidence) & (F.col("interest") >= min_interest))


def rank_rules(rules: DataFrame) -> DataFrame:
    """Lowest confidence first; equal ones by antecedent and consequent."""
    return rules.orderBy(F.round("confidence", 9), "antecedent", "consequent")


def best_rule(rules: DataFrame) -> DataFrame:
    """The most confident consequent of each antecedent; of equals the last in item order."""
    strength = F.struct(F.round("confidence", 9), F.col("consequent"))
    return rules.groupBy("antecedent").agg(
        F.max_by("consequent", strength).alias("consequent"),
        F.max("confidence").alias("confidence"),
    )


def rule_items(rules: DataFrame) -> DataFrame:
    """All items that occur in some rule, on either side."""
    left = rules.select(F.explode("antecedent").alias("item"))
    return left.union(rules.select("consequent")).distinct()


def associated_items(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Basket rows whose item occurs in some rule."""
    return rows.join(rule_items(rules), "item", "left_semi").select("basket_id", "item")


def match_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``(basket_id, antecedent, consequent)`` where the basket holds the whole antecedent."""
    names = ["i1", "i2", "i3"]
    keyed = stage(set_columns(rules.select("antecedent", "consequent"), "antecedent", 3), "keyed-rules")
    hits = occurrences(rows.select("basket_id", "item").distinct(), keyed.select(*names).distinct(), 3)
    return hits.join(keyed, names).select("basket_id", "antecedent", "consequent")


def rule_recommendations(rows: DataFrame, rules: DataFrame, exclude_heard: bool = True) -> DataFrame:
    """``(basket_id, item)`` recommended by the best rule of each antecedent in the basket."""
    hits = match_rules(rows, best_rule(rules))
    found = hits.select("basket_id", F.col("consequent").alias("item")).distinct()
    if exclude_heard:
        found = found.join(rows.select("basket_id", "item"), ["basket_id", "item"], "left_anti")
    return found
