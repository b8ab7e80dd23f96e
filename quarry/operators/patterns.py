"""Baskets, frequent itemsets, association rules and their application to baskets."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.containment import contained
from quarry.operators.itemsets import MAX_TRIE, rule_offers, supports_two_passes, two_pass_itemsets
from quarry.plans.lineage import scope, staged


def baskets(df: DataFrame, key: str, item: str) -> DataFrame:
    """``(basket, items)``: sorted distinct items per key (FP-growth rejects duplicates)."""
    return (df.where(F.col(key).isNotNull() & F.col(item).isNotNull())
            .groupBy(F.col(key).alias("basket"))
            .agg(F.array_sort(F.collect_set(item)).alias("items")))


def frequent_itemsets(basket_df: DataFrame, min_count: int | None = None, min_support: float | None = None,
                      max_size: int | None = None, method: str = "auto") -> DataFrame:
    """``(items, size, support)``: every itemset (of at most ``max_size`` items) contained in at least the threshold of baskets.

    ``method``: ``two_pass`` (:mod:`quarry.operators.itemsets`), ``fpgrowth`` (MLlib; mines all sizes),
    or ``auto``, which takes FP-growth only for thresholds too low to be scaled to a stretch of baskets.
    """
    if (min_count is None) == (min_support is None):
        raise ValueError("give exactly one of min_count, min_support")
    if method not in ("auto", "two_pass", "fpgrowth"):
        raise ValueError(f"unknown method {method!r}")
    with scope(basket_df.sparkSession) as own:
        rows = staged(basket_df.select("items"), "baskets")  # read again by each pass
        n = rows.count()
        least = max(1, min_count if min_count is not None else math.ceil(min_support * n))
        if method == "two_pass" or method == "auto" and supports_two_passes(n, least):
            return own.hand_over(two_pass_itemsets(rows, least, max_size))
        # half a basket below the integer threshold: freq >= least exactly
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(n, 1)).fit(rows)
        found = model.freqItemsets.select(F.array_sort("items").alias("items"), F.size("items").alias("size"),
                                          F.col("freq").alias("support"))
        found = found if max_size is None else found.where(F.col("size") <= max_size)
        return own.hand_over(staged(found, "itemsets"))


def association_rules(basket_df: DataFrame, min_count: int | None = None, min_support: float | None = None,
                      min_conf: float = 0.5, method: str = "auto") -> DataFrame:
    """``(antecedent, consequent, support, confidence)`` for rules I∖{i} → i of frequent I.

    ``support`` is the basket count of the whole itemset; confidence is
    count(I) / count(I∖{i}).  Every I∖{i} is frequent with I, so the counts of both sides meet in a join of the itemsets.
    """
    sets = frequent_itemsets(basket_df, min_count, min_support, method=method)
    whole = (sets.where(F.col("size") >= 2).select("items", "support", F.explode("items").alias("consequent"))
             .select(F.array_remove(F.col("items"), F.col("consequent")).alias("antecedent"), "consequent", "support"))
    parts = sets.select(F.col("items").alias("antecedent"), F.col("support").alias("n"))
    return (whole.join(parts, "antecedent").withColumn("confidence", F.col("support") / F.col("n"))
            .where(F.col("confidence") >= min_conf).select("antecedent", "consequent", "support", "confidence"))


def apply_rules(rules: DataFrame, basket_df: DataFrame, max_rules: int = MAX_TRIE) -> DataFrame:
    """``(basket, item, confidence, n_rules)``: items that a basket lacks and that rules whose antecedent it holds lead to.

    ``confidence`` is that of the best such rule.  ``max_rules`` rules at most go to every task, which meets them with the
    bit sets of its baskets; more rules, or rows that share a basket or have none, meet in the containment join.
    """
    with scope(basket_df.sparkSession) as own:
        rows = staged(basket_df.select("basket", "items"), "rule-baskets")
        known = staged(rules.select("antecedent", "consequent", "confidence"), "rules")
        shared = F.col("basket").isNull() | (F.col("n") > 1)
        if known.count() <= max_rules and rows.groupBy("basket").agg(F.count(F.lit(1)).alias("n")).where(shared).isEmpty():
            listed = [tuple(r) for r in known.collect()]
            return own.hand_over(staged(rule_offers(rows, listed, known.schema["consequent"].dataType), "rule-matches"))
        matched = contained(known.select(F.col("antecedent").alias("set_id"), F.col("antecedent").alias("items")).distinct(),
                            rows.select(F.col("basket").alias("basket_id"), "items"))
        offered = (matched.join(known, matched.set_id == known.antecedent)
                   .select(F.col("basket_id").alias("basket"), F.col("consequent").alias("item"), "confidence"))
        held = rows.select("basket", F.explode("items").alias("item"))
        out = (offered.join(held, ["basket", "item"], "left_anti").groupBy("basket", "item")
               .agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n_rules")))
        return own.hand_over(staged(out, "rule-matches"))
