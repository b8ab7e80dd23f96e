"""Set-containment join: which itemsets are subsets of which baskets.

An itemset can only be inside a basket that holds its rarest item.  So itemsets
are indexed by that one item alone, and baskets look themselves up with
each item that is an index key; a pair that meets is a candidate, and it meets
once.  Candidates are verified by counting: their itemset's other items
meet the baskets' items, and a pair is kept if all of them did.

No pair of sets is compared as a whole, so no array of a basket travels
with its candidates.  An index item held by more than ``split_size`` baskets is cut by a hash of
the basket into parts, and its few index rows go to each of them; the later
joins have the pair or the basket in their key, or one small side that AQE can
replicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans.lineage import staged

SPLIT_SIZE = 200_000


def contained(sets: DataFrame, baskets: DataFrame, split_size: int = SPLIT_SIZE) -> DataFrame:
    """``(set_id, basket_id)`` for every itemset of ``(set_id, items)`` inside a basket of ``(basket_id, items)``.

    Both ids are keys.  Repeated items count once and null items are no items; an empty itemset, which every
    basket holds, is in no row of the result.  Both tables are read once.
    """
    def long(df: DataFrame, key: str) -> DataFrame:
        return df.select(key, F.explode(F.array_distinct("items")).alias("item")).where(F.col("item").isNotNull())

    held = staged(long(baskets, "basket_id"), "containment-baskets")
    wanted = staged(long(sets, "set_id"), "containment-sets")
    rows = held.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    # an item that no basket holds leaves its itemset without a match
    rarest = (wanted.join(rows, "item", "left").groupBy("set_id")
              .agg(F.min(F.struct("n", "item")).alias("rarest"), F.count(F.lit(1)).alias("size"), F.count("n").alias("known"))
              .where(F.col("size") == F.col("known"))
              .select("set_id", "size", F.col("rarest.item").alias("item"), F.ceil(F.col("rarest.n") / F.lit(split_size)).cast("int").alias("parts")))
    index = staged(rarest, "containment-index")
    keys = index.select("item", "parts").distinct()  # equal items have equal parts
    part = F.pmod(F.xxhash64("basket_id"), F.col("parts")).cast("int")
    asking = held.join(keys, "item").select("item", "basket_id", part.alias("part"))
    spread = index.select("set_id", "size", "item", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    candidates = staged(asking.join(spread, ["item", "part"]).select("set_id", "basket_id", "size", "item"), "containment-candidates")
    rest = (candidates.where("size > 1").withColumnRenamed("item", "met").join(wanted, "set_id").where(F.col("item") != F.col("met"))
            .join(held, ["basket_id", "item"]).groupBy("set_id", "basket_id", "size").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == F.col("size") - 1))
    return candidates.where("size = 1").select("set_id", "basket_id").union(rest.select("set_id", "basket_id"))
