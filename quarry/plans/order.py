"""Ordinals of a total order without gathering it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.lineage import staged


def numbered(df: DataFrame, *order: Column | str, name: str = "ordinal", tasks: int | None = None) -> DataFrame:
    """``df`` with the 0-based place of every row in the order, as a staged table.

    Rows are range-partitioned and sorted inside their partitions, then written (range bounds come
    from a sample, so the split has to be fixed before it is counted).  A row's place is its place in the
    partition plus the rows of the partitions before, of which one count each reaches the driver.  An order that
    ends with a unique column splits rows that are equal in the others.
    """
    spark = df.sparkSession
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    fixed = staged(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ordinals")
    counts = sorted((r["_part"], r["n"]) for r in fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for part, rows in counts:
        offsets.append((part, before))
        before += rows
    bases = F.broadcast(spark.createDataFrame(offsets, "_part int, _base long"))  # a row per partition
    inside = F.col("_at") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return fixed.join(bases, "_part").withColumn(name, F.col("_base") + inside).drop("_part", "_at", "_base")
