"""Sharding by extendible hashing (built-in functions only).

The directory is indexed by the leading bits of a row's hash.  A bucket whose
rows exceed the byte limit is split on one more bit, and only such a bucket, until
every bucket fits.  Which buckets get split depends on byte sums per prefix
alone, so the directory is built from a histogram: bytes per ``base`` leading
bits (about ``SPREAD`` cells a shard), summed up the prefix tree; a cell's shard is
its shortest prefix that fits.  Cells that still exceed the limit at that depth go on
with deeper prefixes, and only their rows are counted again.

Rows that share all :data:`HASH_BITS` bits of the hash (one key, repeated) can't be
split by hashing.  Their bucket is cut into overflow pages by running bytes, as
extendible hashing does with overflow chains; the running sum is taken over
slices of the staged rows first, so a key with a third of all rows is no
single task.

Defined results: a null payload has 0 bytes; a null key hashes as the empty
string; a single row larger than the limit has a shard (or page) to itself and
``oversize`` is true; repeated rows are rows like others; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.llm.common import staged

HASH_BITS = 60
STEP = 12
SPREAD = 6  # extra bits of the first histogram beyond one cell a shard


def hash_of(key: Column) -> Column:
    """60 bits of the md5 of a key's string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(depth: Column | int) -> Column:
    d = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col("hash"), (F.lit(HASH_BITS) - d).cast("int"))


def _directory(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``(cell, depth, fits)`` of every ``high``-bit cell: the least depth from ``low`` on whose prefix fits."""
    cells = rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    cells = staged(cells, "shard-cells")
    up = F.call_function("shiftright", F.col("cell"), (F.lit(high) - F.col("depth")).cast("int"))
    tree = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("prefix", up)
    sums = tree.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"))
    fits = sums.where((F.col("total") <= limit) | (F.col("rows") == 1)).select("depth", "prefix")
    found = tree.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return staged(cells.select("cell").join(found, "cell", "left"), "shard-directory")


def shard(table: DataFrame, key: str, payload: str, limit: int, keep: list[str] | None = None) -> DataFrame:
    """``(row, hash, bytes, shard, depth, page, shard_bytes, shard_rows, oversize)`` for every row of ``table``.

    ``shard`` is the prefix as a string of bits (empty for depth 0).
    """
    columns = table.columns if keep is None else keep
    rows = staged(table.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), hash_of(F.col(key)).alias("hash"),
                               F.coalesce(F.octet_length(F.col(payload)), F.lit(0)).cast("long").alias("bytes")), "shard-rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    high = min(HASH_BITS, max(1, (total // limit).bit_length()) + SPREAD)
    low, left, done = 0, rows, None
    while True:
        directory = _directory(left, low, high, limit)
        found = (left.withColumn("cell", _prefix(high)).join(directory, "cell").drop("cell"))
        placed = found.where("depth is not null").withColumn("page", F.lit(0).cast("long"))
        done = placed if done is None else done.unionByName(placed)
        if directory.where("depth is null").isEmpty():
            break
        left = staged(found.where("depth is null").drop("depth"), "shard-left")
        if high == HASH_BITS:
            done = done.unionByName(_pages(left, limit))
            break
        low, high = high + 1, min(HASH_BITS, high + STEP)
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin(_prefix(F.col("depth"))), F.col("depth"), F.lit("0")))
    out = done.withColumn("shard", bits)
    sums = out.groupBy("shard", "page").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    sums = staged(sums.withColumn("oversize", F.col("shard_bytes") > limit), "shard-sums")
    return out.join(sums, ["shard", "page"]).select("row", "hash", "bytes", "shard", F.col("depth").cast("int").alias("depth"), "page",
                                                    "shard_bytes", "shard_rows", "oversize")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of rows whose hashes are equal in all bits; no page of several rows exceeds the limit."""
    at = staged(rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
                            F.xxhash64(F.monotonically_increasing_id()).alias("mixed")), "shard-overflow")
    at = at.withColumn("slice", F.struct("part", (F.col("place") / 10_000).cast("long").alias("block")))
    big = at.where(F.col("bytes") * 2 > limit)  # a page to each row over half the limit
    small = at.where(F.col("bytes") * 2 <= limit)
    inside = Window.partitionBy("hash", "slice").orderBy("place")
    sums = small.groupBy("hash", "slice").agg(F.sum("bytes").alias("words"))
    before = Window.partitionBy("hash").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(sums.select("hash", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")), "shard-bases")
    start = F.col("base") + F.coalesce(F.sum("bytes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # rows that start in the same half-limit stretch make a page: at most half the limit and one more row
    paged = (small.join(bases, ["hash", "slice"]).withColumn("page", F.floor(start / F.lit(max(1, limit // 2)))))
    alone = big.withColumn("page", -1 - F.col("place"))
    names = ["row", "hash", "bytes"]
    return (paged.select(*names, F.lit(HASH_BITS).alias("depth"), F.col("page").cast("long").alias("page"))
            .unionByName(alone.select(*names, F.lit(HASH_BITS).alias("depth"), F.col("page").cast("long").alias("page"))))
