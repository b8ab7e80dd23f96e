"""Mixing sources to target weights with a time-varying curriculum (built-in functions only).

Targets.  Sources, in code point order (null last), get the weights in turn
and share ``budget`` times all words.  No source gives more than ``max_repeats`` times
its size; the excess is shared by weight among the others.  The level at which
the shares settle is found in closed form from running sums over the sources
in the order in which they fill up (one row per source).

Taking.  Within a source documents follow the md5 of their id.  Pass ``k`` of a
document starts where the words before it and ``k`` whole passes end; it is
taken if its middle lies below the source's target.  Whole documents are taken,
so a source's taken words come within half a document of its target.

Time.  Source weights change over the training time ``t`` from 0 to 1: the rate
of a source is its target times ``1 + slope * (1 - 2 t)``.  Its integral
``target * (t + slope * t * (1 - t))`` is the demand up to ``t``; solving for ``t``
the demand that a taken pass begins at gives its training position.  The
result is range-sorted by first position.

At scale the words before a document are a prefix sum in two steps: over
slices of the md5 range (a few rows per source and slice), then inside a slice,
so a source with a third of all rows is spread over many tasks.

Defined results: a null text has size 0, and documents of size 0 are taken 0
times and have no position; a null source is one of its own, the last; rows
with equal ids and sizes follow each other and are counted apart; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.llm.common import staged

SLICE_ROWS = 2_000


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sources: DataFrame, weights: list[float], slopes: list[float], budget: float, max_repeats: float) -> DataFrame:
    """``(source, source_size, weight, slope, target)`` from ``(source, source_size)``, one row per source."""
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    pick = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(turn, F.lit(len(values))).cast("int"))
    s = sources.withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
    s = s.withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
    fills = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    s = (s.withColumn("need", F.least(F.lit(float(budget)), F.lit(float(max_repeats))) * F.sum("source_size").over(everything))
         .withColumn("full", F.coalesce(F.sum("cap").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("need") - F.col("full")) / F.col("open")))
    # the first source that the level doesn't fill sets the level of all that are left open
    settled = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    s = s.withColumn("settled", settled["level"])
    return s.select("source", "source_size", "weight", "slope",
                    F.least("cap", F.coalesce(F.col("settled") * F.col("weight"), F.col("cap"))).alias("target"))


def position(demand: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``demand``."""
    y = F.least(demand / target, F.lit(1.0))
    root = F.sqrt(F.greatest((1 + slope) * (1 + slope) - 4 * slope * y, F.lit(0.0)))
    return F.when(slope == 0, y).otherwise(2 * y / ((1 + slope) + root))


def mix(docs: DataFrame, weights: list[float], budget: float = 1.5, max_repeats: int = 2, slopes: list[float] | None = None,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None, write_rows: bool = True, ordered: bool = True) -> DataFrame:
    """``(row, size, source_size, target, taken, positions)`` for every row of ``docs``.

    ``write_rows`` writes the rows and their sizes once; without it they are read and
    counted again, which is better for rows with their texts.  ``ordered``
    range-sorts the result by first position.
    """
    slopes = [0.0] * len(weights) if slopes is None else slopes
    columns = docs.columns if keep is None else keep
    hashed = F.coalesce(F.md5(F.col(id_col).cast("string")), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(source_col).alias("source"),
                              n_words(F.col(text_col)).alias("size"), hashed.alias("hash"))
    rows = staged(rows, "mix-rows") if write_rows else rows
    total = rows.count()
    slices = max(1, -(-total // SLICE_ROWS))
    at = F.coalesce(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long"), F.lit(0))
    rows = rows.withColumn("slice", F.floor(at * F.lit(slices) / F.lit(1 << 32)).cast("int"))

    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_slice.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    per_source = targets(per_slice.groupBy("source").agg(F.sum("words").alias("source_size")), weights, slopes, budget, max_repeats)
    bases = staged(bases.alias("b").join(per_source.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
                   .select(F.col("b.source").alias("s"), F.col("slice").alias("sl"), "base", "source_size", "slope", "target"), "mix-bases")

    inside = Window.partitionBy("source", "slice").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("sl"))))
    start = (F.col("base") + F.col("inner")).cast("double")
    passes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda k: start + k * F.col("source_size")),
                      lambda at: (F.col("size") > 0) & (2 * at + F.col("size") <= 2 * F.col("target")))
    times = F.transform(passes, lambda at: position(at, F.col("target"), F.col("slope")))
    out = (placed.withColumn("positions", times)
           .select("row", "size", "source_size", "target", (F.size("positions") * F.col("size")).alias("taken"), "positions", "hash"))
    # documents that are not taken have no position; the hash keeps them from lying in one range
    return (out.orderBy(F.asc_nulls_last(F.get("positions", F.lit(0))), "hash", "size") if ordered else out).drop("hash")


def training_order(mixed: DataFrame) -> DataFrame:
    """The taken documents as often as they are taken, columns of the table, range-sorted by training position."""
    taken = mixed.select("row", F.explode("positions").alias("position"))
    return taken.orderBy("position").select("row.*")
