"""Document fingerprints by winnowing (built-in functions only).

The rolling hashes of all ``k``-grams of words are cut to the minimum of every
window of ``window`` consecutive hashes, the rightmost one among equals, with its
position.  Two texts that share a run of at least ``k + window - 1`` words share a
selected hash (the match guarantee), and a run shorter than ``k`` words is never
matched.

A position is the minimum of some window exactly if the hashes next to it
that are not smaller (to the left) and larger (to the right) reach over
``window - 1`` places together, so selection is one filter over the array of
hashes and no window of rows is built.

Defined results: a null text counts as empty and has no hashes; a text of fewer
than ``k`` words is one gram of all its words; fewer than ``window`` hashes are
one window; likeness is the Jaccard similarity of the selected hashes, 1 if both
sets are empty and 0 if one is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.llm.common import staged

K = 3
WINDOW = 4


def gram_hashes(text: Column, k: int = K) -> Column:
    """``array<int>``: the 32-bit hash of every ``k`` consecutive words."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def rolled(words):
        n = F.size(words)
        grams = F.transform(F.slice(words, 1, n - k + 1),
                            lambda w, i: F.hash(w, *[F.get(words, i + j) for j in range(1, k)]))
        return F.when(n == 0, F.array().cast("array<int>")).when(n < k, F.array(F.hash(F.concat_ws(" ", words)))).otherwise(grams)
    return _let(words, rolled)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def selected(hashes: Column, window: int = WINDOW) -> Column:
    """``array<struct<hash, position>>``: the winnowed hashes with their positions."""
    def pick(h):
        n = F.size(h)
        w = F.least(F.lit(window), n)

        def is_minimum(x, i):
            # reach: places to either side that a window holding x may cover
            left = F.lit(0)
            for j in range(window - 1, 0, -1):
                left = F.when((i >= j) & (F.get(h, i - j) >= x), 1 + left).otherwise(F.lit(0))
            right = F.lit(0)
            for j in range(window - 1, 0, -1):
                right = F.when((i + j < n) & (F.get(h, i + j) > x), 1 + right).otherwise(F.lit(0))
            return left + right >= w - 1
        marked = F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("position"), is_minimum(x, i).alias("min")))
        kept = F.filter(marked, lambda s: s["min"])
        return F.transform(kept, lambda s: F.struct(s["hash"].alias("hash"), s["position"].alias("position")))
    return _let(hashes, pick)


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    return selected(gram_hashes(text, k), window)


def digest(marks: Column) -> Column:
    """A short string of a fingerprint: equal for equal hashes at equal positions."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), marks)), 16, "0") for seed in (1, 2)])


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes of two fingerprints (arrays of hashes)."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def followers(keys: DataFrame) -> DataFrame:
    """``(key, next)``: each distinct key ``struct<id, h>`` with the next one in descending order of
    ids, the first after the last.  Only keys are sorted: a range partitioning, a
    neighbour inside each partition, and one row per partition for the seams."""
    order = [F.col("key.id").desc_nulls_last(), F.col("key.h").asc()]
    ranged = keys.select("key").distinct().repartitionByRange(*order).select("key", F.spark_partition_id().alias("part"))
    parts = staged(ranged, "winnow-keys")
    inside = Window.partitionBy("part").orderBy(*order)
    near = parts.select("*", F.lead("key").over(inside).alias("next"), F.row_number().over(inside).alias("rn"))
    heads = near.where("rn = 1").select("part", F.col("key").alias("head"))
    # one row per partition
    seam = Window.orderBy("part")
    first = F.first("head").over(seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    seams = heads.select("part", F.coalesce(F.lead("head").over(seam), first).alias("seam"))
    return near.join(F.broadcast(seams), "part").select("key", F.coalesce("next", "seam").alias("next"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last third replaced by the
    beginning of the next document's), with the likeness to the edited and the next text.

    Texts move once, to their key; a follower's beginning and its hashes move once
    more, to the key before it.  Equal rows are one document here: they have
    the same follower and the same result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a struct as the key: null ids are equal in it, and every join and grouping shares its partitioning
    key_type = f"struct<id:{docs.schema[id_col].dataType.simpleString()},h:bigint>"  # as staged tables have it
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h")).cast(key_type)
    rows = docs.select(key.alias("key"), text.alias("text"))
    pairs = staged(followers(rows), "winnow-pairs")
    need = rows.select("key", F.floor(F.length("text") / 3).alias("third")).distinct()
    # per follower: whom it follows, and how much of it that one takes
    before = staged(pairs.join(need, "key").select(F.col("next").alias("key"), F.col("key").alias("prev"), "third"), "winnow-before")
    # fingerprints are taken after texts have moved: they hardly compress
    own = rows.join(before, "key")
    ahead = (own.groupBy("key").agg(F.first(F.struct("prev", "text", "third")).alias("f")).select("f.*")
             .select(F.col("prev").alias("key"), F.expr("substring(text, 1, cast(third as int))").alias("start"),
                     fingerprint(F.col("text"), k, window)["hash"].alias("next_hashes")))
    joined = own.select("key", "text").join(ahead, "key").select(F.col("key.id").alias("id"), "text", "start", "next_hashes",
                                                                 fingerprint(F.col("text"), k, window).alias("marks"))
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 3) as int))"), F.col("start"))
    out = joined.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "next_hashes",
                        fingerprint(F.col("text"), k, window).alias("marks"))
    out = out.withColumn("edited_marks", fingerprint(F.col("edited"), k, window))
    return out.select(F.col("id").alias(id_col), "n_chars", "edited", F.col("marks").alias("fingerprint"),
                      F.col("edited_marks").alias("edited_fingerprint"), likeness(F.col("marks")["hash"], F.col("edited_marks")["hash"]).alias("near_edited"),
                      likeness(F.col("marks")["hash"], F.col("next_hashes")).alias("near_next"))
