"""Spelling variants: words within one edit of each other, found by pivotal grams, and the form each one is a variant of.

Words.  A text's runs of letters, lower-cased in A-Z; of the runs whose hash
:func:`corpus_words` draws, one code point is deleted (typing errors made to a
known rule).  Distinct results of at least ``MIN_LENGTH`` code points and
``MIN_COUNT`` occurrences are the words; they are counted with map-side sums.

Pivotal grams.  All bigrams are ranked by the number of words' positions they
take, rare first.  A word's *prefix* is its grams up to the rank of its third
rarest; a dynamic programme over the prefix in text order chooses the two *pivots*:
grams that share no code point and are rarest in sum.  One edit destroys at
most one of two disjoint grams.  So of two words one edit apart, a
pivot of the word whose third gram ranks lower stands in the other's prefix, and
the pivots meet an index of the prefixes in an equi-join.

Position limits.  A pivot that outlives the edit keeps its distance from the
start if the edit is behind it and from the end if it is before it.  The side
that holds the edit is halved: the edit is in one half, the other is
unchanged as well.  So the join's key holds the indexed word's length, the
case, the gram's position and all code points that the case leaves unchanged;
a word probes for lengths one less, the same and one more.  Candidates are then
verified by edit distance.  A key's group holds words that differ within half of a side
alone; a group that is still large is split by AQE, as both sides of the join
come straight from the shuffle.

Ties.  If a gram of the lowest rank repeats, the prefix takes its first
``TIED`` positions: at most two of them stand before a pivot in its own word,
and one edit makes at most two more.

Forms.  A word's form is its near word of largest count, if that is at least twice
the word's own; ties go to the smallest.  Counts grow along the forms, so following
them ends; it is done by doubling (a join per round).

Defined results: null texts have no words; a null id is hashed as the empty
string; repeated rows count as often as they stand there; without words the result is empty.
Memory: one text, and one word's grams, at a time; the gram ranks are bounded by the square of the 90 letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import small_batches, staged

#: The characters between runs of letters.
BREAK = r"[^A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH = 5
MIN_COUNT = 3
EDIT_MODULUS = 97
TIED = 5


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                 min_count: int = MIN_COUNT, edit_modulus: int = EDIT_MODULUS) -> DataFrame:
    """``(word, n)``: the words and their occurrences."""
    runs = (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                        F.explode(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), BREAK)).alias("run"))
            .where(F.length("run") >= min_length))  # a deletion only shortens
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, UPPER.lower()))
    hashed = (runs.select("id", low.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % edit_modulus == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Bigrams by number of positions, rare first; at most as many as pairs of letters, whatever the number of words."""
    chars = words.select(F.split("word", "").alias("c"))
    grams = chars.select(F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1),
                                              lambda a, b: F.concat(a, b))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram").collect()
    return {r["gram"]: i for i, r in enumerate(counted)}


def choose_pivots(grams: list[tuple[int, int]]) -> tuple[int, int]:
    """Positions of the two disjoint grams of ``(position, rank)``, in order of position, whose ranks have the least sum."""
    alone: list[tuple[int, int]] = []  # after each gram: (rank, position) of the best single one so far
    best: tuple[int, int, int] | None = None
    for i, (pos, rank) in enumerate(grams):
        j = i - 1
        while j >= 0 and grams[j][0] + 2 > pos:  # at most one neighbour overlaps
            j -= 1
        if j >= 0:
            pair = (alone[j][0] + rank, alone[j][1], pos)
            best = pair if best is None else min(best, pair)
        alone.append(min(alone[-1], (rank, pos)) if alone else (rank, pos))
    assert best is not None, "words of five code points have three grams, so two disjoint ones"
    return best[1], best[2]


def prefix_and_pivots(word: str, ranks: dict[str, int]) -> tuple[int, list[int], tuple[int, int]]:
    """``(last, prefix, pivots)``: the rank of the third rarest gram, positions of the prefix's grams and of the pivots."""
    own = [ranks[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(own)[2]
    below = [i for i, r in enumerate(own) if r < last]
    level = [i for i, r in enumerate(own) if r == last][:TIED]
    three = sorted(below + level[:3 - len(below)])
    return last, sorted(below + level), choose_pivots([(i, own[i]) for i in three])


def behind_keys(word: str, n: int, at: int) -> Iterator[tuple]:
    """What is left of ``word`` by an edit behind its gram at ``at``, for an indexed word of length ``n``:
    ``(n, case, at, head, tail)``, the edit in the later half behind the gram, or in the earlier half."""
    size, end = len(word), at + 2
    half = (n - end) // 2
    if end <= n:
        yield n, 0, at, word[:end + half], ""
        yield n, 1, at, word[:end], word[size - (n - end - half):]


def before_keys(word: str, n: int, at: int) -> Iterator[tuple]:
    """The same for an edit before the gram, which stands at ``at`` in the indexed word: in the earlier half, or in the later."""
    size, half = len(word), at // 2
    if 0 <= at and n - half <= size:
        yield n, 2, at, "", word[size - (n - half):]
    if 0 <= at:
        yield n, 3, at, word[:half], word[size - (n - at):]


_ENTRY = T.StructType([T.StructField("key", T.LongType()), T.StructField("word", T.StringType()), T.StructField("last", T.IntegerType())])


def _entries(words: DataFrame, ranks, probing: bool) -> DataFrame:
    """``(key, word, last)``: what the words' prefixes are indexed under, or what their pivots probe for."""
    def keys(word: str) -> tuple[int, set]:
        last, prefix, pivots = prefix_and_pivots(word, ranks.value)
        size = len(word)
        if not probing:
            return last, {k for at in prefix for make in (behind_keys, before_keys) for k in make(word, size, at)}
        # behind the gram nothing moves; before it everything moves with the length
        return last, {k for at in pivots for n in (size - 1, size, size + 1)
                      for k in (*behind_keys(word, n, at), *before_keys(word, n, at + n - size))}

    def run(batches):
        import xxhash
        new = xxhash.xxh3_64_intdigest
        for b in batches:
            hashes, owners, lasts = [], [], []
            texts = b.column("word").to_pylist()
            for i, word in enumerate(texts):
                last, found = keys(word)
                hashes += [new(f"{n} {case} {at} {head} {tail}".encode()) for n, case, at, head, tail in found]
                owners += [i] * len(found)
                lasts += [last] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hashes, np.uint64).view(np.int64)), b.column("word").take(pa.array(owners, pa.int32())),
                                              pa.array(lasts, pa.int32())], names=_ENTRY.fieldNames())
    return words.select("word").mapInArrow(run, _ENTRY)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, b)``, ``a < b``: all pairs of different words of ``(word, n)`` with edit distance one."""
    spark = words.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(gram_ranks(words))
    index, probes = _entries(words, ranks, False).alias("r"), _entries(words, ranks, True).alias("s")
    near = ((F.col("s.key") == F.col("r.key")) & (F.col("s.last") <= F.col("r.last")) & (F.levenshtein("s.word", "r.word", 1) == 1))
    # a word has tens of entries, which the planner takes for one: without the hint it may gather the whole index on the driver
    found = probes.join(index.hint("merge"), near).select(F.least("s.word", "r.word").alias("a"), F.greatest("s.word", "r.word").alias("b"))
    out = staged(found.distinct(), "spelling-pairs")
    ranks.destroy()
    return out


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` without circles: forms followed to the last, twice as far in each round."""
    state = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        new = staged(state.join(ahead, state.root == ahead.at, "left")
                     .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        state = new.select("word", "root")
        if new.where("moved").isEmpty():
            return state


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = 2, **options) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word; ``options`` as of :func:`corpus_words`."""
    words = staged(corpus_words(docs, id_col, text_col, **options), "spelling-words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    judged = (words.join(best, "word", "left")
              .withColumn("varies", F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False)))
              .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                      F.when(F.col("varies"), F.col("best.other")).alias("form"), F.when(F.col("varies"), -F.col("best.less")).alias("form_n")))
    judged = staged(judged, "spelling-forms")
    last = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
