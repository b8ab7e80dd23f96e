"""Frequent itemsets in two passes over the baskets.

Pass one mines stretches of baskets by themselves: an itemset with the wanted
share of all baskets has that share in some stretch, so the union of what is
frequent locally holds everything that is frequent globally.  A stretch is
turned into vertical bit sets (a bit per basket for each item), and itemsets
are grown depth first by intersecting them.  Pass two counts the candidates
exactly: they form a trie (with an itemset, its prefixes are candidates too), and
each stretch's bit sets are intersected along it.  A task adds its stretches up
before anything is shuffled, so at most one row per candidate and task moves.

Bounds.  The trie is sent to the tasks if it has at most ``MAX_TRIE`` itemsets;
more candidates are counted by the containment join
(:mod:`quarry.operators.containment`) instead.  A stretch has so many baskets that
its own threshold is ``MIN_LOCAL`` at least, else it would offer sets that
occur by chance; where that needs more than ``MAX_STRETCH`` baskets (very low
thresholds), :func:`supports_two_passes` says so and FP-growth is the method to use.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.containment import contained
from quarry.plans.lineage import scope, staged

MIN_LOCAL = 8
MIN_STRETCH = 1 << 12
MAX_STRETCH = 1 << 18
MAX_TRIE = 200_000


def stretch_size(n: int, min_count: int) -> int:
    """Baskets of one stretch, at which the scaled threshold is about ``MIN_LOCAL`` or more."""
    return max(MIN_STRETCH, -(-MIN_LOCAL * n // max(1, min_count)))


def supports_two_passes(n: int, min_count: int) -> bool:
    return n <= MAX_STRETCH or stretch_size(n, min_count) <= MAX_STRETCH


class BitSets:
    """For each item of a stretch of baskets, the baskets that hold it, as 64-bit words of bits."""

    def __init__(self, baskets: pa.Array):
        self.n = len(baskets)
        self.words = -(-self.n // 64)
        lengths = baskets.value_lengths().fill_null(0).to_numpy()
        coded = baskets.flatten().dictionary_encode()
        self.items = coded.dictionary
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(self.n), lengths)
        order = np.argsort(codes, kind="stable")
        self.rows = rows[order]
        self.starts = np.searchsorted(codes[order], np.arange(len(self.items) + 1))

    def most(self, code: int) -> int:
        """Upper bound of an item's baskets (repeats included)."""
        return int(self.starts[code + 1] - self.starts[code])

    def bits(self, code: int) -> np.ndarray:
        held = np.zeros(self.words * 64, bool)
        held[self.rows[self.starts[code]:self.starts[code + 1]]] = True
        return np.packbits(held).view(np.uint64)


def counted(bits: np.ndarray) -> np.ndarray:
    """Bits set in each row."""
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def grown(codes: np.ndarray, bits: np.ndarray, threshold: int, max_size: int | None, head: tuple = ()) -> Iterator[tuple]:
    """Itemsets (tuples of codes) with at least ``threshold`` bits, by depth-first intersection."""
    for i, code in enumerate(codes):
        here = (*head, int(code))
        yield here
        if i + 1 < len(codes) and (max_size is None or len(here) < max_size):
            both = bits[i + 1:] & bits[i]
            keep = counted(both) >= threshold
            if keep.any():
                yield from grown(codes[i + 1:][keep], both[keep], threshold, max_size, here)


def mined(baskets: pa.Array, threshold: int, max_size: int | None) -> Iterator[list]:
    """The itemsets of a stretch that at least ``threshold`` of its baskets hold."""
    sets = BitSets(baskets)
    codes = [c for c in range(len(sets.items)) if sets.most(c) >= threshold]
    if not codes:
        return
    bits = np.stack([sets.bits(c) for c in codes])
    n = counted(bits)
    order = np.argsort(n, kind="stable")
    order = order[n[order] >= threshold]  # rare items first: their intersections are small
    items = sets.items.to_pylist()
    for found in grown(np.array(codes)[order], bits[order], threshold, max_size):
        yield [items[c] for c in found]


class Trie:
    """Candidates as sorted tuples of item numbers; with a candidate its prefixes are candidates as well."""

    def __init__(self, itemsets: list[list]):
        self.items = sorted({x for s in itemsets for x in s})
        number = {x: i for i, x in enumerate(self.items)}
        coded = sorted(((tuple(sorted(number[x] for x in s)), at) for at, s in enumerate(itemsets)))
        self.children: dict[tuple, tuple[list[int], list[int]]] = {}
        for t, at in coded:
            last, places = self.children.setdefault(t[:-1], ([], []))
            last.append(t[-1])
            places.append(at)
        self.size = len(coded)

    def counts(self, baskets: pa.Array) -> np.ndarray:
        """How many of the baskets hold each candidate."""
        if not self.size:
            return np.zeros(0, np.int64)
        sets = BitSets(baskets)
        place = {x: i for i, x in enumerate(sets.items.to_pylist())}
        nothing = np.zeros(sets.words, np.uint64)
        bits = np.stack([sets.bits(place[x]) if x in place else nothing for x in self.items])
        out = np.zeros(self.size, np.int64)
        todo = [((), None)]
        while todo:
            head, held = todo.pop()
            last, places = self.children[head]
            both = bits[last] if held is None else bits[last] & held
            n = counted(both)
            out[places] = n
            todo += [((*head, c), row) for c, row, k in zip(last, both, n) if k and (*head, c) in self.children]
        return out


def _stretches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Array]:
    """The ``items`` of a task's batches in stretches of ``size`` to twice ``size`` baskets (fewer if the task has fewer)."""
    held: list[pa.Array] = []
    n = 0
    for b in batches:
        held.append(b.column("items"))
        n += b.num_rows
        while n >= 2 * size:
            whole = pa.concat_arrays(held)
            yield whole.slice(0, size)
            held, n = [whole.slice(size)], n - size
    if n:
        yield pa.concat_arrays(held)


def local_candidates(baskets: DataFrame, n: int, min_count: int, max_size: int | None, size: int) -> DataFrame:
    """``(items)``: the itemsets that are frequent in some stretch of ``(items)``, each once."""
    schema = T.StructType([baskets.schema["items"]])

    def run(batches):
        for part in _stretches(batches, size):
            threshold = max(1, -(-min_count * len(part) // n))
            out = []
            for found in mined(part, threshold, max_size):
                out.append(found)
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, part.type)], names=["items"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, part.type)], names=["items"])
    return baskets.mapInArrow(run, schema).select(F.array_sort("items").alias("items")).distinct()


def trie_counts(baskets: DataFrame, itemsets: list[list], size: int) -> DataFrame:
    """``(place, n)``: for each itemset by its place in the list, how many of ``(items)`` hold it."""
    trie = baskets.sparkSession.sparkContext.broadcast(Trie(itemsets))
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        total = np.zeros(trie.value.size, np.int64)
        for part in _stretches(batches, size):
            total += trie.value.counts(part)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=schema.fieldNames())
    return baskets.mapInArrow(run, schema).groupBy("place").agg(F.sum("n").alias("n"))


class Rules:
    """Rules ``(antecedent, consequent, confidence)`` by their consequent; an empty antecedent is in no basket."""

    def __init__(self, rules: list[tuple]):
        self.of: dict = {}
        for antecedent, consequent, confidence in rules:
            items = tuple(dict.fromkeys(x for x in antecedent if x is not None))
            if items:
                self.of.setdefault(consequent, []).append((items, confidence))

    def offers(self, baskets: pa.Array) -> Iterator[tuple]:
        """For each consequent the places of the baskets that lack it and hold an antecedent of it, the best confidence
        and the number of such rules."""
        sets = BitSets(baskets)
        place = {x: i for i, x in enumerate(sets.items.to_pylist())}
        bits: dict = {}

        def of(item):
            if item not in bits:
                bits[item] = sets.bits(place[item]) if item in place else np.zeros(sets.words, np.uint64)
            return bits[item]

        for consequent, rules in self.of.items():
            best, n = np.full(sets.n, -np.inf), np.zeros(sets.n, np.int64)
            lacking = ~of(consequent)
            for items, confidence in rules:
                held = lacking
                for x in items:
                    held = held & of(x)
                at = np.flatnonzero(np.unpackbits(held.view(np.uint8), count=sets.n))
                best[at] = np.maximum(best[at], confidence)
                n[at] += 1
            at = np.flatnonzero(n)
            if len(at):
                yield consequent, at, best[at], n[at]


def rule_offers(baskets: DataFrame, rules: list[tuple], item: T.DataType, size: int = 1 << 14) -> DataFrame:
    """``(basket, item, confidence, n_rules)`` for ``(basket, items)``, each basket by itself: what rules offer to the baskets
    that lack it.  The rules go to every task, and nothing is shuffled."""
    every = baskets.sparkSession.sparkContext.broadcast(Rules(rules))
    schema = T.StructType([baskets.schema["basket"], T.StructField("item", item), T.StructField("confidence", T.DoubleType()),
                           T.StructField("n_rules", T.LongType())])

    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, size):
                part = b.slice(start, size)
                found = list(every.value.offers(part.column("items")))
                if found:
                    consequents, at, best, n = zip(*found)
                    names = pa.array(consequents).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in at])))
                    yield pa.RecordBatch.from_arrays([part.column("basket").take(pa.array(np.concatenate(at))), names,
                                                      pa.array(np.concatenate(best)), pa.array(np.concatenate(n))], names=schema.fieldNames())
    return baskets.select("basket", "items").mapInArrow(run, schema)


def two_pass_itemsets(baskets: DataFrame, min_count: int, max_size: int | None = None, max_trie: int = MAX_TRIE,
                      min_stretch: int | None = None) -> DataFrame:
    """``(items, size, support)`` of the itemsets that at least ``min_count`` of the baskets ``(items)`` hold.

    The baskets are read once more than they are written here; empty and null baskets hold nothing, repeats
    inside a basket count once.
    """
    spark = baskets.sparkSession
    min_count = max(1, min_count)
    with scope(spark) as own:
        # already staged tables are scans; anything else is computed once
        rows = staged(baskets.select("items"), "itemset-baskets")
        n = rows.count()  # from the files' footers
        size = min_stretch or stretch_size(n, min_count)
        rows = rows.coalesce(max(1, n // size))
        found = staged(local_candidates(rows, max(n, 1), min_count, max_size, size), "itemset-candidates")
        if found.count() <= max_trie:
            listed = [r["items"] for r in found.collect()]
            counts = trie_counts(rows, listed, size)
            ids = spark.createDataFrame([(i, s) for i, s in enumerate(listed)],
                                        T.StructType([T.StructField("place", T.IntegerType()), found.schema["items"]]))
            out = counts.where(F.col("n") >= min_count).join(ids, "place").select("items", F.col("n").alias("support"))
        else:
            held = rows.withColumn("basket_id", F.monotonically_increasing_id())
            pairs = contained(found.select(F.col("items").alias("set_id"), "items"), staged(held, "itemset-numbered"))
            out = (pairs.groupBy("set_id").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_count)
                   .select(F.col("set_id").alias("items"), "support"))
        return own.hand_over(staged(out.select("items", F.size("items").alias("size"), "support"), "itemsets"))
