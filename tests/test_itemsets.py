"""Two-pass itemsets, the containment join and rules applied to baskets, against brute force and FP-growth."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import itemsets
from quarry.operators.containment import contained
from quarry.operators.patterns import apply_rules, association_rules, frequent_itemsets

SCHEMA = "basket long, items array<string>"


def make(spark, baskets, parts=3):
    return spark.createDataFrame(list(enumerate(baskets)), SCHEMA).repartition(parts)


def brute(baskets, least, max_size=None):
    n = Counter()
    for b in baskets:
        b = sorted({x for x in b or [] if x is not None})
        for k in range(1, min(len(b), max_size or len(b)) + 1):
            n.update(itertools.combinations(b, k))
    return {s: c for s, c in n.items() if c >= least}


def rows(df):
    got = [(tuple(r["items"]), r["size"], r["support"]) for r in df.collect()]
    assert all(len(s) == k for s, k, _ in got) and len({s for s, _, _ in got}) == len(got)
    return {s: c for s, _, c in got}


def random_baskets(seed, n, hot=True):
    rng = random.Random(seed)
    out = [rng.sample("abcdefghij", rng.randint(0, 6)) for _ in range(n)]
    return [[*b, "HOT"] if hot and i % 3 == 0 else b for i, b in enumerate(out)]


@pytest.mark.parametrize("max_size", [None, 1, 2, 3])
def test_two_passes_equal_brute_force_and_fpgrowth(spark, max_size):
    baskets = random_baskets(1, 400)
    df = make(spark, baskets)
    got = rows(frequent_itemsets(df, min_count=12, max_size=max_size, method="two_pass"))
    assert got == brute(baskets, 12, max_size)
    assert got == rows(frequent_itemsets(df, min_count=12, max_size=max_size, method="fpgrowth"))


def test_stretches_offer_candidates_and_the_recount_is_exact(spark):
    # sorted baskets: what is frequent in one stretch is rare in the others
    baskets = sorted(random_baskets(2, 600, hot=False))
    df = make(spark, baskets, 1)
    got = rows(itemsets.two_pass_itemsets(df, 30, min_stretch=50))
    assert got == brute(baskets, 30)


def test_candidates_beyond_the_trie_are_counted_by_the_join(spark):
    baskets = random_baskets(3, 200)
    assert rows(itemsets.two_pass_itemsets(make(spark, baskets), 10, max_trie=0)) == brute(baskets, 10)


def test_nulls_repeats_empty_baskets_and_empty_tables(spark):
    baskets = [None, [], ["a", "a", "b"], ["b", None, "a"], [None], ["a"], ["c"]]
    df = make(spark, baskets)
    assert rows(itemsets.two_pass_itemsets(df, 2)) == brute(baskets, 2) == {("a",): 3, ("b",): 2, ("a", "b"): 2}
    assert rows(itemsets.two_pass_itemsets(df.limit(0), 2)) == {}
    assert rows(itemsets.two_pass_itemsets(df, 99)) == {}
    numbers = spark.createDataFrame([([3, 1],), ([1, 3, 2],)], "items array<long>")
    assert rows(itemsets.two_pass_itemsets(numbers, 2)) == {(1,): 2, (3,): 2, (1, 3): 2}


def test_very_low_thresholds_go_to_fpgrowth(spark):
    assert itemsets.supports_two_passes(10**9, 10**7) and not itemsets.supports_two_passes(10**9, 3)
    assert itemsets.stretch_size(10**9, 10**5) * 10**5 >= itemsets.MIN_LOCAL * 10**9
    with pytest.raises(ValueError):
        frequent_itemsets(make(spark, [["a"]]), min_count=1, method="other")


def brute_contained(sets, baskets):
    clean = lambda s: {x for x in s or [] if x is not None}
    return {(i, j) for i, s in sets for j, b in baskets if clean(s) and clean(s) <= clean(b)}


@pytest.mark.parametrize("split", [200_000, 5])
def test_containment_join_equals_brute_force(spark, split):
    rng = random.Random(5)
    baskets = list(enumerate([*random_baskets(4, 150), None, [], ["only"], [None, "a"], ["a", "a"]]))
    sets = [(f"s{i}", rng.sample("abcdefghij", rng.randint(0, 4))) for i in range(60)]
    sets += [("hot", ["HOT"]), ("hot2", ["HOT", "a"]), ("none", ["zzz"]), ("half", ["a", "zzz"]), ("null", None), ("rep", ["b", "b", "a"]), ("nulls", [None])]
    got = contained(spark.createDataFrame(sets, "set_id string, items array<string>"),
                    spark.createDataFrame(baskets, "basket_id long, items array<string>"), split_size=split).collect()
    assert len(got) == len(set(map(tuple, got))) and {tuple(r) for r in got} == brute_contained(sets, baskets)


def test_containment_join_compares_no_whole_sets(spark):
    sets = spark.createDataFrame([(1, ["a", "b"])], "set_id long, items array<string>")
    baskets = spark.createDataFrame([(1, ["a", "b", "c"])], "basket_id long, items array<string>")
    plan = contained(sets, baskets)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "array_except" not in plan


def test_containment_of_empty_tables(spark):
    sets = spark.createDataFrame([(1, ["a"])], "set_id long, items array<string>")
    baskets = spark.createDataFrame([(1, ["a"])], "basket_id long, items array<string>")
    assert contained(sets.limit(0), baskets).count() == 0 and contained(sets, baskets.limit(0)).count() == 0


def test_rules_are_applied_where_the_antecedent_is_held(spark):
    baskets = random_baskets(6, 300)
    df = make(spark, baskets)
    rules = association_rules(df, min_count=15, min_conf=0.3)
    listed = [(tuple(r.antecedent), r.consequent, r.confidence) for r in rules.collect()]
    support = brute(baskets, 15)
    want = {(a, c): support[tuple(sorted((*a, c)))] / support[a] for s in support if len(s) > 1 for c in s
            for a in [tuple(x for x in s if x != c)]}
    assert {(a, c): round(f, 9) for a, c, f in listed} == {k: round(v, 9) for k, v in want.items() if v >= 0.3}
    best = {}
    for i, b in enumerate(baskets):
        for a, c, f in listed:
            if set(a) <= set(b) and c not in b:
                old = best.get((i, c), (0, 0))
                best[(i, c)] = (max(old[0], f), old[1] + 1)
    got = {(r.basket, r["item"]): (r.confidence, r.n_rules) for r in apply_rules(rules, df).collect()}
    assert got == best and best


def test_pairs_of_a_hot_item_are_counted_once_per_task(spark):
    """Recounting moves a row per candidate and task, however often the pair occurs."""
    df = make(spark, [["x", "y"]] * 900 + [["x"]] * 300, 4)
    counts = itemsets.trie_counts(df.select("items"), [["x"], ["x", "y"], ["y"]], 100)
    assert {r.place: r.n for r in counts.collect()} == {0: 1200, 1: 900, 2: 900}
    assert df.select(F.explode("items")).count() == 2100


def test_rules_meet_baskets_in_their_tasks(spark):
    """few rules go to the tasks; the rows are those of the containment join, also where a basket repeats."""
    import random

    from quarry.operators.patterns import apply_rules
    rnd = random.Random(5)
    rows = [(i, sorted(rnd.sample("abcdefgh", rnd.randint(0, 6)))) for i in range(300)]
    rules = spark.createDataFrame([(list(a), c, 0.1 * k + 0.2) for k, (a, c) in enumerate([("ab", "c"), ("a", "c"), ("d", "h"), ("efg", "a"), ("z", "b")])],
                                  "antecedent array<string>, consequent string, confidence double")

    def found(baskets, **options):
        df = spark.createDataFrame(baskets, "basket int, items array<string>")
        return sorted((r.basket, r.item, round(r.confidence, 9), r.n_rules) for r in apply_rules(rules, df, **options).collect())
    for baskets in (rows, rows[:20] + rows[:5], [], [(1, ["a", None, "a"]), (2, None)]):
        assert found(baskets) == found(baskets, max_rules=0)
    from unittest import mock
    with mock.patch("quarry.operators.patterns.contained", side_effect=AssertionError("shuffled")):
        assert found(rows)
