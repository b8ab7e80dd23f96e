import numpy as np
import pytest

from quarry.operators.cluster import centres_frame, init_centres, kmeans_assign, kmeans_fit
from quarry.operators.patterns import association_rules, baskets, frequent_itemsets


def lloyd(X, C, rounds):
    C = C.copy()
    for _ in range(rounds):
        d = ((X[:, None, :] - C[None, :, :]) ** 2).sum(-1)
        a = d.argmin(1)
        for k in range(len(C)):
            if (a == k).any():
                C[k] = X[a == k].mean(0)
    return C


def test_kmeans_matches_numpy(spark):
    rnd = np.random.default_rng(1)
    X = np.concatenate([rnd.normal(c, 0.3, (30, 3)) for c in (0.0, 3.0, 6.0)])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, vec array<double>")
    init = init_centres(df, 3)
    assert np.allclose(init, X[:3])
    centres, rounds = kmeans_fit(df, 3, converge_dist=0.0, max_iter=4)
    assert 1 <= rounds <= 4
    assert np.allclose(centres, lloyd(X, X[:3], rounds))
    assert np.allclose(centres, lloyd(X, X[:3], 4))  # converged: more rounds change nothing
    got = {r.id: (r.cid, r.sq_dist) for r in kmeans_assign(df, centres).collect()}
    d = ((X[:, None, :] - np.array(centres)[None]) ** 2).sum(-1)
    for i in range(len(X)):
        assert got[i][0] == int(d[i].argmin())
        assert got[i][1] == pytest.approx(d[i].min())
    assert centres_frame(spark, centres).count() == 3


def test_kmeans_tie_goes_to_lowest_index(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0])], "id long, vec array<double>")
    assert kmeans_assign(df, [[0.0, 0.0], [2.0, 0.0]]).first().cid == 0


BASKETS = [[1, 2, 5], [1, 2], [1, 3], [2, 3], [1, 2, 3], [4], [1, 4]]


def basket_df(spark):
    rows = [(b, i) for b, items in enumerate(BASKETS) for i in items]
    return baskets(spark.createDataFrame(rows, "b long, item long"), "b", "item")


def test_frequent_itemsets_golden(spark):
    b = basket_df(spark)
    got = {tuple(r["items"]): r.support for r in frequent_itemsets(b, min_count=2).collect()}
    assert got == {(1,): 5, (2,): 4, (3,): 3, (4,): 2, (1, 2): 3, (1, 3): 2, (2, 3): 2}
    got3 = {tuple(r["items"]): r.support for r in frequent_itemsets(b, min_count=3).collect()}
    assert got3 == {(1,): 5, (2,): 4, (3,): 3, (1, 2): 3}


def test_association_rules_golden(spark):
    rules = association_rules(basket_df(spark), min_count=3, min_conf=0.5).collect()
    got = {(tuple(r.antecedent), r.consequent): (r.support, r.confidence) for r in rules}
    assert got.keys() == {((1,), 2), ((2,), 1)}
    assert got[((1,), 2)][1] == pytest.approx(0.6)
    assert got[((2,), 1)][1] == pytest.approx(0.75)
    assert got[((1,), 2)][0] == 3


def test_support_is_monotone(spark):
    sets = {tuple(r["items"]): r.support for r in frequent_itemsets(basket_df(spark), min_count=2).collect()}
    for s, c in sets.items():
        for i in range(len(s)):
            sub = s[:i] + s[i + 1:]
            if sub:
                assert sets[sub] >= c


def test_ml_mode_finds_separated_clusters(spark):
    from quarry.operators.cluster import kmeans_fit_ml
    rnd = np.random.default_rng(2)
    X = np.concatenate([rnd.normal(c, 0.1, (20, 2)) for c in (0.0, 5.0)])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, vec array<double>")
    centres = sorted(kmeans_fit_ml(df, 2))
    assert np.allclose(centres, [X[:20].mean(0), X[20:].mean(0)], atol=1e-6)


def test_kmeans_round_sums_in_its_tasks(spark):
    from quarry.operators.cluster import _packed, _sums

    rows = [([float(i % 5), float(i % 3)],) for i in range(500)]
    points = spark.createDataFrame(rows, "vec array<double>").repartition(3).mapInArrow(_packed, "point binary")
    centres = np.array([[0.0, 0.0], [0.0, 0.0], [4.0, 2.0]])  # the second of two equal centres gets nothing
    got = points.mapInArrow(_sums(centres), "cid int, n long, total array<double>").collect()
    assert len(got) <= 3 * 2 and {r.cid for r in got} == {0, 2} and sum(r.n for r in got) == 500
    assert np.allclose(sum(np.array(r.total) for r in got), np.array([r[0] for r in rows]).sum(0))
    with pytest.raises(Exception, match="dimensions"):
        kmeans_fit(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "id long, vec array<double>"), 1)
