"""Options and secondary entry points not covered elsewhere."""

import collections
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators.cluster import init_centres, kmeans_fit
from quarry.operators.graph import bfs_paths, edge_betweenness, hits
from quarry.operators.minhash import mirrored, pair_similarity
from quarry.sources.writers import write_groups, write_scores

DIRECTED = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "a"), ("e", "a")]


def brute_bfs(edges, source, directed):
    adj = collections.defaultdict(set)
    for u, v in edges:
        if u != v:
            adj[u].add(v)
            if not directed:
                adj[v].add(u)
    dist, sigma, frontier = {source: 0}, {source: 1}, [source]
    while frontier:
        nxt = collections.defaultdict(int)
        for u in frontier:
            for v in adj[u]:
                if v not in dist:
                    nxt[v] += sigma[u]
        for v, s in nxt.items():
            dist[v], sigma[v] = dist[frontier[0]] + 1, s
        frontier = list(nxt)
    return {n: (dist[n], float(sigma[n])) for n in dist}


@pytest.mark.parametrize("directed", [True, False])
def test_bfs_matches_brute_force(spark, directed):
    df = spark.createDataFrame(DIRECTED, "src string, dst string")
    got = collections.defaultdict(dict)
    for r in bfs_paths(df, directed=directed).collect():
        got[r.source][r.node] = (r.dist, r.sigma)
    nodes = {u for u, _ in DIRECTED} | ({v for _, v in DIRECTED} if not directed else set())
    for s in nodes:
        assert got[s] == brute_bfs(DIRECTED, s, directed)


def test_bfs_and_betweenness_with_sources(spark):
    df = spark.createDataFrame(DIRECTED, "src string, dst string")
    src = spark.createDataFrame([("a",)], "node string")
    got = {r.node: (r.dist, r.sigma) for r in bfs_paths(df, src).collect()}
    assert got == brute_bfs(DIRECTED, "a", False)
    eb = {(r.u, r.v): r.betweenness for r in edge_betweenness(df, src).collect()}
    # from source a alone: each reached node's shortest paths load the edges toward it
    assert sum(eb.values()) == pytest.approx(sum(d for d, _ in got.values()))


def test_hits_with_explicit_nodes(spark):
    df = spark.createDataFrame(DIRECTED, "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in "abcdez"], "node string")
    got = {r.node: (r.hub, r.authority) for r in hits(df, 2, nodes=nodes).collect()}
    assert got["z"] == (0.0, 0.0) and len(got) == 6


def test_mirrored_containment(spark):
    sets = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (2, 4)], "id long, item long")
    pairs = spark.createDataFrame([(1, 2)], "id_a long, id_b long")
    got = {(r.id_a, r.id_b): r.similarity
           for r in mirrored(pair_similarity(pairs, sets, "containment"), "containment").collect()}
    assert got == {(1, 2): 1.0, (2, 1): 0.5}


def test_seeded_init_is_deterministic(spark):
    df = spark.createDataFrame([(i, [float(i), float(i % 3)]) for i in range(40)], "id long, vec array<double>")
    a = init_centres(df, 4, seed=7)
    b = init_centres(df.repartition(5), 4, seed=7)
    assert a == b and len(a) == 4
    centres, rounds = kmeans_fit(df, 4, converge_dist=0.0, seed=7, max_iter=10)
    assert len(centres) == 4 and rounds >= 1


def test_score_and_group_writers(spark):
    d = tempfile.mkdtemp(prefix="quarry-w-")
    df = spark.createDataFrame([("a", 0.5)], "node string, rank double")
    write_scores(df, os.path.join(d, "s"))
    write_scores(df, os.path.join(d, "j"), fmt="json")
    assert spark.read.parquet(os.path.join(d, "s")).first().rank == 0.5
    assert spark.read.json(os.path.join(d, "j")).first().node == "a"
    g = spark.createDataFrame([(2, 1, 5, 1), (2, 1, 5, 2)], "group_size long, group_min long, group_hash long, member long")
    write_groups(g, os.path.join(d, "g"))
    assert spark.read.parquet(os.path.join(d, "g")).count() == 2


def test_streaming_tokens_helper(spark):
    from quarry.streaming import with_tokens
    df = spark.createDataFrame([("Hello, World",)], "text string")
    assert with_tokens(df).first().tokens == ["hello", "world"]
    assert with_tokens(df).select(F.size("tokens")).first()[0] == 2


def test_custom_columns_and_helpers(spark):
    from quarry.functions.hashing import RECOMMENDER_FAMILY
    from quarry.operators.minhash import minhash, set_sizes
    from quarry.operators.recommend import similar_topk
    from quarry.operators.text import encode_tokens, vocabulary

    s = spark.createDataFrame([(7, 3), (7, 5), (7, 5), (8, 1)], "cust long, part long")
    sig = {r.id: r.sig for r in minhash(s, 3, RECOMMENDER_FAMILY, id_col="cust", item_col="part").collect()}
    assert sig[8] == [(3 * 1 + 11 * i) % 100 for i in (1, 2, 3)]
    assert {r.id: r.size for r in set_sizes(s, "cust", "part").collect()} == {7: 2, 8: 1}
    sims = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5)], "u long, n long, s double")
    top = similar_topk(sims, 1, user_col="u", nbr_col="n", sim_col="s").collect()
    assert [(r.user, r.neighbour, r.rank) for r in top] == [(1, 2, 1)]
    toks = spark.createDataFrame([(1, 0, "b"), (1, 1, "a"), (2, 0, "b")], "id long, pos int, token string")
    enc = sorted(tuple(r) for r in encode_tokens(toks, vocabulary(toks)).collect())
    assert enc == [(1, 0, 2), (1, 1, 1), (2, 0, 2)]


def test_match_records_without_names_and_explicit_init(spark):
    from quarry.operators.match import match_records
    docs = spark.createDataFrame([(1, "the quick brown fox"), (2, "The quick brown fox!"), (3, "other words here")],
                                 "doc_id long, text string")
    got = {(r.id_a, r.id_b): r.similarity for r in match_records(docs, "doc_id", ["text"]).collect()}
    assert got == {(1, 2): 1.0}
    pts = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [10.0]), (3, [11.0])], "id long, vec array<double>")
    centres, _ = kmeans_fit(pts, 2, converge_dist=0.0, init=[[0.0], [11.0]])
    assert sorted(c[0] for c in centres) == [0.5, 10.5]


def test_documented_edge_behaviours(spark):
    from quarry.operators.graph import pagerank
    df = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    with pytest.raises(ValueError):
        hits(df, 0)
    got = {r.node: r.rank for r in pagerank(df, 1, damping=0.5).collect()}
    assert got == {"a": 1.0, "b": 1.0}  # 0.5 + 0.5 * 1.0, teleport exact
    got = {r.node: r.rank for r in pagerank(spark.createDataFrame([("a", "b")], "src string, dst string"),
                                            1, damping=0.3).collect()}
    assert got == {"b": 0.7 + 0.3 * 1.0}
    pts = spark.createDataFrame([(0, [0.0]), (1, [2.0])], "id long, vec array<double>")
    centres, rounds = kmeans_fit(pts, 1, converge_dist=5.0)
    assert rounds == 1 and centres == [[1.0]]


def test_staged_tables_take_a_codec(spark):
    from quarry.plans.lineage import scope, staged

    with scope(spark):
        out = staged(spark.range(10), "codec", compression="zstd")
        assert out.count() == 10 and all(f.endswith(".zstd.parquet") for f in out.inputFiles())
        assert not any(f.endswith(".zstd.parquet") for f in staged(spark.range(10), "codec").inputFiles())
