"""Results do not depend on how the input or the shuffles are partitioned."""

import pytest

import __spark_entry__ as entry
from conftest import SF001

QUERIES = ["fingerprint_clusters", "vocabulary", "lsh_candidates", "match_records", "pagerank", "hits",
           "edge_betweenness", "kmeans_assign", "als_rank1"]


def _rows(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_for_any_shuffle_partitioning(spark, name):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        results = []
        for n in ("3", "11"):
            spark.conf.set(key, n)
            results.append(_rows(entry.queries()[name](spark, SF001)))
    finally:
        spark.conf.set(key, old)
    assert results[0] == results[1]


@pytest.mark.parametrize("name", ["match_groups", "pagerank", "als_rank1", "lsh_candidates"])
def test_same_result_without_aqe(spark, name):
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    try:
        results = []
        for v in ("true", "false"):
            spark.conf.set(key, v)
            results.append(_rows(entry.queries()[name](spark, SF001)))
    finally:
        spark.conf.set(key, old)
    assert results[0] == results[1]
