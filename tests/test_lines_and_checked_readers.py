"""The line sink, readers with rejects, and the last of repeated ratings by input order."""

import csv
import glob
import os
import random
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.operators.recommend import dedup_ratings
from quarry.operators.text import fingerprint_clusters, ranked
from quarry.plans.lineage import scope, staged, work_dir
from quarry.plans.order import numbered
from quarry.sources import readers
from quarry.sources.lines import write_group_lines
from quarry.sources.writers import write_clusters, write_group_rows, write_score_lines


def scratch():
    return tempfile.mkdtemp(prefix="quarry-lines-")


def text_of(path):
    return "".join(open(f, encoding="utf-8", newline="").read() for f in sorted(glob.glob(path + "/part-*")))


def test_a_line_of_a_third_of_all_rows_is_streamed(spark):
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 97)).alias("g"), "id")
    path = scratch() + "/out"
    write_group_lines(df.repartition(5), path, F.col("g"), [F.col("id")], F.col("id"), F.concat(F.col("g"), F.lit(":")))
    want = {}
    for i in range(n):
        want.setdefault("hot" if i % 3 == 0 else f"g{i % 97}", []).append(str(i))
    got = dict(line.split(":") for line in text_of(path).splitlines())
    assert got == {k: ",".join(v) for k, v in want.items()}
    assert [line.split(":")[0] for line in text_of(path).splitlines()] == sorted(want)
    assert spark.read.text(path).count() == len(want) and os.path.exists(path + "/_SUCCESS")
    assert not glob.glob(path + "/_temporary*")


def test_overwriting_and_adding_lines(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 5)], "g string, v long")
    path = scratch() + "/out"
    for _ in range(2):
        write_group_lines(df, path, F.col("g"), [F.col("v")], F.col("v"), sep=";")
        assert sorted(text_of(path).splitlines()) == ["1", "1;2", "5"]
    write_group_lines(df, path, F.col("g"), [F.col("v")], F.col("v"), sep=";", mode="append")
    assert sorted(text_of(path).splitlines()) == ["1", "1", "1;2", "1;2", "5", "5"]
    write_group_lines(df.limit(0), path, F.col("g"), [F.col("v")], F.col("v"))
    assert text_of(path) == ""


def test_a_failed_job_leaves_what_was_there(spark):
    df = spark.createDataFrame([("a", "1")], "g string, v string")
    path = scratch() + "/out"
    write_group_lines(df, path, F.col("g"), [F.col("v")], F.col("v"))
    bad = df.select("g", F.raise_error(F.lit("no")).cast("string").alias("v"))
    with pytest.raises(PySparkException):
        write_group_lines(bad, path, F.col("g"), [F.lit(1)], F.col("v"))
    assert text_of(path) == "1\n" and not glob.glob(path + "/_temporary*")


def test_group_rows_are_csv(spark):
    names = ['plain', 'with, comma', 'with "quotes"', "line\nend", ""]
    df = spark.createDataFrame([(f"g{i % 2}", v) for i, v in enumerate(names)], "group_name string, member string")
    path = scratch() + "/out"
    write_group_rows(df, path)
    rows = [r for f in sorted(glob.glob(path + "/part-*")) for r in csv.reader(open(f, newline=""))]
    assert rows == [sorted(names[0::2]), sorted(names[1::2])]


def test_score_lines_and_cluster_lines(spark):
    scores = spark.createDataFrame([(10, 1.0, 0.0), (9, 0.5, 1.0), (100, 0.0, 0.25)], "node long, hub double, authority double")
    path = scratch() + "/scores"
    write_score_lines(scores, path)
    assert text_of(path) == "1.0 0.0 0.5\n0.0 0.25 1.0\n"  # nodes as strings: 10, 100, 9
    values = ["Foo"] * 3 + ["foo!"] * 2 + ["FOO"] * 2 + ["bar", "BAR"]
    clusters = fingerprint_clusters(spark.createDataFrame([(v,) for v in values], "value string"))
    write_clusters(clusters, path + "-c")
    assert text_of(path + "-c") == "bar:BAR(1),bar(1)\nfoo:Foo(3),FOO(2),foo!(2)\n"


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_ranks_and_ordinals(spark, tasks):
    rng = random.Random(2)
    rows = [(rng.choice("xyyy"), rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, c long, v long").repartition(4)
    got = numbered(df, F.col("k"), F.col("c").desc(), F.col("v"), tasks=tasks).collect()
    want = sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    assert [(r.k, r.c, r.v) for r in sorted(got, key=lambda r: r.ordinal)] == want
    assert sorted(r.ordinal for r in got) == list(range(500))
    assert numbered(df.limit(0), "k", tasks=tasks).count() == 0


def test_ranks_inside_a_hot_cluster(spark):
    values = [w for i in range(200) for w in [f"Hot{'!' * i}"] * (1 + i % 5)] + ["a b", "b a", "B a"]
    out = ranked(fingerprint_clusters(spark.createDataFrame([(v,) for v in values], "value string"))).collect()
    for key in ("hot", "a b"):
        own = sorted((r for r in out if r.fingerprint == key), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [(r["count"], r.value) for r in own] == sorted(((r["count"], r.value) for r in own), key=lambda x: (-x[0], x[1]))
    assert len(out) == 203


def test_last_rating_of_the_input_wins_over_several_splits(spark):
    d = scratch()
    rng = random.Random(1)
    last = {}
    for f in range(3):
        with open(f"{d}/f{f}.csv", "w") as out:
            out.write("userId,movieId,rating\n")
            for _ in range(4000):
                u, i, r = rng.randint(0, 9), rng.randint(0, 9), rng.randint(0, 1000)
                out.write(f"{u},{i},{r}\n")
                last[(u, i)] = float(r)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_ratings(spark, d, with_order=True)
        assert df.rdd.getNumPartitions() > 6
        got = {(r.user, r["item"]): r.rating for r in dedup_ratings(df, order_col="input_order").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == last


def test_rejects_stand_beside_the_rows(spark):
    d = scratch()

    def put(name, lines):
        with open(f"{d}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
        return f"{d}/{name}"
    values = lambda df: sorted(r.value for r in df.collect())
    p = put("r.csv", ["userId,movieId,rating,ts", "1,10,4.0,5", "x,1,2,3", "2,20", "userId,movieId,rating,ts", "3,30,bad,1", "4,,1.5,2", "5,50,1,2,9"])
    got = readers.read_ratings_checked(spark, p)
    assert [tuple(r) for r in got.rows.collect()] == [(1, 10, 4.0)] and got.counts() == (1, 5)
    assert values(got.rejects) == sorted(["x,1,2,3", "2,20", "3,30,bad,1", "4,,1.5,2", "5,50,1,2,9"])
    with pytest.raises(ValueError):
        readers.read_ratings_checked(spark, p, user="nobody")
    e = readers.read_edges_checked(spark, put("e.txt", ["a b", "alone", "c  d more", ""]))
    assert sorted(map(tuple, e.rows.collect())) == [("a", "b"), ("c", "d")] and values(e.rejects) == ["", "alone"]
    v = readers.read_vectors_checked(spark, put("v.txt", ["1 2", "1 x", "3", "4.5 -1"]), dims=2)
    assert sorted(r.vec for r in v.rows.collect()) == [[1.0, 2.0], [4.5, -1.0]] and values(v.rejects) == ["1 x", "3"]
    b = readers.read_basket_rows_checked(spark, put("b.csv", ["k,i", "a,1", "b,x", ",2"]), "k", "i")
    assert [tuple(r) for r in b.rows.collect()] == [("a", 1)] and values(b.rejects) == [",2", "b,x"]
    c = readers.read_records_checked(spark, put("c.csv", ["n,e", "a,1", "a,1", "b,"]), "n", "e")
    assert [(r.name, r.extra) for r in c.rows.collect()] == [("a", "1")] and values(c.rejects) == ["b,"]


def test_scopes_delete_what_was_staged(spark):
    top = os.path.dirname(work_dir(spark, "probe").removeprefix("file:"))
    before = set(os.listdir(top))
    with scope(spark):
        kept = []
        with scope(spark) as inner:
            a = staged(spark.range(5).toDF("x"), "a")
            b = inner.hand_over(staged(a.where("x > 2"), "b"))
            kept.append(b)
        assert len(set(os.listdir(top)) - before) == 1 and kept[0].count() == 2
    assert set(os.listdir(top)) - before == set()


@pytest.mark.parametrize("name", ["frequent_itemsets", "rule_matches", "fingerprint_ranks", "io_baskets", "io_last_ratings"])
def test_queries_leave_the_work_folder_as_it_was(spark, name):
    from quarry.plans.catalog import QUERIES
    top = os.path.dirname(work_dir(spark, "probe").removeprefix("file:"))
    before = {x for x in os.listdir(top) if not x.startswith("rdd-")}
    with scope(spark):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert {x for x in os.listdir(top) if not x.startswith("rdd-")} == before
