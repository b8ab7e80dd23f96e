import os
import tempfile

from quarry.operators.text import fingerprint_clusters
from quarry.sources.readers import read_basket_rows, read_edges, read_lines, read_ratings, read_records, read_vectors
from quarry.sources.writers import write_clusters, write_hits, write_itemsets, write_ratings, write_rules


def scratch():
    return tempfile.mkdtemp(prefix="quarry-io-")


def write_text(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_read_edges_separators(spark):
    d = scratch()
    p = os.path.join(d, "e.txt")
    write_text(p, ["a   b", "b c extra", "c\ta"])
    got = sorted(tuple(r) for r in read_edges(spark, p).collect())
    assert got == [("a", "b"), ("b", "c"), ("c", "a")]
    write_text(p, ["a   b", "b c extra"])
    single = sorted(tuple(r) for r in read_edges(spark, p, sep=" ").collect())
    assert single == [("a", ""), ("b", "c")]  # single-space split keeps the empty field
    nodes = {r.node for r in read_edges(spark, p, sep=" ", nodes=True).collect()}
    assert "extra" in nodes
    comma = os.path.join(d, "c.txt")
    write_text(comma, ["A,B", "B,C"])
    assert sorted(tuple(r) for r in read_edges(spark, comma, sep=",").collect()) == [("A", "B"), ("B", "C")]


def test_ratings_roundtrip(spark):
    d = scratch()
    p = os.path.join(d, "r.csv")
    write_text(p, ["userId,movieId,rating,timestamp", "1,10,4.0,5", "2,20,3.5,6"])
    r = read_ratings(spark, p)
    assert sorted(tuple(x) for x in r.collect()) == [(1, 10, 4.0), (2, 20, 3.5)]
    out = os.path.join(d, "out")
    write_ratings(r, out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["user", "movie", "rating"] and back.count() == 2


def test_vectors_records_baskets(spark):
    d = scratch()
    v = os.path.join(d, "v.txt")
    write_text(v, ["1.0 2.0", "3.5 -1"])
    assert sorted(r.vec for r in read_vectors(spark, v).collect()) == [[1.0, 2.0], [3.5, -1.0]]
    rec = os.path.join(d, "rec.csv")
    write_text(rec, ["facility_name,facility_address,x", "CAFE,1 ST,9", "CAFE,1 ST,8", "BAR,,7"])
    recs = read_records(spark, rec, "facility_name", "facility_address").collect()
    assert [(r.name, r.extra) for r in recs] == [("CAFE", "1 ST")]
    b = os.path.join(d, "b.csv")
    write_text(b, ["basket,item", "x,1", "x,2", "y,2"])
    assert read_basket_rows(spark, b).count() == 3
    assert read_lines(spark, b).count() == 4


def test_cluster_and_rule_writers(spark):
    d = scratch()
    df = spark.createDataFrame([("Foo",), ("Foo",), ("foo!",)], "value string")
    write_clusters(fingerprint_clusters(df), os.path.join(d, "cl"))
    lines = [r.value for r in spark.read.text(os.path.join(d, "cl")).collect()]
    assert lines == ["foo:Foo(2),foo!(1)"]
    rules = spark.createDataFrame([([1, 2], 3, 0.5)], "antecedent array<long>, consequent long, confidence double")
    write_rules(rules, os.path.join(d, "rules"))
    assert spark.read.text(os.path.join(d, "rules")).first().value == "1,2 -> 3 0.5"


def test_ratings_strict_and_lenient_casts(spark):
    import pytest
    from pyspark.errors import PySparkException

    d = scratch()
    p = os.path.join(d, "bad.csv")
    write_text(p, ["userId,movieId,rating", "1,10,4.0", "x,20,3.0"])
    got = sorted((tuple(r) for r in read_ratings(spark, p, lenient=True).collect()), key=str)
    assert got == [(1, 10, 4.0), (None, 20, 3.0)]
    v = os.path.join(d, "v.txt")
    write_text(v, ["1.0 oops"])
    assert read_vectors(spark, v, lenient=True).first().vec == [1.0, None]
    with pytest.raises(PySparkException):
        read_ratings(spark, p).collect()  # ANSI cast: a malformed id fails the job, as the original parse did


def test_repeated_header_and_short_edge_lines(spark):
    import pytest
    from pyspark.errors import PySparkException

    d = scratch()
    p = os.path.join(d, "r.csv")
    write_text(p, ["userId,movieId,rating", "1,10,4.0", "userId,movieId,rating", "2,20,3.0"])
    assert sorted(tuple(r) for r in read_ratings(spark, p).collect()) == [(1, 10, 4.0), (2, 20, 3.0)]
    e = os.path.join(d, "e.txt")
    write_text(e, ["a\u2003b", "c d"])
    assert sorted(tuple(r) for r in read_edges(spark, e).collect()) == [("a", "b"), ("c", "d")]
    write_text(e, ["a b", "alone"])
    with pytest.raises(PySparkException, match="fewer than two fields"):
        read_edges(spark, e).collect()


def test_hits_and_itemset_writers(spark):
    d = scratch()
    write_hits(spark.createDataFrame([("b", 1.0, 0.0), ("a", 0.5, 1.0)], "node string, hub double, authority double"),
               os.path.join(d, "hits"))
    assert [r.value for r in spark.read.text(os.path.join(d, "hits")).collect()] == ["a\t0.5\t1.0", "b\t1.0\t0.0"]
    write_itemsets(spark.createDataFrame([([1, 2], 2, 5), ([3], 1, 9)], "items array<long>, size int, support long"),
                   os.path.join(d, "sets"))
    assert [r.value for r in spark.read.text(os.path.join(d, "sets")).collect()] == ["3: 9", "1,2: 5"]


def test_io_ratings_shuffles_lines_once_and_writes_them_in_order(spark, tmp_path, monkeypatch):
    from quarry.plans import catalog
    orders = spark.createDataFrame([(k, None if k % 7 == 0 else k % 5) for k in range(1, 60)], "o_orderkey long, o_custkey long")
    lines = spark.createDataFrame([(k, None if n == 3 else k * n % 11, float(k + n), n) for k in range(1, 70) for n in range(1, 5)],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_linenumber long")
    for name, rows in (("orders", orders), ("lineitem", lines.union(lines))):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    plans, write = [], catalog.writers.write_ratings

    def seen(df, path, **options):
        plans.append(df.orderBy("user", "item")._jdf.queryExecution().executedPlan().toString())
        write(df, path, **options)
    monkeypatch.setattr(catalog.writers, "write_ratings", seen)
    out = catalog.q_io_ratings(spark, str(tmp_path))
    got = {(r.user, r.item): r.rating for r in out.collect()}
    assert len(got) == out.count() > 0
    same = catalog.inputs.customer_part_ratings(spark, str(tmp_path)).collect()
    assert got == {(r.user, r.item): r.rating for r in same}
    assert plans[0].count("rangepartitioning") == 1 and "hashpartitioning(user" not in plans[0] and "hashpartitioning(o_custkey" not in plans[0]
    key = [tuple((x is not None, x) for x in (r.user, r.item)) for f in sorted({x.f for x in out.selectExpr("input_file_name() f").collect()})
           for r in catalog.readers.read_ratings(spark, f, "user", "movie", "rating").collect()]
    assert key == sorted(key)
