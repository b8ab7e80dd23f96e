"""Operator inputs derived from the test tables by plain DataFrame joins.

Every derivation is linear in the table sizes (no pair enumeration inside
an order or any other group) so that it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_lines(spark, sf_dir) -> DataFrame:
    """``(value)``: every line of every document (split on LF)."""
    docs = table(spark, sf_dir, "documents").select("text")
    return docs.select(F.explode(F.split(F.col("text"), "\n")).alias("value"))


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _customer_lines(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_partkey", "l_quantity")


def customer_parts(spark, sf_dir) -> DataFrame:
    """``(id, item)``: the distinct parts each customer ordered."""
    return _customer_lines(spark, sf_dir).select(F.col("o_custkey").alias("id"),
                                                 F.col("l_partkey").alias("item")).distinct()


def customer_part_lines(spark, sf_dir) -> DataFrame:
    """``(user, item, rating)``: the quantity of every order line, so that cells repeat."""
    return _customer_lines(spark, sf_dir).select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
                                                 F.col("l_quantity").alias("rating"))


def customer_part_ratings(spark, sf_dir) -> DataFrame:
    """``(user, item, rating)``: the largest quantity a customer ordered of a part."""
    return (_customer_lines(spark, sf_dir).groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.max("l_quantity").alias("rating")))


def customer_brand_ratings(spark, sf_dir) -> DataFrame:
    """``(user, item, rating)``: total quantity per (customer, brand)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cl = _customer_lines(spark, sf_dir)
    return (cl.join(p, cl.l_partkey == p.p_partkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("p_brand").alias("item"))
            .agg(F.sum("l_quantity").alias("rating")))


def part_edges(spark, sf_dir) -> DataFrame:
    """``(src, dst)`` co-purchase edges, one per order line: the part on the
    order's first line (lowest line number, then part key) points to the part
    on every other line of the order; self-loops dropped, repeats kept.

    The first line is a partially aggregated ``min`` per order, joined back, so
    an order of any size yields one edge per line.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    head = li.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey")).alias("h"))
    e = li.join(head, "l_orderkey").select(F.col("h.l_partkey").alias("src"), F.col("l_partkey").alias("dst"))
    return e.where(F.col("src") != F.col("dst"))


def part_sources(spark, sf_dir) -> DataFrame:
    """``(node)``: the part with the lowest key of each brand."""
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("node")).select("node")


def nation_edges(spark, sf_dir) -> DataFrame:
    """``(src, dst)``: every supplier-nation / customer-nation trade lane (unordered, different nations)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(c, o.o_custkey == c.c_custkey).where(F.col("s_nationkey") != F.col("c_nationkey")))
    return j.select(F.least("s_nationkey", "c_nationkey").alias("src"),
                    F.greatest("s_nationkey", "c_nationkey").alias("dst")).distinct()


def embedding_vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"),
                                                      F.col("embedding").cast("array<double>").alias("vec"))


def order_type_rows(spark, sf_dir) -> DataFrame:
    """``(order, item)``: part types on each order's lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("order"), F.col("p_type").alias("item"))


def order_brand_rows(spark, sf_dir) -> DataFrame:
    """``(order, item)``: part brands on each order's lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("order"), F.col("p_brand").alias("item"))
