"""The original jobs' stateless operators applied to Structured Streaming DataFrames.

The fingerprint key, tokenising and nearest-centre assignment are plain
column expressions, so they run unchanged on a streaming DataFrame.  The one
stateful piece is the count of raw values per fingerprint, which is a
streaming aggregation whose state holds one row per distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import fingerprint_key, normal_tokens
from quarry.operators.cluster import kmeans_assign


def with_fingerprint(stream: DataFrame, col: str = "value") -> DataFrame:
    """Append the key-collision ``fingerprint`` of ``col`` (stateless)."""
    return stream.withColumn("fingerprint", fingerprint_key(F.col(col)))


def with_tokens(stream: DataFrame, col: str = "text") -> DataFrame:
    """Append the normalised ``tokens`` of ``col`` (stateless)."""
    return stream.withColumn("tokens", normal_tokens(F.col(col)))


def fingerprint_counts(stream: DataFrame, col: str = "value") -> DataFrame:
    """Running ``(fingerprint, value, count)``: for ``complete`` or ``update`` output mode.

    Clusters are the fingerprints with two or more values; read them from the
    sink with :func:`quarry.operators.text.fingerprint_clusters`-style grouping.
    """
    keyed = with_fingerprint(stream.select(F.col(col).alias("value")).where(F.col("value").isNotNull()))
    return keyed.groupBy("fingerprint", "value").agg(F.count(F.lit(1)).alias("count"))


def assign_stream(stream: DataFrame, centres: Sequence[Sequence[float]], id_col: str = "id",
                  vec_col: str = "vec") -> DataFrame:
    """Nearest-centre assignment of a stream of vectors against fixed centres (stateless)."""
    return kmeans_assign(stream, centres, id_col, vec_col)
