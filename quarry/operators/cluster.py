"""Lloyd's k-means over an array column, with the centres held as literals.

k centres of dimension d are a bounded table (k x d numbers), so each round
ships them inside the expression: assignment is a row-local argmin with no
join at all.  In a round every task sums its points by nearest centre, as matrices of
a batch of points, into one row per cluster; a ``groupBy(cid)`` adds these up, and the k
result rows are the one collect per round.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.vectors import nearest


def init_centres(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
                 seed: int | None = None) -> list[list[float]]:
    """``k`` initial centres: the lowest ids, or with a ``seed`` the lowest ``md5("id:seed")``, a seeded sample.

    Either way the choice does not depend on partitioning; ``orderBy + limit``
    plans a bounded ``TakeOrderedAndProject``.
    """
    order = F.col(id_col) if seed is None else F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed)))
    rows = df.orderBy(order, F.col(id_col)).limit(k).select(F.col(vec_col).cast("array<double>")).collect()
    return [list(r[0]) for r in rows]


def kmeans_assign(df: DataFrame, centres: Sequence[Sequence[float]], id_col: str = "id",
                  vec_col: str = "vec") -> DataFrame:
    """``(id, cid, sq_dist)``: nearest centre by squared Euclidean distance, ties to the lowest index."""
    best = nearest(F.col(vec_col), centres)
    return df.select(F.col(id_col).alias("id"), best.alias("_b")).select(
        "id", F.col("_b.cid").alias("cid"), F.col("_b.sq_dist").alias("sq_dist"))


def kmeans_fit(df: DataFrame, k: int, converge_dist: float = 1e-4, init: Sequence[Sequence[float]] | None = None,
               max_iter: int | None = None, id_col: str = "id", vec_col: str = "vec",
               seed: int | None = None) -> tuple[list[list[float]], int]:
    """Lloyd iterations until the summed squared centre shift is ``<= converge_dist``.

    At least one round always runs; an empty cluster keeps its centre.  Rounds
    are unlimited unless ``max_iter`` bounds them.
    Returns ``(centres, rounds)``; see :func:`centres_frame` for a DataFrame.
    """
    data = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(F.col("vec").isNotNull())
    centres = [list(map(float, c)) for c in (init or init_centres(data, k, "id", "vec", seed))]
    if not centres:
        return centres, 0
    # the points are read once per round: keep them in memory (spilling to disk) as bytes, dealt over all cores; a lost
    # block is re-read from the source, the lineage being one scan, a cast and a shuffle
    points, cores = data.select("vec"), df.sparkSession.sparkContext.defaultParallelism
    points = points if points.rdd.getNumPartitions() >= cores else points.repartition(cores)
    points = points.mapInArrow(_packed, "point binary").persist()
    try:
        return _lloyd(points, centres, converge_dist, max_iter)
    finally:
        points.unpersist()


def _packed(batches):
    for b in batches:
        vecs = b.column(0)
        ends = 8 * np.concatenate([[0], np.cumsum(pc.list_value_length(vecs).to_numpy(zero_copy_only=False))])
        flat = np.ascontiguousarray(vecs.flatten().to_numpy(zero_copy_only=False), np.float64)
        yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(vecs), [None, pa.py_buffer(ends.astype(np.int32)),
                                                                                       pa.py_buffer(flat)])], names=["point"])


def _sums(centres: np.ndarray):
    """The task of one round: ``(cid, n, total)``, count and sum of the points nearest to each centre."""
    k, d = centres.shape

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, d))
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                some = b.column(0).slice(i, 4096).to_pylist()
                if any(len(p) != 8 * d for p in some):
                    raise ValueError(f"a point has another number of dimensions than the centres' {d}")
                x = np.frombuffer(b"".join(some), np.float64).reshape(len(some), d)
                dist = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
                best = np.where(np.isnan(dist), np.inf, dist).argmin(axis=1)  # ties: the lowest index
                n += np.bincount(best, minlength=k)
                for c in np.unique(best):
                    total[c] += x[best == c].sum(axis=0)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(total[held].tolist(), pa.list_(pa.float64()))],
                                         names=["cid", "n", "total"])
    return run


def _lloyd(points: DataFrame, centres: list[list[float]], converge_dist: float, max_iter: int | None):
    rounds = 0
    while True:
        stats = (points.mapInArrow(_sums(np.array(centres)), "cid int, n long, total array<double>").groupBy("cid")
                 .agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("total")).alias("total")).collect())
        shift = 0.0
        new = [list(c) for c in centres]
        for row in stats:
            point = [float(x) / row["n"] for x in row["total"]]
            shift += sum((a - b) ** 2 for a, b in zip(centres[row["cid"]], point))
            new[row["cid"]] = point
        centres = new
        rounds += 1
        if shift <= converge_dist or (max_iter is not None and rounds >= max_iter):
            break
    return centres, rounds


def kmeans_fit_ml(df: DataFrame, k: int, max_iter: int = 20, tol: float = 1e-4, seed: int = 1,
                  vec_col: str = "vec") -> list[list[float]]:
    """MLlib's KMeans (k-means|| initialisation) on the same array column; returns the centres."""
    from pyspark.ml.clustering import KMeans

    data = df.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed).fit(data)
    return [list(map(float, c)) for c in model.clusterCenters()]


def centres_frame(spark, centres: Sequence[Sequence[float]]) -> DataFrame:
    schema = T.StructType([T.StructField("cid", T.IntegerType()),
                           T.StructField("centre", T.ArrayType(T.DoubleType()))])
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], schema)
