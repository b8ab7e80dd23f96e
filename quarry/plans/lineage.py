"""Lineage control and the lifetime of intermediate tables.

Loop state is cut with reliable ``checkpoint()`` into the shared folder named
by ``spark.checkpoint.dir``; a lost executor then recomputes from the last
checkpoint instead of from the start of the loop.  Spark deletes a checkpoint
once nothing refers to it (``spark.cleaner.referenceTracking.cleanCheckpoints``).

Larger tables are *staged*: written as Parquet below the same folder and read
back, which keeps column pruning, statistics and AQE's view of their size.  A staged
table belongs to the innermost open :class:`Scope` and is deleted when that ends::

    with scope(spark):
        result = operator(...)
        result.write.parquet(out)     # whatever is lazy has to run in here

Without an open scope staged tables stay until the folder is cleared.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir

_open_scopes: list["Scope"] = []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies; a folder that is not there is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds the complete output of a job."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class Scope:
    """Owner of staged folders."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    @contextmanager
    def owning(self) -> Iterator["Scope"]:
        """Folders staged inside belong to this scope, which stays open."""
        _open_scopes.append(self)
        try:
            yield self
        finally:
            _open_scopes.remove(self)

    def feeds(self, df: DataFrame) -> bool:
        """Whether ``df`` still reads a folder of this scope."""
        names = [p.rsplit("/", 1)[-1] for p in self.paths]
        return bool(names) and any(n in f for f in df.inputFiles() for n in names)

    def hand_over(self, df: DataFrame) -> DataFrame:
        """Leave the folder of a staged table to the scope around this one."""
        names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
        for path in [p for p in self.paths if p.rsplit("/", 1)[-1] in names]:
            self.paths.remove(path)
            outer = [own for own in _open_scopes if own is not self]
            if outer:
                outer[-1].paths.append(path)
        return df

    def release(self) -> None:
        while self.paths:
            delete_folder(self.spark, self.paths.pop())


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """A scope whose folders are deleted at its end."""
    own = Scope(spark)
    try:
        with own.owning():
            yield own
    finally:
        own.release()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (``spark.checkpoint.dir``), owned by the innermost scope."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].paths.append(path)
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are deleted when the query ends, and not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, but keeps column pruning and file
    statistics for later reads, and both sides of a later join are plain scans
    that AQE can split when a key is hot.  ``compression`` is a codec of Parquet, by default the session's.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete the folder of a staged table that nothing reads any more, before its scope ends."""
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    for own in _open_scopes:
        for path in [p for p in own.paths if p.rsplit("/", 1)[-1] in names]:
            own.paths.remove(path)
            delete_folder(own.spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class LoopState:
    """Keeps the live loop tables persisted and stages every ``every``-th (one job; a checkpoint computes its table twice)."""

    def __init__(self, every: int = 4):
        self.every = max(1, int(every))
        self._round = 0
        self._own: Scope | None = None
        self._held: list[DataFrame] = []

    def step(self, df: DataFrame) -> DataFrame:
        self._round += 1
        if self._round % self.every == 0:
            with self._scope(df).owning():
                out = staged(df, "loop")
        else:
            out = df.persist()
        self._held.append(out)
        # keep the newest two alive: the current state and the one it was built from
        while len(self._held) > 2:
            self._held.pop(0).unpersist()
        return out

    def _scope(self, df: DataFrame) -> "Scope":
        if self._own is None:
            self._own = Scope(df.sparkSession)
        return self._own

    def release(self) -> None:
        """Drop what is held; whatever reads it has to have run."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        if self._own is not None:
            self._own.release()

