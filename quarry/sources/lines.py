"""A text sink of one line per group, of any width.

``key: cell, cell, ...`` lines are usually made by collecting a group into one row.  Here the
cells stay rows: they are range-partitioned by the group's key and sorted inside it, and a task writes them
one after another, with a separator between cells and a line end where the key changes.  A task
holds one batch of rows and never a group, so a line may hold a third of all rows; a group is in one file,
so the files read back as lines.

The files are written by a Python data source with Spark's own commit protocol: tasks write below a
folder of the job, and only files of tasks that Spark has accepted are moved beside each other when the job ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "group_lines"


def _store(path: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    lines: int
    cells: int


class GroupLines(DataSource):
    """Writes ``(line, head, cell)``: rows of one ``line`` stand next to each other in their partition."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string, head string, cell string"

    def writer(self, schema, overwrite: bool) -> "GroupLineWriter":
        return GroupLineWriter(self.options["path"], self.options.get("sep", ","), self.options["job"], overwrite)


class GroupLineWriter(DataSourceArrowWriter):
    def __init__(self, path: str, sep: str, job: str, overwrite: bool):
        self.path, self.sep, self.overwrite = path, sep, overwrite
        self.attempts = f"{path.rstrip('/')}/_temporary-{job}"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.txt"
        out, last, lines, cells = None, None, 0, 0
        for batch in iterator:
            text = []
            for line, head, cell in zip(*[batch.column(c).to_pylist() for c in ("line", "head", "cell")]):
                if line != last or not cells:
                    text.append(("\n" if cells else "") + (head or ""))
                    last, lines = line, lines + 1
                else:
                    text.append(self.sep)
                text.append(cell or "")
                cells += 1
            if text:
                if out is None:
                    store, folder = _store(self.attempts)
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(f"{folder}/{name}")
                out.write("".join(text).encode())
        if out is not None:
            out.write(b"\n")
            out.close()
        return Written(name if cells else None, lines, cells)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(folder)):
                if info.is_file:
                    store.delete_file(info.path)
        attempts = _store(self.attempts)[1]
        for m in messages:
            if m is not None and m.name:
                store.move(f"{attempts}/{m.name}", f"{folder}/{m.name}")
        self._clean()
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages) -> None:
        self._clean()

    def _clean(self) -> None:
        from pyarrow import fs
        store, folder = _store(self.attempts)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def write_group_lines(df: DataFrame, path: str, line: Column, order: list[Column], cell: Column, head: Column | None = None,
                      sep: str = ",", mode: str = "overwrite") -> None:
    """One line per value of ``line``, in its order: ``head``, then the cells of its rows by ``order`` with ``sep`` between them.

    ``line`` is not written itself; null is a value of its own.  Line ends inside cells or heads are the caller's to
    encode (:func:`csv_cell` quotes them).
    """
    spark = df.sparkSession
    spark.dataSource.register(GroupLines)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(line.alias("line"), F.struct(*order).alias("place"), (F.lit("") if head is None else head).cast("string").alias("head"),
                     cell.cast("string").alias("cell"))
    dealt = rows.repartitionByRange(n, "line").sortWithinPartitions("line", "place")
    (dealt.select(F.col("line").cast("string").alias("line"), "head", "cell").write.format(FORMAT).mode("overwrite" if mode == "overwrite" else "append")
     .option("path", path).option("sep", sep).option("job", uuid.uuid4().hex).save())


def csv_cell(c: Column) -> Column:
    """A CSV field: in quotes, quotes doubled, where it holds a comma, a quote or a line end."""
    return F.when(c.rlike("[,\"\r\n]"), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
