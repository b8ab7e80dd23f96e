"""Raw binary files through Spark's own text sink and its commit protocol.

The text sink writes each row's bytes and then a separator.  With the
separator NUL and every row's own last byte, which must be NUL, cut off, the
file holds exactly the concatenated blobs.  Little-endian integers below their
type's top byte end in NUL, and so do gzip members of less than 16 MiB; other
members get an empty member after them.  Works on every file system that Spark
writes to, and a task that is run again leaves no trace.
"""

from __future__ import annotations

import gzip
import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An empty gzip member; it ends in NUL bytes.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def gzip_member(data: bytes, level: int = 6) -> bytes:
    out = gzip.compress(data, level, mtime=0)
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def write_blobs(df: DataFrame, path: str, blob: str, partition_by: str | None = None,
                records_per_file: int = 0) -> None:
    """Write the binary column ``blob`` of ``df``; every blob must end in a NUL byte."""
    value = F.expr(f"cast(substring({blob}, 1, greatest(octet_length({blob}) - 1, 0)) as string)")
    checked = F.when(F.expr(f"substring({blob}, octet_length({blob}), 1) = X'00'"), value).otherwise(
        F.raise_error(F.lit("a blob must end in a NUL byte")))
    cols = [checked.alias("value")] + ([F.col(partition_by)] if partition_by else [])
    writer = df.select(*cols).write.option("lineSep", "\u0000").option("maxRecordsPerFile", records_per_file)
    (writer.partitionBy(partition_by) if partition_by else writer).text(path)


def plain_path(uri: str) -> str | None:
    """The path of a file in a mounted folder; None for other stores."""
    if "://" in uri and not uri.startswith("file:"):
        return None
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def mapped_bytes(uri: str) -> np.ndarray:
    """A file's bytes: memory-mapped if its folder is mounted, else read through ``pyarrow.fs``."""
    name = plain_path(uri)
    if name is not None:
        return np.memmap(name, np.uint8, "r")
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(uri)
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read_buffer(), np.uint8)


def open_members(uri: str) -> io.BufferedReader:
    """The uncompressed bytes of a file of gzip members, as a stream; other stores are read through ``pyarrow.fs``."""
    name = plain_path(uri)
    if name is None:
        from pyarrow import fs
        store, name = fs.FileSystem.from_uri(uri)
        raw = store.open_input_stream(name)
    else:
        raw = open(name, "rb")
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)
