"""Token files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

Layout below ``path``; shard ``p`` holds a range of document ids, shards ascend:

* ``tokens/kind=ids/part-<p>-...``: the ids of the shard's documents one after
  another, little-endian, ``uint16`` if the vocabulary fits and else ``uint32``;
* ``tokens/kind=docs/part-<p>-...``: its documents in file order, one
  NUL-ended record ``shard, place, doc_id, n_tokens`` each;
* ``offsets/shard=<p>/part-...``: ``n + 1`` little-endian ``uint64``, where each
  document starts in the whole corpus and, last, where the shard ends.

Texts are range-partitioned by document id (ties by text hash, then by place
in the input, so that a repeated id is split), tokenised once in that order
and written by the same tasks; only lengths go on.  A shard's first offset is
the prefix sum of the shards before it (one row per shard), the others are
running sums inside the shard.  Reading maps the files into memory where the
folder is a mounted path and else opens them through ``pyarrow.fs``.

Defined results: a null text counts as empty and holds the end id alone; null
ids sort first; rows with equal ids stay apart, each with its own span; an
empty table writes no shard.  The end id must be below 256 (it closes each
blob, see :mod:`quarry.llm.binary_sink`).
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from quarry.llm.binary_sink import write_blobs
from quarry.llm.common import small_batches, strings
from quarry.llm.pretokens import WordEncoder, remembered

RECORD = "shard int, place long, doc_id {id_type}, n_tokens long"


class LibraryTokenizer:
    """A byte-level BPE file of the ``tokenizers`` library; distinct words are encoded once.

    ``added_tokens``: the strings of added tokens (an end of text, say) stand for these tokens, as in the library by
    itself, and texts that hold one are encoded by it whole.  Else they are ordinary text.
    """

    def __init__(self, path: str, pattern: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.library = Tokenizer.from_file(path) if self.added else None
        self.tokenizer.encode_special_tokens = True
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        encode = self.tokenizer.encode_batch_fast
        self.words = WordEncoder(pattern, lambda w: np.array(encode([w], add_special_tokens=False)[0].ids, self.kind).tobytes())

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return self.words.encode(text)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> None:
    """Tokenise ``docs`` and write the ids and the document records of every shard."""
    if not 0 <= end_id < 256:
        raise ValueError("end_id must be below 256")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("place", T.LongType()),
                           T.StructField("blob", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        tok = remembered(("tokenizers", tokenizer_path, pattern, added_tokens),
                         lambda: LibraryTokenizer(tokenizer_path, pattern, added_tokens))
        size = 4 if tok.wide else 2
        end = end_id.to_bytes(size, "little")
        shard, place = TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            blobs = [tok.encode(t) + end for t in strings(b.column("text"))]
            ids = ["" if i is None else str(i) for i in b.column("doc_id").to_pylist()]
            recs = [f"{shard},{place + k},{i},{len(x) // size}\0".encode() for k, (i, x) in enumerate(zip(ids, blobs))]
            n = len(blobs)
            places = list(range(place, place + n))
            place += n
            yield pa.RecordBatch.from_arrays([pa.array(["ids"] * n), pa.array(places, pa.int64()),
                                              pa.array(blobs, pa.binary())], names=schema.fieldNames())
            yield pa.RecordBatch.from_arrays([pa.array(["docs"] * n), pa.array(places, pa.int64()),
                                              pa.array(recs, pa.binary())], names=schema.fieldNames())

    out = sorted_rows.mapInArrow(run, schema).sortWithinPartitions("kind", "place")
    write_blobs(out, f"{path}/tokens", "blob", partition_by="kind")


def records(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    """``(shard, place, doc_id, n_tokens)`` of every written document."""
    lines = spark.read.schema("value string").option("lineSep", "\u0000").text(f"{path}/tokens/kind=docs")
    parts = F.split("value", ",")
    return lines.select(parts[0].cast("int").alias("shard"), parts[1].cast("long").alias("place"),
                        F.nullif(parts[2], F.lit("")).cast(id_type).alias("doc_id"),
                        parts[3].cast("long").alias("n_tokens"))


def write_offsets(spark: SparkSession, path: str, id_type: str) -> None:
    """Write the 64-bit offsets of every shard from the lengths in the document records."""
    recs = records(spark, path, id_type).select("shard", "place", "n_tokens")
    totals = recs.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("blob", T.BinaryType())])

    def offsets(key, lengths, base):
        n = lengths.sort_values("place")["n_tokens"].to_numpy()
        at = np.concatenate([[0], np.cumsum(n)]) + int(base["base"].iloc[0])
        import pandas as pd
        return pd.DataFrame({"shard": [key[0]], "blob": [at.astype("<u8").tobytes()]})

    blobs = recs.groupBy("shard").cogroup(bases.groupBy("shard")).applyInPandas(offsets, schema)
    write_blobs(blobs, f"{path}/offsets", "blob", partition_by="shard")


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped if its path is mounted, else read through ``pyarrow.fs``."""
    if "://" in uri and not uri.startswith("file:"):
        from pyarrow import fs
        store, name = fs.FileSystem.from_uri(uri)
        with store.open_input_file(name) as f:
            return np.frombuffer(f.read_buffer(), dtype)
    name = uri.removeprefix("file:")
    name = "/" + name.lstrip("/") if uri.startswith("file:") else name
    return np.memmap(name, dtype, "r") if os.path.getsize(name) else np.empty(0, dtype)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, ids_file, offsets_file)``: one row per shard."""
    def files(folder: str, name: str) -> DataFrame:
        return spark.read.format("binaryFile").load(folder).select("path").withColumnRenamed("path", name)
    ids = files(f"{path}/tokens/kind=ids", "ids_file").withColumn(
        "shard", F.regexp_extract("ids_file", r"part-(\d+)", 1).cast("int"))
    offs = files(f"{path}/offsets/*", "offsets_file").withColumn(
        "shard", F.regexp_extract("offsets_file", r"shard=(\d+)", 1).cast("int"))
    return ids.join(offs, "shard")


def read_spans(spark: SparkSession, path: str, id_type: str, wide: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` read from the id and offset files.

    A shard's document records meet its file names by shard; ids are read
    through the mapped files, so no token moves between tasks.
    """
    schema = T.StructType([T.StructField("doc_id", T._parse_datatype_string(id_type)),
                           *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]])
    kind = "<u4" if wide else "<u2"
    rows = (records(spark, path, id_type).select("shard", "place", "doc_id")
            .join(F.broadcast(listed(spark, path)), "shard"))  # one row per shard

    def run(batches):
        held: dict = {}
        for b in batches:
            starts, counts, sums = [], [], []
            for place, ids_file, offs_file in zip(*[b.column(c).to_pylist() for c in ("place", "ids_file", "offsets_file")]):
                if ids_file not in held:
                    held.clear()
                    held[ids_file] = (mapped(ids_file, kind), mapped(offs_file, "<u8"))
                ids, at = held[ids_file]
                a, z = int(at[place]), int(at[place + 1])
                base = int(at[0])
                starts.append(a)
                counts.append(z - a)
                sums.append(zlib.crc32(ids[a - base:z - base].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(x, pa.int64()) for x in (starts, counts, sums)]],
                                             names=schema.fieldNames())
    return rows.mapInArrow(run, schema)


def write_corpus(docs: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """Write all files of the corpus, then read them back (see :func:`read_spans`); ``added_tokens`` as of :class:`LibraryTokenizer`."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    write_tokens(docs, path, tokenizer_path, pattern, end_id, id_col, text_col, added_tokens)
    if not spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
            "recursiveFileLookup", "true").load(f"{path}/tokens").select("path").take(1):
        return spark.createDataFrame([], f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
    write_offsets(spark, path, id_type)
    wide = LibraryTokenizer(tokenizer_path, pattern).wide
    return read_spans(spark, path, id_type, wide)
