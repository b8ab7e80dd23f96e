"""Byte-level BPE: encode whole texts by a rank file, decode ids to bytes.

A word (one match of the pattern) starts as single bytes; the neighbouring
pair whose concatenation has the lowest rank is merged, leftmost first, until
no neighbouring pair has a rank.  The ranks are a literal map of bounded size
(the vocabulary).  Texts share words, so each task folds a distinct word once
(:mod:`quarry.llm.pretokens`) and then only looks it up.  Decoding concatenates
the binary pieces of the ids.

Two forms of the fold are here: :func:`fold` runs inside the Arrow batches and
is the one on the query's path; :func:`fold_column` is the same fold as Spark
higher-order functions over a column of distinct words, :func:`encode_words`.
The README has the figures for both.

Defined results: a null text counts as empty and has no ids; equal texts have
equal ids; a word of n bytes takes about n log n steps, however long; an empty
table gives an empty result.  Work is row-local (no
shuffle), memory is bounded by one Arrow batch and the memo.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_columns, packed, strings
from quarry.llm.pretokens import WordEncoder, remembered


#: Distinct pieces that a worker remembers (it keeps them from task to task).
MEMO = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file (base64 of the piece, its rank) as a map."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Words of more bytes keep their pairs in a heap.
LONG_WORD = 100


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """:func:`fold` in n log n steps: pairs in a heap by rank and place, pieces as a linked list."""
    n = len(word)
    end = list(range(1, n + 1))            # where the piece that begins here ends; a piece is known by its first byte
    before = list(range(-1, n - 1))        # where the piece before it begins
    alive = [True] * n
    get = ranks.get

    def pair(i: int) -> tuple[int, int, int] | None:
        """``(rank, first byte, end)`` of the piece at ``i`` joined with the next."""
        j = end[i]
        if j >= n or (rank := get(word[i:end[j]])) is None:
            return None
        return rank, i, end[j]
    heap = [x for i in range(n) if (x := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop:  # one of the two has been merged meanwhile
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        for k in (before[i], i):
            if k >= 0 and (x := pair(k)) is not None:
                heapq.heappush(heap, x)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranked merges over the bytes of one word."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return fold_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    get = ranks.get
    none = len(ranks) + 1
    scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while scores:
        best = min(scores)
        if best == none:
            break
        i = scores.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i < len(scores):
            scores[i] = get(parts[i] + parts[i + 1], none)
        if i:
            scores[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


class Codec:
    """Encoder and decoder of one rank file and pattern; ids travel as little-endian uint32."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.decimals = [str(i) for i in range(len(self.pieces))]
        self.encode = WordEncoder(pattern, lambda w: self._pack(fold(w.encode("utf-8"), ranks)), MEMO).encode

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.decimals.__getitem__, ids))


def codec_maker(spark: SparkSession, ranks_path: str, pattern: str) -> Callable[[], Codec]:
    """What tasks call to get the codec; the rank map (bounded by the vocabulary) is broadcast."""
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    return lambda: remembered((ranks_path, pattern), lambda: Codec(ranks.value, pattern))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``(row, ids array<int>)`` for every row of ``docs``."""
    codec = codec_maker(docs.sparkSession, ranks_path, pattern)

    def make():
        encode = codec().encode

        def fn(col):
            got = [encode(t) for t in strings(col)]
            ends = np.cumsum([0, *[len(b) // 4 for b in got]], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(got), "<u4").astype(np.int32))
            return [pa.ListArray.from_arrays(pa.array(ends), values)]
        return fn
    return map_columns(packed(docs, text_col), [f"in_{text_col}"], [T.StructField("ids", T.ArrayType(T.IntegerType()))],
                       make)


def decode_ids(table: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary) to a table of ids; null ids decode to nothing."""
    codec = codec_maker(table.sparkSession, ranks_path, pattern)

    def make():
        decode = codec().decode
        return lambda col: [pa.array([decode(ids or []) for ids in col.to_pylist()], pa.binary())]
    return map_columns(table.withColumn("in_ids", F.col(ids_col)), ["in_ids"],
                       [T.StructField("decoded", T.BinaryType())], make)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                       keep: list[str] | None = None) -> DataFrame:
    """``(row, n_tokens, ids_sha256, decoded_sha256)``: encode, then decode the ids, in one pass."""
    codec = codec_maker(docs.sparkSession, ranks_path, pattern)

    def make():
        c = codec()

        def one(text):
            ids = np.frombuffer(c.encode(text), "<u4").tolist()
            return (len(ids), hashlib.sha256(c.decimal(ids).encode()).hexdigest(),
                    hashlib.sha256(c.decode(ids)).hexdigest())

        def fn(col):
            n, ids, decoded = zip(*map(one, strings(col)))
            return [pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)]
        return fn
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return map_columns(packed(docs, text_col, keep=keep), [f"in_{text_col}"], fields, make)


# --- the fold as higher-order functions ------------------------------------------------------

#: Power of two; pieces are spread over so many small maps, as a map look-up is a linear search.
BUCKETS = 1 << 15


def _bucket(piece: Column) -> Column:
    return F.pmod(F.crc32(piece), F.lit(BUCKETS)).cast("int")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as one constant: an array of maps from hex piece to rank."""
    import zlib
    table: list[dict] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        table[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(table)), T.ArrayType(T.MapType(T.StringType(), T.IntegerType())))


def fold_column(word: Column, ranks: Column) -> Column:
    """``array<int>``: the ids of one word (a string column), by higher-order functions alone."""
    whole = F.hex(F.encode(word, "UTF-8"))
    rank = lambda piece: F.get(ranks, _bucket(piece))[piece]
    start = F.transform(F.sequence(F.lit(0), F.octet_length(word) - 1), lambda i: F.substring(whole, i * 2 + 1, 2))

    def merge(parts, _):
        scores = F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                             lambda i: rank(F.concat(F.get(parts, i - 1), F.get(parts, i))))
        at = F.array_position(scores, F.array_min(scores)).cast("int")  # 1-based, leftmost
        merged = F.concat(F.slice(parts, 1, at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                          F.slice(parts, at + 2, F.size(parts)))
        return F.when((F.size(parts) < 2), parts).otherwise(
            F.when(F.array_min(scores).isNull(), parts).otherwise(merged))
    steps = F.sequence(F.lit(1), F.octet_length(word))
    return F.when(rank(whole).isNotNull(), F.array(rank(whole))).otherwise(
        F.transform(F.aggregate(steps, start, merge), rank))


def encode_words(words: DataFrame, ranks_path: str, word_col: str = "word") -> DataFrame:
    """``(word, ids)`` for the distinct words of a column (null and empty words left out)."""
    ranks = rank_literal(read_ranks(ranks_path))
    distinct = words.select(F.col(word_col).alias("word")).where("word <> ''").distinct()
    return distinct.select("word", fold_column(F.col("word"), ranks).alias("ids"))
