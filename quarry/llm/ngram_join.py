"""N-gram Jaccard join by chosen paths, and the groups of near-duplicates it finds.

A document is its set of word shingles (five words).  Documents with the same
words in the same order are one *node*; copies are never paired.  Each node
is embedded as ``HASHES`` min-hash tokens, two nodes sharing a token with the
probability of their Jaccard similarity.

Chosen paths.  A run samples tokens by a hash of run and token, ``BRANCHES``
of a node's tokens on average; nodes that share a sampled token share a bucket.
Buckets of up to ``limit`` nodes are compared outright.  Larger ones are split
on further sampled tokens, level by level.  What is still larger after
``MAX_DEPTH`` levels is cut into blocks that are compared block by block, so no
size is left out and no task holds more than two blocks.  A split that keeps
half of a bucket together shows a dense group, which further splits would only
copy; it goes to the blocks at once.  Each path keeps a pair
of the threshold similarity with a probability that :func:`kept_per_run` gives;
runs repeat until the target recall is met.

Comparing.  A pair is handled in the first bucket that both nodes share (every
member carries the list of its buckets), so nothing is counted twice and
no table of pairs is made.  A first pass compares sketches and drops pairs
far below the threshold (five standard deviations); only the nodes left
fetch their text and are compared exactly, by all their shingles.  A bucket
returns per member the number of documents it is linked to and the root of its
component inside the bucket; both grow with the members, not with the pairs.

Defined results: texts of fewer than five words are one shingle of all words;
texts without words (null, blank) are copies of each other and linked to
nothing else; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_columns, packed, scope, staged, strings, unstaged

SHINGLE = 5
HASHES = 64
BRANCHES = 2.0
MAX_DEPTH = 5
MARK_BITS = 26  # of a bit map that goes to every worker: 8 MB
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    x = (x ^ (x >> np.uint64(29))) * _P
    return x ^ (x >> np.uint64(32))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    x = _mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * _P)
    return x[:HASHES] | np.uint64(1), x[HASHES:]


class Shingler:
    """Shingle hashes of texts; word hashes are kept from text to text."""

    def __init__(self):
        import xxhash
        self.hash = xxhash.xxh3_64_intdigest
        self.seen: dict[bytes, int] = {}

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """64-bit hashes of all shingles, repeats included."""
        if not words:
            return np.empty(0, np.uint64)
        if len(self.seen) > 500_000:
            self.seen.clear()
        seen, new = self.seen, self.hash
        keys = []
        for w in words:
            k = seen.get(w)
            if k is None:
                k = seen[w] = new(w)
            keys.append(k)
        k = np.array(keys, np.uint64)
        n = min(SHINGLE, len(k))
        out = np.full(len(k) - n + 1, np.uint64(n))
        for j in range(n):
            out = out * _P + k[j:len(k) - n + 1 + j]
        return _mixed(out)


def node_of(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(shingles), 4096):
        out = np.minimum(out, (shingles[i:i + 4096, None] * a + b).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def kept_per_run(threshold: float) -> float:
    """Probability that a pair of the threshold similarity shares a bucket after :data:`MAX_DEPTH` levels of a run."""
    p = 1.0
    for _ in range(MAX_DEPTH):
        p = 1 - math.exp(-BRANCHES * threshold * p)
    return p


def runs_for(threshold: float, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - kept_per_run(threshold))))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, node, sig)`` of every row; ``sig`` is null for texts without words."""
    def make():
        shingler, (a, b) = Shingler(), _coefficients()

        def fn(col):
            nodes, sigs = [], []
            for t in strings(col):
                words = t.encode("utf-8", "surrogatepass").split()
                nodes.append(node_of(words))
                sigs.append(signature(shingler.shingles(words), a, b).tobytes() if words else None)
            return [pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())]
        return fn
    return map_columns(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["text"],
                       [T.StructField("node", T.BinaryType()), T.StructField("sig", T.BinaryType())], make)


_MEMBER = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("node", T.BinaryType())])


def _sampled(sig: np.ndarray, salt: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and bucket keys of the sampled tokens of a matrix of signatures."""
    token = sig.astype(np.uint64) | (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))
    x = _mixed(token * _Q + salt)
    row, _ = at = np.nonzero(x < np.uint64(int(BRANCHES / HASHES * 2.0 ** 64)))
    return row, _mixed(x[at] * _P + np.uint64(1)).view(np.int64)


def _signatures(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, HASHES)


def first_buckets(nodes: DataFrame, runs: int) -> DataFrame:
    """``(bucket, node)`` of the first level of all runs."""
    def run(batches):
        salts = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * _Q)
        for b in batches:
            if not b.num_rows:
                continue
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                sig = _signatures(part.column("sig"))
                for salt in salts:
                    row, bucket = _sampled(sig, salt)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), part.column("node").take(pa.array(row))],
                                                     names=["bucket", "node"])
    return nodes.where("sig is not null").select("node", "sig").mapInArrow(run, _MEMBER)


def next_buckets(members: DataFrame) -> DataFrame:
    """Splits of ``(bucket, node, n, sig)`` on further sampled tokens; ``parent`` is the size of the bucket split."""
    schema = T.StructType([*_MEMBER.fields, T.StructField("parent", T.LongType())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            salt = _mixed(b.column("bucket").to_numpy().view(np.uint64) + _P)[:, None]
            row, bucket = _sampled(_signatures(b.column("sig")), salt)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), b.column("node").take(at), b.column("n").take(at)],
                                             names=schema.fieldNames())
    return members.select("bucket", "node", "n", "sig").mapInArrow(run, schema)


def leaf_members(nodes: DataFrame, runs: int, limit: int) -> DataFrame:
    """``(leaf, node)``: the small buckets of all paths with at least two members."""
    level = first_buckets(nodes, runs).withColumn("parent", F.lit(None).cast("long"))
    leaves = None
    for depth in range(MAX_DEPTH + 1):
        sizes = staged(level.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "join-sizes")
        live = staged(level.join(sizes, "bucket"), "join-live")
        big = live.where(F.col("n") > limit)
        dense = F.lit(True) if depth == MAX_DEPTH else F.coalesce(2 * F.col("n") > F.col("parent"), F.lit(False))
        blocks = (big.where(dense).withColumn("k", F.ceil(F.col("n") / F.lit(limit)).cast("int"))
                  .withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
                  .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("leaf"), "node"))
        found = live.where(F.col("n") <= limit).select(F.col("bucket").alias("leaf"), "node").union(blocks)
        leaves = found if leaves is None else leaves.union(found)
        split = big.where(~dense)
        if split.isEmpty():
            return leaves
        level = staged(next_buckets(split.join(nodes.select("node", "sig"), "node")), "join-level")
    return leaves


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)]):
            if held and k[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
            last = k[a]
    if held:
        yield pa.Table.from_batches(held)


def _met_before(paths: list[np.ndarray], leaf: int) -> np.ndarray:
    """For every two members, whether they share a bucket whose key has a lower high half than this one's."""
    m, leaf = len(paths), np.int32(leaf >> 32)
    lower = [p[p < leaf] for p in paths]
    flat = np.concatenate(lower) if m else np.empty(0, np.int32)
    if not len(flat):
        return np.zeros((m, m), bool)
    keys, col = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(m), [len(p) for p in lower])
    shared = np.zeros((m, m), np.float32)
    for i in range(0, len(keys), 4096):
        at = (col >= i) & (col < i + 4096)
        part = np.zeros((m, min(4096, len(keys) - i)), np.float32)
        part[row[at], col[at] - i] = 1
        shared += part @ part.T
    return shared > 0


def close_members(members: DataFrame, threshold: float) -> DataFrame:
    """Members of ``(leaf, node, paths, low)`` with a partner whose sketch may reach the threshold."""
    least = math.floor(HASHES * threshold - 5 * math.sqrt(HASHES * threshold * (1 - threshold)))
    schema = T.StructType([members.schema["leaf"], members.schema["node"], members.schema["paths"]])

    def run(batches):
        for g in _groups(batches, "leaf"):
            m = g.num_rows
            if m < 2:
                continue
            sig = np.frombuffer(b"".join(g.column("low").to_pylist()), np.uint8).reshape(m, HASHES)
            close = np.zeros((m, m), bool)
            for i in range(m - 1):
                close[i, i + 1:] = (sig[i + 1:] == sig[i]).sum(axis=1) >= least
            if not close.any():
                continue
            leaf = g.column("leaf")[0].as_py()
            paths = [np.array(p, np.int32) for p in g.column("paths").to_pylist()]
            close &= ~_met_before(paths, leaf)
            keep = np.flatnonzero(close.any(0) | close.any(1))
            if len(keep):
                yield from g.select(schema.fieldNames()).take(pa.array(keep)).combine_chunks().to_batches()
    return members.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(run, schema)


def _components(near: np.ndarray) -> np.ndarray:
    """Lowest member of each member's component in a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """``(node, root, links)`` from ``(leaf, node, paths, copies, shingles)``: a row per linked member of a bucket."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("root", T.BinaryType()),
                           T.StructField("links", T.LongType())])

    def run(batches):
        for g in _groups(batches, "leaf"):
            m = g.num_rows
            if m < 2:
                continue
            order = sorted(range(m), key=(nodes := g.column("node").to_pylist()).__getitem__)
            nodes = [nodes[i] for i in order]
            copies = g.column("copies").to_numpy()[order]
            held = g.column("shingles").to_pylist()
            sets = [np.frombuffer(held[i], np.uint64) for i in order]
            paths = g.column("paths").to_pylist()
            paths = [np.array(paths[i], np.int32) for i in order]
            sizes = np.array([len(s) for s in sets], np.float64)
            keys, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(m), sizes.astype(np.int64))
            place = np.cumsum(seen > 1) - 1  # shingles of one member don't meet
            shared = seen[col] > 1
            row, col = row[shared], place[col[shared]]
            both = np.zeros((m, m))
            for i in range(0, int((seen > 1).sum()), 4096):
                at = (col >= i) & (col < i + 4096)
                part = np.zeros((m, 4096), np.float32)
                part[row[at], col[at] - i] = 1
                both += part @ part.T
            union = sizes[:, None] + sizes[None, :] - both
            near = both >= threshold * union - 1e-9
            np.fill_diagonal(near, False)
            near &= ~_met_before(paths, g.column("leaf")[0].as_py())
            links = near @ copies
            linked = np.flatnonzero(near.any(axis=1))
            if len(linked):
                root = _components(near)
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in linked], pa.binary()),
                                                  pa.array([nodes[root[i]] for i in linked], pa.binary()),
                                                  pa.array(links[linked].astype(np.int64))], names=schema.fieldNames())
    return members.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(run, schema)


def with_node(docs: DataFrame, text_col: str) -> DataFrame:
    """``(row, node)``: every row with the hash of its words."""
    def make():
        return lambda col: [pa.array([node_of(t.encode("utf-8", "surrogatepass").split()) for t in strings(col)], pa.binary())]
    return map_columns(packed(docs, text_col), [f"in_{text_col}"], [T.StructField("node", T.BinaryType())], make)


class Marks:
    """A Bloom filter with one hash: a bit map over the first bits of 16-byte keys, of at most ``2 ** MARK_BITS`` bits.

    It says "no" only for keys that are not in the set; what it lets through meets an exact join.
    """

    def __init__(self, bits: int, words: np.ndarray, values: np.ndarray):
        self.bits = bits
        self.map = np.zeros((1 << bits) // 64, np.uint64)
        self.map[words] = values

    def holds(self, keys: list[bytes]) -> np.ndarray:
        at = np.frombuffer(b"".join(k[:4] for k in keys), ">u4").astype(np.int64) >> (32 - self.bits)
        return (self.map[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def marks_of(keys: DataFrame, column: str) -> Marks:
    """The bit map of a binary column; about sixteen bits a key while they last, and a row per 64 of them for the driver."""
    n = keys.count()
    bits = min(MARK_BITS, max(10, int(16 * max(1, n)).bit_length()))
    at = F.shiftright(F.conv(F.hex(F.substring(column, 1, 4)), 16, 10).cast("long"), 32 - bits)
    rows = (keys.select(F.shiftright(at, 6).alias("word"), F.expr("1L").alias("one"), (at % 64).cast("int").alias("bit"))
            .select("word", F.expr("shiftleft(one, bit)").alias("value")).groupBy("word").agg(F.bit_or("value").alias("value")).toArrow())
    return Marks(bits, rows.column("word").to_numpy(), rows.column("value").to_numpy().view(np.uint64))


def marked(table: DataFrame, key: str, marks: DataFrame, column: str) -> tuple[DataFrame, Broadcast]:
    """``table`` with ``marked``: whether the binary ``key`` may be among ``marks.column``; and the broadcast bit map."""
    shared = table.sparkSession.sparkContext.broadcast(marks_of(marks, column))

    def make():
        return lambda col: [pa.array(shared.value.holds(col.to_pylist()))]
    out = map_columns(table.withColumn("in_key", F.col(key)), ["in_key"], [T.StructField("marked", T.BooleanType())], make)
    return out, shared


def node_sets(docs: DataFrame, needed: DataFrame, text_col: str) -> tuple[DataFrame, Broadcast]:
    """``(node, shingles)``: sorted distinct shingles of the needed nodes; copies meet once, and only texts that
    may be needed are shuffled."""
    likely, shared = marked(with_node(docs.select(text_col), text_col), "node", needed, "node")
    texts = (likely.where("marked").groupBy("node").agg(F.first(f"row.{text_col}").alias("text"))
             .join(needed, "node", "left_semi"))

    def make():
        shingler = Shingler()
        return lambda col: [pa.array([np.unique(shingler.shingles(t.encode("utf-8", "surrogatepass").split())).tobytes()
                                      for t in strings(col)], pa.binary())]
    return map_columns(texts, ["text"], [T.StructField("shingles", T.BinaryType())], make), shared


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)``: the lowest node of every connected component of ``(node, root)`` links.

    Lowest labels spread over the links and are followed by one jump (a label's
    own label) per round; state is written between rounds.
    """
    both = staged(edges.union(edges.select("root", "node")).distinct().toDF("a", "b"), "cc-edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")),
                    "cc-labels")
    while True:
        around = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        spread = staged(labels.join(around, labels.node == around.a, "left")
                        .select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next")), "cc-spread")
        jump = spread.select(F.col("node").alias("j"), F.col("next").alias("far"))
        new = staged(spread.join(jump, spread.next == jump.j, "left")
                     .select("node", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label")),
                     "cc-labels")
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels


def similar_nodes(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999, limit: int = 2_000, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(id, node)`` of every row, and per node ``(node, first_id, copies, label, links)``; ``label`` is the
    lowest node of its group of near-duplicates, ``links`` counts the linked documents of other nodes."""
    with scope(docs.sparkSession) as own:  # only the rows and the nodes' groups outlive it
        rows = own.hand_over(staged(sketches(docs, id_col, text_col), "join-rows"))
        nodes = staged(rows.groupBy("node").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                                F.first("sig").alias("sig")), "join-nodes")
        # a byte of every token is enough to compare sketches, and half of a path's key to tell paths apart
        low = F.expr("concat(" + ", ".join(f"substring(sig, {4 * i + 1}, 1)" for i in range(HASHES)) + ")")
        with scope(docs.sparkSession) as levels:
            leaves = leaf_members(nodes, runs_for(threshold, recall), limit)
            paths = leaves.groupBy("node").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
            carried = levels.hand_over(staged(paths.join(nodes.select("node", low.alias("low")), "node").select(
                "node", "leaves", F.transform("leaves", lambda p: F.shiftright(p, 32).cast("int")).alias("paths"), "low"), "join-carried"))
        members = carried.select(F.explode("leaves").alias("leaf"), "node", "paths", "low")
        close = staged(close_members(members, threshold), "join-close")
        unstaged(carried)
        sets, shared = node_sets(docs, close.select("node").distinct(), text_col)
        full = close.join(sets, "node").join(nodes.select("node", "copies"), "node")
        found = staged(exact_links(full.select("leaf", "node", "paths", "copies", "shingles"), threshold), "join-found")
        shared.destroy()
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        labels = components(found.where("node <> root").select("node", "root"))
        info = (nodes.drop("sig").join(labels, "node", "left").join(links, "node", "left")
                .select("node", "first_id", "copies", F.coalesce("label", "node").alias("label"),
                        F.coalesce("links", F.lit(0)).alias("links")))
        return rows.select("id", "node"), own.hand_over(staged(info, "join-info"))


def join_documents(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``(<id_col>, class_id, copy_of, n_links)``.

    ``class_id`` is the lowest id of the document's group of near-duplicates,
    ``copy_of`` the lowest id with the same words, ``n_links`` the number of other
    documents (copies included) with similarity of at least the threshold.
    """
    rows, info = similar_nodes(docs, threshold, recall, id_col=id_col, text_col=text_col, **options)
    lowest = info.groupBy("label").agg(F.min("first_id").alias("class_id"))
    per_node = staged(info.join(lowest, "label").select(
        "node", "class_id", F.col("first_id").alias("copy_of"), (F.col("copies") - 1 + F.col("links")).alias("n_links")), "join-out")
    return rows.join(per_node, "node").select(F.col("id").alias(id_col), "class_id", "copy_of", "n_links")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group stays: that with the lowest id (then the lowest hash of its words, then the lowest row).

    Most rows are the only one of their node and that node's group, or clearly its first.  Such rows stay where they lie;
    the nodes of all others are marked in a bit map, and only rows of nodes that may be marked are shuffled and compared.
    """
    rows, info = similar_nodes(docs, id_col=id_col, text_col=text_col, **options)
    best = (info.groupBy("label").agg(F.min(F.struct(F.col("first_id").isNull().alias("unset"), "first_id", "node")).alias("b"))
            .select("label", F.col("b.node").alias("node"), F.col("b.first_id").alias("first_id")))
    winners = staged(best, "join-winners")
    doubtful = info.join(winners.select("node", F.lit(True).alias("wins")), "node", "left").where(F.col("wins").isNull() | (F.col("copies") > 1))
    located, _ = marked(with_node(docs, text_col), "node", staged(doubtful.select("node"), "join-doubtful"), "node")
    alone = located.where(~F.col("marked")).select("row")
    kept = (located.where("marked").select("row", "node").join(winners, "node").where(F.col(f"row.`{id_col}`").eqNullSafe(F.col("first_id")))
            .groupBy("label").agg(F.min("row").alias("row")).select("row"))
    return alone.union(kept).select("row.*")
