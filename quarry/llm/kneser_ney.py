"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

Training.  The trigram model learns from trusted text: of all labelled good documents
every second one of a language, in the order of the md5 of the id.  A caller may bound this to
``max_docs`` documents, the languages in turn, lowest md5
of the id first, and no more than ``max_words`` words in all (a text that does not fit into
the words left is passed over; if trusted documents exist but none fits, an
error is raised).  Counts,
continuation counts, the three discounts of every order and the interpolated
probabilities are grouped sums, windows and joins sharded by n-gram or context.
Larger texts are counted and solved in slices of n-grams, by the word before the last, one after
another, so that a slice's shuffles and tables are gone before the next one's are written.
The finished model (one row per n-gram learned) is written by the tasks as
sorted blocks of keys and values in the shared folder (:class:`Blocks`), which
the scoring tasks map into memory; the driver sees counts of counts and file names.

Scoring covers every document and its whole text: each word's probability is
looked up for its longest known context, row by row, without a shuffle.  (One
joined row per n-gram of the corpus would shuffle several times the input.)

Decision.  All trusted documents that were not learned from calibrate, however
many there are: for each language the threshold is the ``quantile`` of their
scores, times ``slack``; languages with fewer than ``min_calibration`` of them
(by default: with none) use the threshold of all.  Before it is compared, a document's mean log probability is
drawn to its language's mean by ``PSEUDO_WORDS`` words, since a short text says
little.

Defined results: a null or blank text is the end token alone; a null language
is one of its own; without trusted text every document is kept, with null
perplexity; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from quarry.llm.binary_sink import mapped_bytes, write_blobs
from quarry.llm.common import WORD, map_columns, packed, scope, small_batches, staged, strings, unstaged, work_dir
from quarry.plans.lineage import shuffles_freed
from quarry.plans.order import numbered

START_KEY, END_KEY = 1, 2  # no 64-bit hash of a word is assumed to be these
PSEUDO_WORDS = 30.0
SHARD_BITS = 6  # leading bits of a key that name its shard of a table of the model
SLICE_BITS, SLICE_WORDS = 3, 2_500_000  # 2 ** bits slices at most, of so many words each where they are fewer
BLOCK_KEYS = 4_000_000  # keys of a block at most: a task holds one while it writes
MAX_DOCS, MAX_WORDS = 8_000, 5_000_000  # the other bound, where a caller gives one of the two
SEEN_WORDS = 60_000  # words of which a scoring task keeps the keys


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``(id)``: the documents labelled as good and not toxic."""
    return (labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select(F.col("doc_id").alias("id"))
            .where("id is not null").distinct())


def training_sample(docs: DataFrame, trusted: DataFrame, max_docs: int, max_words: int, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, text)``: every second document of a bounded sample of the trusted ones, in which the languages take turns."""
    spark = docs.sparkSession
    place = F.md5(F.col("id").cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"))
    # n bytes hold at most n / 2 + 1 words and an empty piece at either end, so that few texts need be split
    fits = (F.coalesce(F.octet_length("text"), F.lit(0)) <= 2 * max_words - 6) | (words <= max_words)
    every = staged(rows.select("id", "lang", fits.alias("fits")).join(trusted, "id", "left_semi")
                   .groupBy("id").agg(F.min(F.struct("lang")).alias("d"), F.every("fits").alias("fits"))
                   .select("id", "d.lang", "fits"), "kn-trusted")
    found = every.where("fits")
    sizes = found.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    # the lowest hashes of a language are below this share of all hashes; leaves about 2 * max_docs rows of each
    low = F.conv(F.substring(place, 1, 8), 16, 10).cast("double") / 2.0 ** 32 * F.col("n") <= 2.0 * max_docs
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(place, "id"))
    chosen = (found.join(sizes, F.col("lang").eqNullSafe(F.col("l"))).where(low).withColumn("turn", turn)
              .orderBy("turn", place, "id").limit(max_docs).select("id", "turn"))
    # one text for each of the max_docs ids at most, also where an id repeats
    sample = (rows.join(F.broadcast(staged(chosen, "kn-ids")), "id")
              .groupBy("id", "turn").agg(F.min(F.struct("lang", "text")).alias("d")).select("id", "turn", "d.text")
              .withColumn("words", words))
    sample = staged(sample, "kn-candidates")
    learned, used = [], 0
    for r in sample.orderBy("turn", place, "id").select("id", "turn", "words").collect():  # at most max_docs rows
        if used + r["words"] <= max_words:  # a text that does not fit is left out alone
            used += r["words"]
            if r["turn"] % 2 == 1:
                learned.append((r["id"],))
    if not learned and not every.isEmpty():
        raise ValueError(f"no trusted document fits into the sample of {max_docs} documents and {max_words} words")
    ids = spark.createDataFrame(learned, T.StructType([sample.schema["id"]]))
    return sample.join(F.broadcast(ids), "id", "left_semi").select("id", "text")


def training_half(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, text)``: every second of all trusted documents of a language, by the md5 of the id; one text for each id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    every = (rows.select("id", "lang").join(trusted, "id", "left_semi").groupBy("id").agg(F.min(F.struct("lang")).alias("d"))
             .select("id", "d.lang"))
    placed = staged(numbered(every, "lang", F.md5(F.col("id").cast("string")), "id"), "kn-trusted")
    first = placed.groupBy(F.col("lang").alias("l")).agg(F.min("ordinal").alias("first"))  # a row per language
    ids = staged(placed.join(F.broadcast(first), F.col("lang").eqNullSafe(F.col("l")))
                 .where((F.col("ordinal") - F.col("first")) % 2 == 0).select("id"), "kn-ids")
    return (rows.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("lang", "text")).alias("d"))
            .select("id", "d.text"))


def sequences(texts: DataFrame) -> DataFrame:
    """``(k)``: the word keys of each text, two start keys before and an end key after them."""
    keys = F.transform(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))
    start, end = F.lit(START_KEY).cast("long"), F.lit(END_KEY).cast("long")
    return texts.select(F.concat(F.array(start, start), F.coalesce(keys, F.array().cast("array<long>")), F.array(end)).alias("k"))


class Blocks:
    """A table of 64-bit keys and 32-bit values in files of blocks of sorted keys, each ``count, keys, values, zeros``; opened where it is used."""

    def __init__(self, files: list[str]):
        self.files = files
        self._open: list[tuple[np.ndarray, np.ndarray]] | None = None

    def __getstate__(self):
        return {"files": self.files, "_open": None}

    def parts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if self._open is None:
            found = []
            for f in self.files:
                raw, at = mapped_bytes(f), 0
                while at < len(raw):
                    n = int(raw[at:at + 8].view("<i8")[0])
                    found.append((raw[at + 8:at + 8 + 8 * n].view("<i8"), raw[at + 8 + 8 * n:at + 8 + 12 * n].view("<f4")))
                    at += 16 + 12 * n + 4 * (n % 2)  # blocks begin at a multiple of 8: unaligned keys would be copied by every look-up
            self._open = sorted((x for x in found if len(x[0])), key=lambda x: int(x[0][0]))
        return self._open

    def keys(self) -> np.ndarray:
        return np.concatenate([k for k, _ in self.parts()] or [np.empty(0, np.int64)])

    def find(self, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is here, and its value or the default."""
        keys = keys.view(np.int64)
        hit, out = np.zeros(len(keys), bool), np.full(len(keys), default)
        parts = self.parts()
        order = np.argsort(keys)  # look-ups in key order stay close to each other in a large table
        keys = keys[order]
        begins = np.searchsorted(keys, np.array([k[0] for k, _ in parts], np.int64))
        for (k, values), begin, end in zip(parts, begins, [*begins[1:], len(keys)]):
            some = keys[begin:end]
            place = np.minimum(np.searchsorted(k, some), len(k) - 1)
            same = k[place] == some
            at = order[begin:end][same]
            hit[at] = True
            out[at] = values[place[same]]
        return hit, out


def write_blocks(rows: DataFrame, path: str, most: int = BLOCK_KEYS) -> dict[str, Blocks]:
    """Write ``(kind string, key long, value float)`` as sorted blocks of ``most`` keys and a batch at most; a table per kind.

    Keys are hashes: their leading bits deal them out evenly, and no block reaches beyond a shard.
    """
    spark = rows.sparkSession
    small_batches(spark)
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("blob", T.BinaryType())])

    def run(batches):
        last, held, n = None, [], 0

        def block():
            k = np.concatenate([x for x, _ in held])
            v = np.concatenate([x for _, x in held])
            body = np.int64(len(k)).tobytes() + k.astype("<i8").tobytes() + v.astype("<f4").tobytes() + bytes(8 + 4 * (len(k) % 2))
            return pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([body], pa.binary())], names=schema.fieldNames())
        for b in batches:
            kinds, shards = b.column("kind").dictionary_encode(), b.column("shard").to_numpy()
            codes, keys, values = kinds.indices.to_numpy(), b.column("key").to_numpy(), b.column("value").to_numpy()
            starts = np.flatnonzero(np.r_[len(codes) > 0, (codes[1:] != codes[:-1]) | (shards[1:] != shards[:-1])])
            for begin, end in zip(starts, [*starts[1:], len(codes)]):
                own = kinds.dictionary[int(codes[begin])].as_py(), int(shards[begin])
                if held and (own != last or n >= most):
                    yield block()
                    held, n = [], 0
                last = own
                n += end - begin
                held.append((keys[begin:end], values[begin:end]))
        if held:
            yield block()

    dealt = (rows.select("kind", F.shiftright("key", 64 - SHARD_BITS).cast("int").alias("shard"), "key", "value")
             .repartition("kind", "shard").sortWithinPartitions("kind", "shard", "key"))
    write_blobs(dealt.mapInArrow(run, schema), path, "blob", partition_by="kind")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
             .select("path").collect())  # a shard's worth each at least
    out: dict[str, list[str]] = {}
    for r in files:
        out.setdefault(r["path"].rsplit("kind=", 1)[1].split("/")[0], []).append(r["path"])
    return {k: Blocks(v) for k, v in out.items()}


def vocabulary(seq: DataFrame) -> Blocks:
    """Word keys of the text learned from; a word's place in their order is its number."""
    keys = seq.select(F.explode("k").alias("key")).groupBy("key").agg(F.lit(0.0).cast("float").alias("value"))
    return write_blocks(keys.withColumn("kind", F.lit("words")), work_dir(seq.sparkSession, "kn-words")).get("words", Blocks([]))


def numbered_words(seq: DataFrame, vocab: Blocks) -> DataFrame:
    """``(k)``: the sequences with the numbers of their words."""
    small_batches(seq.sparkSession)

    def run(batches):
        words = vocab.keys()
        for b in batches:
            lists = b.column(0)
            number = pa.array(np.searchsorted(words, lists.flatten().to_numpy()).astype(np.int32))
            ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), number)], names=["k"])

    return seq.mapInArrow(run, T.StructType([T.StructField("k", T.ArrayType(T.IntegerType()))]))


def trigrams(seq: DataFrame, vocab: Blocks, part: int = 0, parts: int = 1) -> DataFrame:
    """``(u, v, w, c)``: counted trigrams of word numbers, of the slice ``part`` of ``parts`` by the word ``v``.

    Partitioned by the last two words, so that each bigram's count is whole in one partition.
    """
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in "uvw"])
    small_batches(seq.sparkSession)

    def run(batches):
        own = _leading(vocab.keys()) * np.uint64(parts) >> np.uint64(SLICE_BITS) == part
        for b in batches:
            lists = b.column(0)
            number = lists.flatten().to_numpy()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            whole = np.ones(len(number), bool)
            whole[ends - 1] = whole[ends - 2] = False  # no trigram begins at a text's last two places
            whole[:-1] &= own[number[1:]]
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(number[at + j]) for j in range(3)], names=schema.fieldNames())

    return (seq.mapInArrow(run, schema).repartition("v", "w")
            .groupBy("u", "v", "w").agg(F.count(F.lit(1)).cast("int").alias("c")))


def discounts(counted: DataFrame) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts from the counts of counts 1 to 4."""
    n = counted.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(n[f"n{i}"]) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1))


def _order(counted: DataFrame, context: list[str], lower: DataFrame, d: tuple[float, float, float]) -> DataFrame:
    """Interpolated probabilities of one order, ``(context..., w, p, g)``; ``g`` is the context's back-off
    weight, given in one row of each context and null in the others."""
    low = lower.withColumnRenamed("p", "low")
    joined = counted.join(low, [c for c in low.columns if c != "low"])
    discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
    every = Window.partitionBy(*context)  # followers of one context
    total, freed = F.sum("c").over(every), F.sum(discount).over(every)
    return (joined.withColumn("total", total).withColumn("g", freed / F.col("total"))
            .withColumn("at", F.row_number().over(every.orderBy("w")))
            .select(*context, "w", ((F.col("c") - discount) / F.col("total") + F.col("g") * F.col("low")).alias("p"),
                    F.when(F.col("at") == 1, F.col("g")).alias("g")))


def _leading(keys: np.ndarray) -> np.ndarray:
    """The leading bits of each word key, which name its slice."""
    return keys.view(np.uint64) >> np.uint64(64 - SLICE_BITS)


def _mix(*keys: np.ndarray) -> np.ndarray:
    """One 64-bit key of several; it begins like the key of the middle one of three words or the first of fewer, by which
    n-grams are sliced, so that the slices' keys don't overlap."""
    out = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        out = (out ^ k.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    lead = _leading(keys[len(keys) // 3])
    return out >> np.uint64(SLICE_BITS) | lead << np.uint64(64 - SLICE_BITS)


def _keyed(table: DataFrame, columns: list[str], value: str, kind: str, vocab: Blocks) -> DataFrame:
    """``(kind, key, value)``: one 64-bit key for the word numbers of ``columns`` and the log10 of ``value``."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("value", T.FloatType())])

    def run(batches):
        words = vocab.keys()
        for b in batches:
            logs = np.log10(np.maximum(b.column(value).to_numpy(), 1e-300)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(_mix(*[words[b.column(c).to_numpy()] for c in columns]).view(np.int64)),
                                              pa.array(logs)], names=schema.fieldNames())
    return table.select(*columns, value).mapInArrow(run, schema).select(F.lit(kind).alias("kind"), "key", "value")


def train(texts: DataFrame, slice_words: int = SLICE_WORDS) -> dict | None:
    """Fit on ``(text)`` rows: the tables ``p1, g1, p2, g2, p3`` of log10 probabilities and back-off weights as blocks
    (bounded by the sample), and the log10 probability ``unknown``.  The files belong to the open scope.

    A slice holds all n-grams with one of its words before the last: with ``slice_words`` words a slice, and ``2 ** SLICE_BITS``
    slices at most, its tables are that share of all.
    """
    spark = texts.sparkSession
    with shuffles_freed(spark):
        seq = sequences(texts)
        vocab = vocabulary(seq)
        seq = staged(numbered_words(seq, vocab), "kn-sequences")
        size = seq.agg(F.sum(F.size("k"))).first()[0] or 0
        parts = 1
        while parts < 1 << SLICE_BITS and parts * slice_words < size:
            parts *= 2
        tri = [staged(trigrams(seq, vocab, i, parts), "kn-trigrams") for i in range(parts)]
        unstaged(seq)  # nothing reads the texts any more
        bi = [staged(t.groupBy("v", "w").agg(F.count(F.lit(1)).cast("int").alias("c")), "kn-bigrams") for t in tri]
        every_tri, every_bi = (functools.reduce(DataFrame.union, x) for x in (tri, bi))
        uni = staged(every_bi.groupBy("w").agg(F.count(F.lit(1)).alias("c")), "kn-unigrams")
        n_words = uni.count()
        if not n_words:
            return None
        uniform = 1.0 / (n_words + 1)  # one share for all unknown words
        d1, d2, d3 = discounts(uni)
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        total, freed = uni.agg(F.sum("c"), F.sum(discount)).first()
        g0 = freed / total
        p1 = uni.select("w", ((F.col("c") - discount) / F.lit(total) + F.lit(g0 * uniform)).alias("p"))
        of_bi, of_tri = discounts(every_bi), discounts(every_tri)
        first, backs = _keyed(p1, ["w"], "p", "p1", vocab), []
        written = [write_blocks(first, work_dir(spark, "kn-model"))]
        for t, b in zip(tri, bi):
            p2 = staged(_order(b, ["v"], p1, of_bi), "kn-p2")
            unstaged(b)
            p3 = staged(_order(t, ["u", "v"], p2.drop("g"), of_tri), "kn-p3")
            unstaged(t)
            rows = (_keyed(p2.where("g is not null"), ["v"], "g", "g1", vocab).union(_keyed(p2, ["v", "w"], "p", "p2", vocab))
                    .union(_keyed(p3, ["u", "v", "w"], "p", "p3", vocab)))
            written.append(write_blocks(rows, work_dir(spark, "kn-model")))
            # contexts of two words begin with the other word: their keys lie in all slices and are sorted at the end
            backs.append(staged(_keyed(p3.where("g is not null"), ["u", "v"], "g", "g2", vocab), "kn-backs"))
            unstaged(p2)
            unstaged(p3)
        every = functools.reduce(DataFrame.union, backs)
        lead = F.shiftright("key", 64 - SLICE_BITS) + (1 << SLICE_BITS - 1)
        for i in range(parts):
            written.append(write_blocks(every.where(F.shiftright(lead * parts, SLICE_BITS) == i), work_dir(spark, "kn-model")))
        for x in backs:
            unstaged(x)
    tables = {k: Blocks([f for x in written if k in x for f in x[k].files]) for k in ("p1", "g1", "p2", "g2", "p3")}
    return {**tables, "unknown": float(np.log10(g0 * uniform))}


def _find(table: Blocks, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
    return table.find(keys, default)


def log10_probs(model: dict, keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of log10 probabilities of each text; ``keys`` holds the padded texts one after another,
    ``ends`` the place after each one's end key."""
    u, v, w = keys[:-2], keys[1:-1], keys[2:]
    real = w != START_KEY
    u, v, w = u[real], v[real], w[real]
    hit, p = _find(model["p3"], _mix(u, v, w), 0.0)
    at = np.flatnonzero(~hit)  # of these words the lower orders are asked, and the weights they are taken with
    u, v, w = u[at], v[at], w[at]
    hit, p2 = _find(model["p2"], _mix(v, w), 0.0)
    miss = ~hit
    p2[miss] = _find(model["p1"], _mix(w[miss]), model["unknown"])[1] + _find(model["g1"], _mix(v[miss]), 0.0)[1]
    p[at] = p2 + _find(model["g2"], _mix(u, v), 0.0)[1]
    starts = np.concatenate([[0], ends[:-1]]) - 2 * np.arange(len(ends))
    return np.add.reduceat(p, starts)


def perplexities(docs: DataFrame, model: dict | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, n_tokens, log10_prob)`` for every row of ``docs`` under the model, which may be None."""

    def make():
        import xxhash
        seen: dict[bytes, int] = {}

        def key(word):
            k = xxhash.xxh64_intdigest(word, 42)  # Spark's xxhash64 of a string
            return k - (1 << 64) if k >> 63 else k

        def fn(col):
            n, logs = [], []
            batch, size = [], 0

            def flush():
                nonlocal batch, size
                if batch:
                    ends = np.cumsum([len(k) for k in batch])
                    logs.append(log10_probs(model, np.concatenate(batch), ends))
                    batch, size = [], 0
            for t in strings(col):
                words = t.encode("utf-8", "surrogatepass").split()
                n.append(len(words) + 1)
                if model is None:
                    continue
                if len(seen) > SEEN_WORDS:
                    seen.clear()
                for w in words:
                    if w not in seen:
                        seen[w] = key(w)
                k = np.empty(len(words) + 3, np.int64)
                k[:2], k[-1] = START_KEY, END_KEY
                k[2:-1] = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
                batch.append(k)
                size += len(k)
                if size > 50_000:
                    flush()
            flush()
            got = pa.nulls(len(n), pa.float64()) if model is None else pa.array(np.concatenate(logs), pa.float64())
            return [pa.array(n, pa.int64()), got]
        return fn
    return map_columns(packed(docs, text_col, keep=keep), [f"in_{text_col}"],
                       [T.StructField("n_tokens", T.LongType()), T.StructField("log10_prob", T.DoubleType())], make)


def thresholds(calibration: DataFrame, quantile: float, slack: float, min_calibration: int) -> DataFrame:
    """``(lang, mean, threshold)`` from scored calibration rows ``(lang, n_tokens, log10_prob)``; a row per
    language with at least ``min_calibration`` of them, and one with ``lang`` = null and ``every`` = true for all."""
    cal = calibration.select("lang", "n_tokens", (-F.col("log10_prob")).alias("cost"))

    def of(rows, by):
        mean = rows.groupBy(*by).agg((F.sum("cost") / F.sum("n_tokens")).alias("mean"), F.count(F.lit(1)).alias("n"))
        drawn = ((F.col("cost") + PSEUDO_WORDS * F.col("mean")) / (F.col("n_tokens") + PSEUDO_WORDS))
        joined = rows.join(F.broadcast(mean.withColumnRenamed("lang", "l")), F.col("lang").eqNullSafe(F.col("l"))) if by \
            else rows.crossJoin(F.broadcast(mean))  # one row
        return joined.groupBy(*by).agg(F.first("mean").alias("mean"), F.first("n").alias("n"),
                                       (F.percentile_approx(drawn, quantile, 100_000) * slack).alias("threshold"))
    return (of(cal, ["lang"]).where(F.col("n") >= min_calibration).select("lang", F.lit(False).alias("every"), "mean", "threshold")
            .unionByName(of(cal, []).select(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every"), "mean",
                                            "threshold")))


def classify(docs: DataFrame, labels: DataFrame, max_docs: int | None = None, max_words: int | None = None, quantile: float = 0.995,
             slack: float = 1.05, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             keep: list[str] | None = None, min_calibration: int = 1) -> DataFrame:
    """``(row, n_tokens, log10_prob, perplexity, threshold, kept)`` for every row of ``docs``;
    ``threshold`` is the perplexity limit of the row's language: its own from ``min_calibration`` trusted
    documents up, else that of all languages.  Without ``max_docs`` and ``max_words`` the model learns from every second of
    all trusted documents."""
    spark = docs.sparkSession
    limits = []
    with scope(spark) as own:  # only the scored rows outlive it
        trusted = staged(trusted_ids(labels), "kn-labels")
        if max_docs is None and max_words is None:
            sample = training_half(docs, trusted, id_col, text_col, lang_col)
        else:
            sample = training_sample(docs, trusted, MAX_DOCS if max_docs is None else max_docs, MAX_WORDS if max_words is None else max_words,
                                     id_col, text_col, lang_col)
        sample = staged(sample, "kn-sample")
        learned = staged(sample.select("id"), "kn-learned")
        model = train(sample.select("text"))
        unstaged(sample)
        columns = list(dict.fromkeys([*(docs.columns if keep is None else keep), id_col, lang_col]))
        rows = perplexities(docs, model, text_col, columns)
        if model is not None:
            rows = own.hand_over(staged(rows, "kn-scored"))
            scored = (rows.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{lang_col}`").cast("string").alias("lang"),
                                  "n_tokens", "log10_prob")
                      .join(trusted, "id", "left_semi").join(learned, "id", "left_anti"))
            limits = thresholds(scored, quantile, slack, min_calibration).collect()  # a row per language
    by_lang = spark.createDataFrame([(r["lang"], r["mean"], r["threshold"]) for r in limits if not r["every"]],
                                    "l string, mean double, lim double")
    whole = next(((r["mean"], r["threshold"]) for r in limits if r["every"]), (None, None))
    mean = F.coalesce("mean", F.lit(whole[0]).cast("double"))
    limit = F.coalesce("lim", F.lit(whole[1]).cast("double"))
    drawn = (PSEUDO_WORDS * mean - F.col("log10_prob")) / (F.col("n_tokens") + PSEUDO_WORDS)
    lang = F.col(f"row.`{lang_col}`").cast("string")
    return (rows.join(F.broadcast(by_lang), lang.eqNullSafe(F.col("l")), "left")
            .select("row", "n_tokens", "log10_prob",
                    F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")).alias("perplexity"),
                    F.pow(F.lit(10.0), drawn).alias("drawn_perplexity"), F.pow(F.lit(10.0), limit).alias("threshold"),
                    F.coalesce(drawn <= limit, F.lit(True)).alias("kept")))


def quality_filter(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns unchanged."""
    return classify(docs, labels, **options).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
