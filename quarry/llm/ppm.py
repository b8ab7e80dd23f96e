"""Prediction by partial matching: code length of texts under a byte-context trie.

The trie counts, for every context of up to ``order`` bytes, the bytes that
followed it in the training texts.  A byte is predicted by the longest context
of the trie that ends at it; a byte new to a context costs an escape and goes
on to the next shorter context, from which the bytes already offered are
excluded.  Escapes use method C (as many escape counts as there are different
followers, excluded ones left out).  What the empty context doesn't know is
uniform over the byte values left.

A text is scored as its token sequence: ASCII letters in lower case, words
joined by one space, then an end symbol (byte 0xFF, which UTF-8 never uses);
it starts from ``order`` start symbols (0xFE).

At scale: no task holds the whole trie and no gram of it is left out.  Texts go
in portions of about ``PORTION`` bytes; a portion's different grams of the
highest order, with their counts in its training texts, are dealt out by the
last ``NEAR`` bytes of the context.  So one shard has all counts of the orders
``NEAR`` and up that its grams need, and it answers every portion with the log
probabilities of the portion's grams.  Grams of the orders below ``NEAR`` have
``NEAR`` bytes at most, a bound of the alphabet and not of the corpus; their
counts are broadcast.  The number of shards grows with the text.

The word-count base (:func:`base_table`, :func:`base_scores`) joins counts on
the words: the ``HOT`` most frequent (a bounded list) are looked up in place, so
that no joined key holds more than a ``1 / HOT`` share of all tokens; all other
words, one row per text and word, meet their counts in a shuffled join.

Defined results: a null or blank text is the end symbol alone; equal texts
score equally; an empty table gives an empty result; without training texts
every byte costs log(256).  Words are keyed by 64-bit hash.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import small_batches, staged, strings
from quarry.llm.pretokens import newest

START, END = 0xFE, 0xFF
END_WORD = b"\n"  # no word holds a line end
HOT = 1 << 16
CHUNK = 1 << 20
NEAR = 3  # grams of so many bytes are few in any corpus
PORTION = 24 << 20
MIN_SHARDS = 48
SHARD = 16 << 20  # bytes of text for which there is one shard


def tokens(text: str) -> list[bytes]:
    """Words of the lower-cased (A-Z) text; white space is \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_keys(words) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def grams(buffer: bytes, order: int) -> np.ndarray:
    """Packed grams (followed byte lowest) at every byte of the buffer that isn't a start symbol."""
    b = np.frombuffer(buffer, np.uint8)
    key = b[order:].astype(np.uint64)
    for j in range(1, order + 1):
        key |= b[order - j:len(b) - j].astype(np.uint64) << np.uint64(8 * j)
    return key[b[order:] != START]


class GramCounts:
    """Distinct grams of one portion with their counts, merged while the portion is read.

    Sorted runs are merged whenever a newer one has grown to half of the one before it, so at most
    about twice the distinct grams are held, twelve bytes each, and not the grams of every stretch.
    """

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.runs.append((keys, n.astype(np.uint32)))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) >= len(self.runs[-2][0]):
            self._merge()

    def _merge(self) -> None:
        (a, n), (b, m) = self.runs.pop(), self.runs.pop()
        self.runs.append(_summed(np.concatenate([a, b]), np.concatenate([n, m])))

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        while len(self.runs) > 1:
            self._merge()
        return self.runs.pop() if self.runs else (np.empty(0, np.uint64), np.empty(0, np.uint32))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def packed_grams(keys: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of every key, byte by byte; sorted keys so compress well."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked_grams(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def shard_of(keys: np.ndarray, order: int, shards: int) -> np.ndarray:
    """The shard of each gram, by the bytes next to the one that follows."""
    near = (keys >> np.uint64(8)) & np.uint64((1 << (8 * min(NEAR, order))) - 1)
    return (((near * _MIX) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


# --- counting --------------------------------------------------------------------------------

WORD_COUNT, NEAR_COUNT, GRAMS, TEXT = range(4)


def portions_of(rows: DataFrame, order: int, shards: int, portion: int) -> DataFrame:
    """What one reading of ``(id, held_out, text)`` gives, by ``kind``: partial counts ``(key, n)`` of words and of
    grams of ``NEAR`` bytes (training texts); ``(portion, shard, grams, counts)``, the different grams of a portion's
    texts with their counts in its training texts; and ``(portion, id, held_out, words)``, the texts."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("portion", T.LongType()),
                           T.StructField("shard", T.IntegerType()), T.StructField("key", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("grams", T.BinaryType()),
                           T.StructField("counts", T.BinaryType()), T.StructField("words", T.BinaryType()),
                           rows.schema["id"], T.StructField("held_out", T.BooleanType())])
    small_batches(rows.sparkSession)
    near = min(NEAR, order)

    def run(batches):
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        done = size = 0
        words: Counter = Counter()
        found = GramCounts()
        pad = bytes([START]) * order
        buffers: dict[bool, list[bytes]] = {False: [], True: []}
        sizes = {False: 0, True: 0}
        id_type = None

        def batch(kind, length, **columns):
            kinds = {"portion": pa.int64(), "shard": pa.int32(), "key": pa.int64(), "n": pa.int64(), "grams": pa.binary(),
                     "counts": pa.binary(), "words": pa.binary(), "id": id_type, "held_out": pa.bool_()}
            got = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns
                   else pa.nulls(length, t) for c, t in kinds.items()]
            return pa.RecordBatch.from_arrays([pa.array(np.full(length, kind, np.int32)), *got], names=schema.fieldNames())

        def flush(held):
            if buffers[held]:
                keys, n = np.unique(grams(b"".join(buffers[held]), order), return_counts=True)
                found.add(keys, n * (not held))
                buffers[held].clear()
                sizes[held] = 0

        def word_counts():
            out = batch(WORD_COUNT, len(words), key=word_keys(list(words)), n=np.fromiter(words.values(), np.int64, len(words)))
            words.clear()
            return out

        def close():
            nonlocal done, size
            flush(False)
            flush(True)
            keys, n = found.take()
            mask = np.uint64((1 << (8 * near)) - 1)
            lows = GramCounts()
            for i in range(0, len(keys), CHUNK):
                seen = n[i:i + CHUNK] > 0
                lows.add(*_summed(keys[i:i + CHUNK][seen] & mask, n[i:i + CHUNK][seen]))
            low, low_n = lows.take()
            yield batch(NEAR_COUNT, len(low), key=low.view(np.int64), n=low_n.astype(np.int64))
            shard = np.concatenate([shard_of(keys[i:i + CHUNK], order, shards).astype(np.int32) for i in range(0, len(keys), CHUNK)])
            rank = np.argsort(shard, kind="stable")  # the grams of a shard stay sorted
            ends = np.flatnonzero(np.diff(shard[rank], append=-1)) + 1
            start = 0
            while start < len(ends):  # some shards at a time, so that their packed form is never held whole
                stop = start + max(1, int(np.searchsorted(ends[start:], (ends[start - 1] if start else 0) + CHUNK)))
                pieces = [rank[i:j] for i, j in zip([ends[start - 1] if start else 0, *ends[start:stop - 1]], ends[start:stop])]
                yield batch(GRAMS, len(pieces), portion=np.full(len(pieces), first + done), shard=shard[[x[0] for x in pieces]],
                            grams=[packed_grams(keys[x], order + 1) for x in pieces],
                            counts=[packed_grams(n[x], 4) for x in pieces])
                start = stop
            done, size = done + 1, 0

        for b in batches:
            ids, held, texts = b.column("id"), b.column("held_out").to_pylist(), strings(b.column("text"))
            id_type = ids.type
            start, bodies = 0, []
            for i, text in enumerate(texts):
                w = tokens(text)
                body = b" ".join(w)
                bodies.append(body)
                if not held[i]:
                    words.update(w)
                    words[END_WORD] += 1
                buffers[held[i]].append(pad + body + bytes([END]))
                sizes[held[i]] += len(body) + 1
                size += len(body) + 1
                if sizes[held[i]] > CHUNK:
                    flush(held[i])
                if size > portion or i + 1 == len(texts):
                    yield batch(TEXT, len(bodies), portion=np.full(len(bodies), first + done), words=bodies,
                                id=ids.slice(start, len(bodies)), held_out=held[start:i + 1])
                    start, bodies = i + 1, []
                if size > portion:
                    yield from close()
                if len(words) > 250_000:
                    yield word_counts()
        if size:
            yield from close()
        if words:
            yield word_counts()

    return rows.mapInArrow(run, schema)


def near_entries(counts: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The grams and counts of the orders below ``NEAR``, from the counts ``(key, n)`` of those of ``NEAR`` bytes."""
    got = counts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most 256 ** NEAR
    level = _summed(got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy())
    out = []
    for d in range(min(NEAR, order) - 1, -1, -1):
        level = _summed(level[0] & np.uint64((1 << (8 * (d + 1))) - 1), level[1])
        out.append(level)
    return out[::-1]


def far_entries(keys: np.ndarray, n: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The grams and counts of the orders from ``NEAR`` up of one shard, from those of the highest order."""
    level = (keys, n)
    out = [level]
    for d in range(order - 1, min(NEAR, order) - 1, -1):
        level = _summed(level[0] & np.uint64((1 << (8 * (d + 1))) - 1), level[1])
        out.append(level)
    return out[::-1]


def answers(asked: DataFrame, near: list[tuple[np.ndarray, np.ndarray]], order: int) -> DataFrame:
    """``(portion, grams, logs)``: natural log probabilities of the grams that each portion has, shard by shard."""
    schema = T.StructType([T.StructField("portion", T.LongType()), T.StructField("grams", T.BinaryType()),
                           T.StructField("logs", T.BinaryType())])
    shared = asked.sparkSession.sparkContext.broadcast(near)

    def answer(table):
        lists = [unpacked_grams(x, order + 1) for x in table.column("grams").to_pylist()]
        n = np.concatenate([unpacked_grams(x, 4) for x in table.column("counts").to_pylist()]).astype(np.int64)
        keys, n = _summed(np.concatenate(lists), n)
        seen = n > 0
        trie = Trie([*shared.value, *far_entries(keys[seen], n[seen], order)])
        logs = trie.log_probs(keys).astype("<f4")
        return pa.table([table.column("portion"), table.column("grams"),
                         pa.array([logs[np.searchsorted(keys, k)].tobytes() for k in lists], pa.binary())],
                        names=schema.fieldNames())
    return asked.select("portion", "shard", "grams", "counts").groupBy("shard").applyInArrow(answer, schema)


# --- the model -------------------------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Slots:
    """Open addressing from grams to 32-bit values, three quarters full at most."""

    def __init__(self, keys: np.ndarray, value: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 4 / 3))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.value = np.zeros(1 << bits, np.float32)
        at = ((keys * _MIX) >> self.shift).astype(np.int64)
        todo, self.probes, mask = np.arange(len(keys)), 0, (1 << bits) - 1
        while len(todo):
            self.probes += 1
            free = self.slots[at[todo]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            spot, who = np.unique(at[todo[free]], return_index=True)
            put = todo[free][who]
            self.slots[spot], self.value[spot] = keys[put], value[put]
            done = np.zeros(len(keys), bool)
            done[put] = True
            todo = todo[~done[todo]]
            at[todo] = (at[todo] + 1) & mask

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each gram is here, and its value or 0."""
        out = np.zeros(len(key))
        at = ((key * _MIX) >> self.shift).astype(np.int64)
        hit = self.slots[at] == key
        out[hit] = self.value[at[hit]]
        probe = np.flatnonzero(~hit)
        for _ in range(1, self.probes):
            at[probe] = (at[probe] + 1) & (len(self.slots) - 1)
            got = self.slots[at[probe]] == key[probe]
            out[probe[got]] = self.value[at[probe[got]]]
            hit[probe[got]] = True
            probe = probe[~got]
        return hit, out


class Trie:
    """Log probabilities (natural) from the counted grams of every order."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(entries) - 1
        self.keys = [k for k, _ in entries]
        counts = [n.astype(np.float64) for _, n in entries]
        self.log_count = [np.log(n) for n in counts]
        self.nodes, self.log_top_den, self.log_top_esc, self.log_den, self.log_esc = [], [], [], [], []
        total_below = kinds_below = None
        for d, (keys, n) in enumerate(zip(self.keys, counts)):
            context = keys >> np.uint64(8)
            nodes, first = np.unique(context, return_index=True)
            total = np.add.reduceat(n, first) if len(first) else np.empty(0)
            kinds = np.diff(np.append(first, len(keys))).astype(np.float64)
            self.nodes.append(nodes)
            self.log_top_den.append(np.log(total + kinds))
            self.log_top_esc.append(np.log(kinds) - np.log(total + kinds))
            if d:
                # the shorter context without the followers that this one has offered
                low = np.searchsorted(self.keys[d - 1], keys & np.uint64((1 << (8 * d)) - 1))
                offered = np.add.reduceat(counts[d - 1][low], first) if len(first) else np.empty(0)
                below = np.searchsorted(self.nodes[d - 1], nodes & np.uint64((1 << (8 * (d - 1))) - 1))
                left, new = total_below[below] - offered, kinds_below[below] - kinds
                with np.errstate(divide="ignore"):
                    den = np.log(left + new)
                    self.log_den.append(np.where(new > 0, den, 0.0))
                    self.log_esc.append(np.where(new > 0, np.log(new) - np.where(new > 0, den, 0.0), 0.0))
            else:
                self.log_den.append(np.zeros(len(nodes)))
                self.log_esc.append(np.zeros(len(nodes)))
            total_below, kinds_below = total, kinds
        self.log_rest = -np.log(256.0 - len(self.keys[0])) if len(self.keys[0]) < 256 else 0.0
        top, nodes = self.keys[-1], self.nodes[-1]
        self.top = Slots(top, (self.log_count[-1] - self.log_top_den[-1][np.searchsorted(nodes, top >> np.uint64(8))])
                         if len(top) else np.empty(0))

    def log_probs(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of every gram's last byte after its context."""
        hit, out = self.top.find(key)
        rest = np.flatnonzero(~hit)
        above = np.full(len(rest), -1)
        for d in range(self.order, -1, -1):
            if not len(rest):
                break
            k, nodes, keys = key[rest], self.nodes[d], self.keys[d]
            if not len(nodes):
                continue
            context = (k >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)
            node = np.minimum(np.searchsorted(nodes, context), len(nodes) - 1)
            known = nodes[node] == context
            if d == self.order:
                found = np.zeros(len(rest), bool)  # those were answered above
                gram = np.zeros(len(rest), np.int64)
            else:
                want = k & np.uint64((1 << (8 * (d + 1))) - 1)
                gram = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                found = keys[gram] == want
            inner = above >= 0
            add = np.zeros(len(rest))
            one = inner & found
            if d < self.order:
                add[one] = self.log_count[d][gram[one]] - self.log_den[d + 1][above[one]]
                one = inner & ~found
                add[one] = self.log_esc[d + 1][above[one]]
            one = ~inner & found
            add[one] = self.log_count[d][gram[one]] - self.log_top_den[d][node[one]]
            one = ~inner & known & ~found
            add[one] = self.log_top_esc[d][node[one]]
            out[rest] += add
            rest, above = rest[~found], np.where(known, node, -1)[~found]
        out[rest] += self.log_rest
        return out


def text_scores(logs_of: Slots, bodies: list[bytes], order: int) -> np.ndarray:
    """log10 probability of each text's words with its end symbol, from the logs of all their grams."""
    pad, end = bytes([START]) * order, bytes([END])
    bodies = [x + end for x in bodies]
    hit, logs = logs_of.find(grams(b"".join(pad + x for x in bodies), order))
    if not hit.all():
        raise ValueError("a gram of the portion was not answered")
    starts = np.cumsum([0, *map(len, bodies[:-1])])
    return np.add.reduceat(logs, starts) / np.log(10.0)


def portions(texts: list, chars: int = CHUNK):
    """Stretches of a list of texts of about so many characters or bytes, each text whole."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > chars:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


# --- scoring ---------------------------------------------------------------------------------

def score_texts(docs: DataFrame, train_when, order: int = 5, id_col: str = "doc_id", text_col: str = "text",
                portion: int = PORTION, shard: int = SHARD) -> DataFrame:
    """Score every row of ``docs`` after learning from those where ``train_when`` (a column) is true.

    Returns ``(<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score)``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       (~F.coalesce(train_when, F.lit(False))).alias("held_out"))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    read = staged(portions_of(rows, order, MIN_SHARDS + text_bytes // shard, portion), "ppm-portions", compression="zstd")
    words = staged(read.where(F.col("kind") == WORD_COUNT).groupBy("key").agg(F.sum("n").alias("c")), "ppm-words")
    total = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    n_train, n_words = total[0] or 0, total[1]
    base_den = float(np.log10(n_train + n_words + 1))
    hot = words.orderBy(F.desc("c"), "key").limit(HOT).toArrow()  # a bounded list
    shared = spark.sparkContext.broadcast((hot.column("key").to_numpy(), hot.column("c").to_numpy()))
    near = near_entries(read.where(F.col("kind") == NEAR_COUNT).select("key", "n"), order)
    answered = answers(read.where(F.col("kind") == GRAMS), near, order)
    call = uuid.uuid4().hex

    def hot_words():
        keys, c = shared.value
        return dict(zip(keys.tolist(), (np.log10(c + 1.0) - base_den).tolist())), {}

    def score(texts, answer):
        from collections import Counter as Count
        hot_logs, seen = newest("ppm-hot", call, hot_words)
        scores, n_tokens, known, base, cold_keys, cold_n = [], [], [], [], [], []

        def one(w):
            """The base of one text: hot words at once, the others as arrays for the join."""
            tf = Count(w)
            tf[END_WORD] += 1
            new = [x for x in tf if x not in seen]
            if len(seen) + len(new) > 300_000:
                seen.clear()
                new = list(tf)
            seen.update(zip(new, word_keys(new).tolist()))
            total_log, k, ck, cn = 0.0, 0, [], []
            for x, m in tf.items():
                log = hot_logs.get(key := seen[x])
                if log is None:
                    ck.append(key)
                    cn.append(m)
                else:
                    total_log += m * log
                    k += m
            n_tokens.append(len(w) + 1)
            known.append(k)
            base.append(total_log)
            cold_keys.append(np.array(ck, np.int64))
            cold_n.append(np.array(cn, np.int32))

        logs_of = Slots(np.concatenate([unpacked_grams(x, order + 1) for x in answer.column("grams").to_pylist()]),
                        np.concatenate([np.frombuffer(x, "<f4") for x in answer.column("logs").to_pylist()]))
        for part in portions(texts.column("words").to_pylist()):
            scores.append(text_scores(logs_of, part, order))
            for body in part:
                one(body.split())
        return pa.table([texts.column("id"), texts.column("held_out"), pa.array(n_tokens, pa.int64()),
                         pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                         pa.array(np.concatenate(scores), pa.float64()), pa.array(cold_keys, pa.list_(pa.int64())),
                         pa.array(cold_n, pa.list_(pa.int32()))], names=schema.fieldNames())

    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("hot_known", T.LongType()),
                           T.StructField("hot_base", T.DoubleType()), T.StructField("score", T.DoubleType()),
                           T.StructField("cold", T.ArrayType(T.LongType())),
                           T.StructField("cold_n", T.ArrayType(T.IntegerType()))])
    texts = read.where(F.col("kind") == TEXT).select("portion", "id", "held_out", "words")
    scored = texts.groupBy("portion").cogroup(answered.groupBy("portion")).applyInArrow(score, schema)
    scored = staged(scored.withColumn("rid", F.monotonically_increasing_id()), "ppm-scored")
    cold = (scored.select("rid", F.explode(F.arrays_zip("cold", "cold_n")).alias("z"))
            .select("rid", F.col("z.cold").alias("key"), F.col("z.cold_n").alias("m")))
    per_row = (cold.join(words, "key", "left").groupBy("rid")
               .agg(F.sum(F.when(F.col("c").isNotNull(), F.col("m")).otherwise(0)).alias("cold_known"),
                    F.sum(F.col("m") * (F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0)) - base_den)).alias("cold_base")))
    return (scored.drop("cold", "cold_n").join(per_row, "rid", "left")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens",
                    (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("hot_base") + F.coalesce("cold_base", F.lit(0.0))).alias("base_score"), "score"))
