"""Benchmark decontamination: windows of benchmark items are looked for in documents (built-in functions only).

Words.  Texts are lower-cased in A-Z and cut into words of ASCII digits,
ASCII letters and everything beyond ASCII.  A window is ``WINDOW`` consecutive
words of an item; an item with fewer words, but not none, is one window.

Search.  The distinct windows' hashes are broadcast, at most ``SET_ROWS`` of them
(16 bytes each) at a time; a larger benchmark is searched for in blocks of that
size, one scan each.  A scan explodes each text into its window starts and probes the set
inside one generated stage, so only hits leave it.  Hits carry the words of
their window and are verified by joining them with the benchmark's windows.

Results.  A text's hits overlap; the words in their union are the words hit.
Texts are known by their md5, and hits of equal texts are merged where they are
found, so a document that is repeated in a third of all rows is searched for
without a hot group.  Work after the scan grows with the hits.  A single text
has to fit into a task with an array of its words.

Defined results: a null or blank text has no words and no hits; a null item id is
an item of its own, listed as the empty string; items that share an id are one
item; empty or null items have no window; documents with equal or null ids keep
their rows apart; without documents the result is empty, without benchmark
every document is clean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged

WINDOW = 10
SET_ROWS = 1_000_000
#: The characters that separate words of lower-cased text, and a word of the text as it was.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; ``lower`` does the same, and faster, on texts that are ASCII throughout."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``(length, hash, window, item)``, distinct; ``window`` is the window's words with one space between them."""
    items = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), words(F.col(f"`{text_col}`")).alias("ws"))
    at = (items.where(F.size("ws") > 0).select("item", "ws", F.least(F.size("ws"), F.lit(width)).alias("length"))
          .select("item", "ws", "length", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("length") + 1)).alias("start")))
    part = F.slice("ws", F.col("start"), F.col("length"))
    return at.select("length", F.xxhash64(part).alias("hash"), F.array_join(part, " ").alias("window"), "item").distinct()


def _scan(texts: DataFrame, hashes: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``(key, start, length, window)`` of the window starts in ``(key, ws)`` whose hash is in the set."""
    starts = texts.select("key", "ws", F.posexplode_outer("ws").alias("start", "word")).drop("word")
    if len(lengths) == 1:
        starts = starts.withColumn("length", F.lit(lengths[0]))
    else:
        starts = starts.select("key", "ws", "start", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("length"))
    part = F.slice("ws", F.col("start") + 1, F.col("length"))
    probes = starts.where(F.col("start") + F.col("length") <= F.size("ws")).withColumn("hash", F.xxhash64(part))
    return (probes.join(F.broadcast(hashes), "hash", "left_semi")
            .select("key", "start", "length", F.array_join(part, " ").alias("window")))


def find_hits(docs: DataFrame, windows: DataFrame, text_col: str = "text", set_rows: int = SET_ROWS) -> DataFrame:
    """``(key, start, length, window)``: verified occurrences, once per distinct text.

    ``windows`` is a staged table of :func:`benchmark_windows`.
    """
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most as many as a window has words
    hashes = windows.select("hash").distinct()
    blocks = max(1, -(-hashes.count() // set_rows))
    texts = docs.select(text_key(F.col(f"`{text_col}`")).alias("key"), words(F.col(f"`{text_col}`")).alias("ws"))
    found = None
    for b in range(blocks if lengths else 0):
        own = hashes if blocks == 1 else hashes.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == b)
        hits = _scan(texts, own, lengths)
        found = hits if found is None else found.union(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], "key string, start int, length int, window string")
    return found.distinct().join(windows.select("length", "window").distinct(), ["length", "window"], "left_semi")


def spans(hits: DataFrame) -> DataFrame:
    """``(key, first, last, n)``: the hits of a text merged into spans of words ``first`` to before ``last``."""
    ordered = Window.partitionBy("key").orderBy("start", "end")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.select("key", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    parted = ends.withColumn("opens", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    numbered = parted.withColumn("span", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("key", "span").agg(F.min("start").alias("first"), F.max("end").alias("last")).drop("span")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  benchmark_text: str = "text", width: int = WINDOW, set_rows: int = SET_ROWS,
                  keep: list[str] | None = None) -> DataFrame:
    """``(row, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of ``docs``."""
    windows = staged(benchmark_windows(benchmark, id_col, benchmark_text, width), "decontamination-windows")
    hits = staged(find_hits(docs, windows, text_col, set_rows), "decontamination-hits")
    n_hit = spans(hits).groupBy("key").agg(F.sum(F.col("last") - F.col("first")).cast("long").alias("n_hit"))
    listed = (hits.select("key", "window").distinct().join(windows.select("window", "item"), "window").select("key", "item").distinct()
              .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    # a staged table, so that AQE can split the rows of a text with very many copies
    found = staged(n_hit.join(listed, "key").select("key", "n_hit", F.size("items").cast("long").alias("n_items"),
                                                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "decontamination-found")
    columns = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), text_key(F.col(f"`{text_col}`")).alias("key"),
                       F.size(words(F.col(f"`{text_col}`"))).cast("long").alias("n_words"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return rows.join(found, "key", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; ``options`` as of :func:`contamination`."""
    return contamination(docs, benchmark, **options).where(~F.col("contaminated")).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 benchmark_text: str = "text", width: int = WINDOW, set_rows: int = SET_ROWS) -> DataFrame:
    """``docs`` with every span of hit words cut out of the text; the separators around a span stay, those inside go."""
    windows = staged(benchmark_windows(benchmark, id_col, benchmark_text, width), "decontamination-windows")
    hits = find_hits(docs, windows, text_col, set_rows)
    cuts = staged(spans(hits).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("cuts")), "decontamination-cuts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key(F.col(f"`{text_col}`")).alias("key"))
    text = F.col(f"row.`{text_col}`")
    # separators and words in turn; word i stands at 2 i + 2 (counted from 1)
    parts = F.flatten(F.transform(F.arrays_zip(F.split(text, WORD).alias("sep"), F.regexp_extract_all(text, F.lit(f"({WORD})"), 1).alias("word")),
                                  lambda z: F.array(z["sep"], F.coalesce(z["word"], F.lit("")))))
    # what is kept lies between the end of one cut (or the start) and the start of the next (or the end)
    opens = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["last"]))
    closes = F.concat(F.transform("cuts", lambda c: c["first"]), F.array(F.floor((F.size("parts") - 1) / 2).cast("int")))
    pieces = F.zip_with(opens, closes, lambda a, z: F.array_join(F.slice("parts", 2 * a + 1, 2 * (z - a) + 1), ""))
    out = (rows.join(cuts, "key", "left").withColumn("parts", F.when(F.col("cuts").isNotNull(), parts))
           .withColumn("kept", F.when(F.col("cuts").isNull(), text).otherwise(F.array_join(pieces, ""))))
    return out.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
