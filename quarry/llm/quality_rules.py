"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at one document and votes "good", "bad" or abstains.  The
votes of a document form a pattern; with ``m`` rules there are at most ``3**m``
patterns (6,561 for the eight rules here), so the pattern counts are a bounded
sufficient statistic.  Expectation-maximisation over the counted patterns
estimates the share of good documents and how often each rule's votes are
right on good and on bad documents; an abstention says nothing.  A document is
kept when the posterior probability of "good" given its votes reaches
``min_posterior``.  No rule rejects a document by itself, except the base rule.

Feature extraction is row-local; the only shuffle is the partially aggregated
count per pattern.  The fitted table (a row per pattern) is broadcast: its
bound is the number of patterns, whatever the input.

Defined results: a null or blank text has no words (all counts 0) and fails
the base rule; repeated rows are judged each on their own, alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_columns, packed, staged, strings

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
GOOD, BAD, ABSTAIN = 1, 0, 2

#: Common function words of the four languages.
FUNCTION_WORDS = frozenset((
    "the of and to in a is that it for on was be with as at by from this are "
    "de la le les et des en un une du que dans pour qui est pas par sur au avec "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "el y los del se las por para con una su lo como más o").split())
_FUNCTION_BYTES = frozenset(w.encode() for w in FUNCTION_WORDS)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_marks",
          "n_other", "n_function", "n_distinct")

#: (rule, feature, votes good up to, votes bad from); between the two it abstains.
RULES = (
    ("symbols", "symbol_ratio", 0.02, 0.10),
    ("not_letters", "other_ratio", 0.08, 0.15),
    ("few_function_words", "content_ratio", 0.80, 0.92),
    ("repeated_windows", "repeat_ratio", 0.10, 0.30),
    ("repeated_words", "stutter_ratio", 0.60, 0.80),
    ("duplicate_lines", "dup_line_ratio", 0.10, 0.30),
    ("capitals", "upper_ratio", 0.10, 0.40),
    ("exclamations", "mark_ratio", 0.05, 0.40),
)


def repeated_words(words: list) -> int:
    """Words inside a 3-word window that is found twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    first: dict = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, n)  # place of the first equal word
    _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, inverse, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    mask = np.zeros(n, bool)
    mask[:-2] |= hit
    mask[1:-1] |= hit
    mask[2:] |= hit
    return int(mask.sum())


def text_counts(text: str) -> tuple:
    """The counts of :data:`COUNTS` for one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly \\x20 and \\x09-\\x0D
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    seen: set = set()
    dup = n_lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            n_lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    distinct = set(words)
    letters = sum(map(str.isalnum, text))
    return (len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), dup, repeated_words(words),
            sum(map(str.isupper, text)), n_lines, text.count("!"), len(text) - blanks - letters,
            sum(w in _FUNCTION_BYTES for w in words), len(distinct))


def features(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, <COUNTS>)``: the table's rows (of the columns ``keep``, or all) with their counts."""
    def make():
        def fn(col):
            rows = [text_counts(t) for t in strings(col)]
            return [pa.array(c, pa.int64()) for c in zip(*rows)]
        return fn
    return map_columns(packed(docs, text_col, keep=keep), [f"in_{text_col}"],
                       [T.StructField(c, T.LongType(), False) for c in COUNTS], make)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes() -> F.Column:
    """The vote pattern as one number in base 3."""
    w = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    ratio = {
        "symbol_ratio": F.col("n_symbols") / w,
        "other_ratio": F.col("n_other") / chars,
        "content_ratio": 1 - F.col("n_function") / w,
        "repeat_ratio": F.col("n_repeat_words") / w,
        # share of words that repeat an earlier one, less what longer texts do by themselves
        "stutter_ratio": (w - F.col("n_distinct")) / w / (F.log10(w + 10) / 3.0),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper_ratio": F.col("n_upper") / chars,
        "mark_ratio": F.col("n_marks") / w,
    }
    total = F.lit(0)
    for i, (_, feature, good, bad) in enumerate(RULES):
        v = F.when(ratio[feature] <= good, GOOD).when(ratio[feature] >= bad, BAD).otherwise(ABSTAIN)
        total = total + v * 3 ** i
    return total.cast("int")


def fit(patterns: list[tuple[int, int]], rounds: int = 5_000, tol: float = 1e-9, prior: float = 0.05):
    """EM over counted vote patterns.

    Returns ``(share_good, right, posterior by pattern)``; ``right[c][j]`` is the
    probability that a vote of rule ``j`` on a document of class ``c`` is right.
    Starts from rules that are nearly always right on good documents and half
    the time on bad ones (a bad document shows few faults at a time), and
    keeps pseudo-votes of that kind worth the share ``prior`` of all documents,
    so that the two classes can't change places.  Raises if posteriors still move after ``rounds`` rounds.
    """
    m = len(RULES)
    codes = np.array([p for p, _ in patterns], np.int64)
    n = np.array([c for _, c in patterns], float)
    start = np.empty((2, m))
    start[GOOD], start[BAD] = 0.97, 0.5
    right, share = start.copy(), 0.85
    if not len(codes):
        return share, right, {}
    votes_ = (codes[:, None] // 3 ** np.arange(m)) % 3
    extra = prior * n.sum()
    last = None
    for _ in range(rounds):
        logs = {}
        for c, p in ((BAD, 1 - share), (GOOD, share)):
            each = np.where(votes_ == c, np.log(right[c]), np.log1p(-right[c]))
            logs[c] = np.log(p) + np.where(votes_ == ABSTAIN, 0.0, each).sum(1)
        post = 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -700, 700)))
        for c, weight in ((BAD, n * (1 - post)), (GOOD, n * post)):
            hit = (weight[:, None] * (votes_ == c)).sum(0)
            cast = (weight[:, None] * (votes_ != ABSTAIN)).sum(0)
            right[c] = (hit + extra * start[c]) / (cast + extra)
        share = float(((n * post).sum() + 0.85 * extra) / (n.sum() + extra))
        if last is not None and np.abs(post - last).max() < tol:
            break
        last = post
    else:
        raise RuntimeError(f"the rules' accuracies have not settled within {rounds} rounds")
    return share, right, dict(zip(codes.tolist(), post.tolist()))


def judge(docs: DataFrame, text_col: str = "text", min_posterior: float = 0.5,
          keep: list[str] | None = None) -> DataFrame:
    """``(row, counts..., pattern, base_failed, posterior, kept)`` for every row of ``docs``."""
    spark = docs.sparkSession
    rows = staged(features(docs, text_col, keep).withColumn("pattern", votes()).withColumn("base_failed", base_failed()),
                  "quality-rules")
    counted = [(r["pattern"], r["n"]) for r in
               rows.where(~F.col("base_failed")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()]
    _, _, posterior = fit(sorted(counted))
    table = spark.createDataFrame(list(posterior.items()), "pattern int, posterior double")
    return (rows.join(F.broadcast(table), "pattern", "left")
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= F.lit(min_posterior))))


def quality_filter(docs: DataFrame, text_col: str = "text", min_posterior: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    return judge(docs, text_col, min_posterior).where("kept").select("row.*")
