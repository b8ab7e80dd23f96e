"""Independent versions of what the operators compute beyond their counts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, curriculum, kneser_ney, quality_rules, token_files, winnowing
from quarry.llm.common import work_dir

DOCS = "doc_id long, text string, lang string, source string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS)


def test_long_words_fold_like_short_ones():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for n in (1, 2, 5, 40, 101, 700, 3000):
        for letters in ("ab", "a", "etaoin shrdlu", "thengi"):
            word = "".join(rng.choice(letters) for _ in range(n))
            want = enc.encode_ordinary(word)
            assert byte_bpe.fold_long(word.encode(), ranks) == want == byte_bpe.fold(word.encode(), ranks) or word.encode() in ranks
    text = "".join(rng.choice("abcdefghij") for _ in range(300_000))  # a third of a megabyte without a space
    assert byte_bpe.fold(text.encode(), ranks) == enc.encode_ordinary(text)


def test_round_trip_digests_equal_tiktoken(spark):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = [None, "", "Hello, world!  It's 3.14\n\n\tok", "日本語 é\U0001F600", "x" * 3000, "a" * 150 + " b", "<|endoftext|>"]
    got = byte_bpe.round_trip_digests(docs_of(spark, texts), path, public_tokenizers.PATTERN).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    for r in got.collect():
        t = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_token_files_with_the_library_s_added_tokens(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ["<|endoftext|> again", "a<|endoftext|><|endoftext|>b  c", "none", "<|endoftext", None, ""]
    got = token_files.write_corpus(docs_of(spark, texts), work_dir(spark, "t9s"), path, public_tokenizers.PATTERN, 2, added_tokens=True).collect()
    at = 0
    assert tok.encode(texts[0], add_special_tokens=False).ids[0] == 50256
    for r in sorted(got, key=lambda r: r.doc_id):
        ids = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_documents_without_a_position_spread_over_the_sorted_ranges(spark):
    docs = spark.createDataFrame([(i, "w " * 20, "en", "s") for i in range(3000)], DOCS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = curriculum.mix(docs, [1], budget=0.1)
        parts = Counter(r["p"] for r in out.select("size", F.spark_partition_id().alias("p")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.where("size(positions) = 0").count() > 2600 and max(parts.values()) < 1500 and out.columns[-1] == "positions"


def brute_kn(texts):
    """Interpolated modified Kneser-Ney by definition: a function from (u, v, w) to a probability."""
    seqs = [["<s>", "<s>", *t.split(), "</s>"] for t in texts]
    tri = Counter(tuple(s[i:i + 3]) for s in seqs for i in range(len(s) - 2))
    bi = Counter(k[1:] for k in tri)
    uni = Counter(k[1:] for k in bi)

    def discount(counts):
        n = [sum(1 for c in counts.values() if c == i) for i in range(5)]
        if not (n[1] and n[2]):
            return (0.5, 0.5, 0.5)
        y = n[1] / (n[1] + 2 * n[2])
        d = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 0.5)
        return tuple(min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1))
    ds = [discount(c) for c in (uni, bi, tri)]

    def level(counts, d, gram, low):
        context = gram[:-1]
        followers = {k: c for k, c in counts.items() if k[:-1] == context}
        if not followers:
            return low
        total = sum(followers.values())
        c = followers.get(gram, 0)
        off = d[min(c, 3) - 1] if c else 0
        return (c - off) / total + sum(d[min(x, 3) - 1] for x in followers.values()) / total * low
    return lambda u, v, w: level(tri, ds[2], (u, v, w), level(bi, ds[1], (v, w), level(uni, ds[0], (w,), 1 / (len(uni) + 1))))


def test_perplexities_equal_the_definition(spark):
    rng = random.Random(6)
    pool = [f"w{i}" for i in range(12)]
    learned = [" ".join(rng.choices(pool, weights=range(1, 13), k=rng.randint(1, 25))) for _ in range(60)]
    scored = learned[:5] + [" ".join(rng.choices([*pool, "new", "other"], k=12)) for _ in range(15)] + ["", None, "w1", "new new"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in learned], "text string"))
    got = kneser_ney.perplexities(docs_of(spark, scored), model).select("row.doc_id", "n_tokens", "log10_prob").collect()
    p = brute_kn(learned)
    for r in got:
        s = ["<s>", "<s>", *(scored[r.doc_id] or "").split(), "</s>"]
        want = sum(np.log10(p(*s[i:i + 3])) for i in range(len(s) - 2))
        assert r.n_tokens == len(s) - 2 and abs(r.log10_prob - want) < 1e-4 * max(1, abs(want))


def test_thresholds_equal_quantiles_of_every_language(spark):
    rng = np.random.default_rng(2)
    rows = [(g, int(rng.integers(1, 80)), -float(rng.gamma(9, 3))) for g in ["a"] * 400 + ["b"] * 7 + [None] * 60]
    cal = spark.createDataFrame(rows, "lang string, n_tokens long, log10_prob double")
    out = {(r.lang, r.every): r for r in kneser_ney.thresholds(cal, 0.9, 1.05, 1).collect()}
    assert set(out) == {("a", False), ("b", False), (None, False), (None, True)}
    for (lang, every), r in out.items():
        own = [(n, -x) for g, n, x in rows if every or g == lang]
        mean = sum(c for _, c in own) / sum(n for n, _ in own)
        drawn = sorted((c + kneser_ney.PSEUDO_WORDS * mean) / (n + kneser_ney.PSEUDO_WORDS) for n, c in own)
        assert abs(r["mean"] - mean) < 1e-9 and abs(r.threshold - 1.05 * drawn[int(np.ceil(0.9 * len(drawn))) - 1]) < 1e-9
    few = kneser_ney.thresholds(cal, 0.9, 1.05, 30).collect()
    assert {r.lang for r in few if not r.every} == {"a", None}


def brute_em(patterns, rounds=3000):
    """The same mixture of independent voters, document by document."""
    m = len(quality_rules.RULES)
    docs = [[code // 3 ** j % 3 for j in range(m)] for code, n in patterns for _ in range(n)]
    start = {quality_rules.GOOD: 0.97, quality_rules.BAD: 0.5}
    right = {c: [start[c]] * m for c in start}
    share, extra, last = 0.85, 0.05 * len(docs), None
    for _ in range(rounds):
        post = []
        for d in docs:
            like = {c: (share if c == quality_rules.GOOD else 1 - share) * np.prod(
                [1.0 if v == quality_rules.ABSTAIN else right[c][j] if v == c else 1 - right[c][j] for j, v in enumerate(d)]) for c in start}
            post.append(like[quality_rules.GOOD] / sum(like.values()))
        for c in start:
            w = post if c == quality_rules.GOOD else [1 - x for x in post]
            for j in range(m):
                hit = sum(x for x, d in zip(w, docs) if d[j] == c)
                cast = sum(x for x, d in zip(w, docs) if d[j] != quality_rules.ABSTAIN)
                right[c][j] = (hit + extra * start[c]) / (cast + extra)
        share = (sum(post) + 0.85 * extra) / (len(docs) + extra)
        if last is not None and max(abs(a - b) for a, b in zip(post, last)) < 1e-9:
            break
        last = post
    return {tuple(d): x for d, x in zip(docs, post)}


def test_posteriors_equal_em_over_single_documents():
    rng = random.Random(8)
    m = len(quality_rules.RULES)
    patterns = Counter()
    for _ in range(120):
        bad = rng.random() < 0.3
        patterns[sum((quality_rules.ABSTAIN if rng.random() < 0.2 else quality_rules.BAD if rng.random() < (0.5 if bad else 0.05)
                      else quality_rules.GOOD) * 3 ** j for j in range(m))] += 1
    _, _, posterior = quality_rules.fit(sorted(patterns.items()))
    want = brute_em(sorted(patterns.items()))
    for code, p in posterior.items():
        assert abs(p - want[tuple(code // 3 ** j % 3 for j in range(m))]) < 1e-6


def test_quality_fit_says_when_it_has_not_converged():
    with pytest.raises(RuntimeError):
        quality_rules.fit([(0, 5), (1, 3), (3 ** 4, 2), (2 * 3 ** 3 + 1, 4)], rounds=2)


def test_likeness_of_fingerprints(spark):
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60", "changed")
    other = " ".join(f"else{i}" for i in range(120))
    rows = winnowing.edited_likeness(docs_of(spark, [other, near, base])).collect()
    got = {r.doc_id: r for r in rows}
    assert got[2].near_next > 0.8 and got[1].near_next < 0.05  # next by descending id
    assert all(0.4 < r.near_edited < 1 for r in rows)
    same = winnowing.edited_likeness(docs_of(spark, [base, base])).collect()
    assert all(r.near_next == 1.0 for r in same) and same[0].fingerprint == same[1].fingerprint
    assert re.fullmatch(r"[a-z0-9 ]+", base)
