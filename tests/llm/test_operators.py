"""The ten operators against brute force, round trips and edge cases, on small tables."""

import base64
import gzip
import hashlib
import io
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, curriculum, kneser_ney, ngram_join, ppm, quality_rules, sharding, token_files, warc,
                        winnowing)
from quarry.llm.common import work_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, pattern string"
TEXTS = ["", None, " ", "\n\n a  b\t c\x0b", "the quick brown fox", "the quick brown fox", "naïve café 日本語 – “x” 1½ ² Ⅳ",
         "a b c d e f g h i j " * 8, "x" * 5000, "I'm  we'll\r\n\r\n 's 's don't", "# | & <b> $5 100%",
         "one two three four five six seven eight nine ten\none two three four five six seven eight nine ten"]


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None, "r", "p")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(t):
    return (t or "").encode().split()


def test_byte_bpe_equals_tiktoken_and_round_trips(spark):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    docs = docs_of(spark, TEXTS)
    ids = byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in
           byte_bpe.decode_ids(ids, path, public_tokenizers.PATTERN).select("row.doc_id", "ids", "decoded").collect()}
    assert got == {i: (enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(TEXTS)}
    w = spark.createDataFrame([(x,) for x in (" thndones", "café", "日本", " the", "xxxxx", "", None)], "word string")
    assert all(r.ids == enc.encode_ordinary(r.word) for r in byte_bpe.encode_words(w, path).collect())
    assert byte_bpe.round_trip_digests(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_token_files_hold_every_id_in_order(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    texts = [*TEXTS, "<|endoftext|> again"]
    ids = [None, 7, 7, *range(20, 20 + len(texts) - 3)][::-1]
    folder = work_dir(spark, "t9")
    got = token_files.write_corpus(docs_of(spark, texts, ids), folder, path, public_tokenizers.PATTERN, 2).collect()
    spans = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in got)
    at, want = 0, Counter()
    for start, n, _, _ in spans:
        assert start == at
        at += n
    for i, t in zip(ids, texts):
        x = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want[(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))] += 1
    assert Counter((d, n, c) for _, n, d, c in spans) == want
    order = [d for _, _, d, _ in spans]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    empty = token_files.write_corpus(docs_of(spark, texts).limit(0), work_dir(spark, "t9e"), path, public_tokenizers.PATTERN, 2)
    assert empty.count() == 0


def test_quality_counts_by_brute_force(spark):
    texts = [*TEXTS, "To To To To end", "x y z x y z q", "a\nb\na\n \n \na", "a b c " * 60]
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(spark, texts)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w, seen, dup = words(t), set(), 0
        for line in t.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        n = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if n[tuple(w[k:k + 3])] > 1 for j in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), dup, len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.quality_filter(docs_of(spark, texts).limit(0)).count() == 0


def test_quality_rules_on_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality_rules.judge(docs, keep=["doc_id"]).where("not base_failed").select("row.doc_id", "kept").join(labels, "doc_id")
    by = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.01 * by[(1, True)] and by.get((0, True), 0) <= 0.1 * by[(0, False)]


def test_kneser_ney_probabilities_sum_to_one_and_classify(spark):
    texts = ["a b a c", "a b b", "c a b", "b"] * 3 + ["a a"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    import xxhash
    key = lambda w: np.uint64(xxhash.xxh64_intdigest(w.encode(), 42)).astype(np.int64)
    for u, v in (("a", "b"), ("c", "a"), ("q", "a"), ("q", "z")):
        total = 10 ** model["unknown"]
        for w in [key("a"), key("b"), key("c"), np.int64(kneser_ney.END_KEY)]:
            k = np.array([key(u), key(v), w])
            hit3, p = kneser_ney._find(model["p3"], kneser_ney._mix(k[:1], k[1:2], k[2:]), 0.0)
            if not hit3[0]:
                hit2, p2 = kneser_ney._find(model["p2"], kneser_ney._mix(k[1:2], k[2:]), 0.0)
                if not hit2[0]:
                    p2 = kneser_ney._find(model["p1"], kneser_ney._mix(k[2:]), model["unknown"])[1] + \
                        kneser_ney._find(model["g1"], kneser_ney._mix(k[1:2]), 0.0)[1]
                p = p2 + kneser_ney._find(model["g2"], kneser_ney._mix(k[:1], k[1:2]), 0.0)[1]
            total += 10 ** float(p[0])
        # what an unknown word takes is scaled by the same back-off weights
        back = 10 ** float(kneser_ney._find(model["g1"], kneser_ney._mix(np.array([key(v)])), 0.0)[1][0]) * \
            10 ** float(kneser_ney._find(model["g2"], kneser_ney._mix(np.array([key(u)]), np.array([key(v)])), 0.0)[1][0])
        assert math.isclose(total - 10 ** model["unknown"] + 10 ** model["unknown"] * back, 1.0, rel_tol=1e-6)
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = kneser_ney.classify(docs, labels, keep=["doc_id"]).select("row.doc_id", "kept").join(labels, "doc_id")
    by = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.02 * by[(1, True)] and by[(0, False)] >= by.get((0, True), 0)
    none = kneser_ney.quality_filter(docs_of(spark, TEXTS), labels.limit(0))
    assert none.count() == len(TEXTS) and none.columns == docs_of(spark, TEXTS).columns


def kneser_ney_table(spark, n, rare, long_words=0):
    """Trusted documents of one language and a few of another with other words; the first in md5 order may be long."""
    rng = np.random.default_rng(3)
    langs = ["xx" if i < rare else "en" for i in range(n)]
    texts = [" ".join(f"{g}{x}" for x in rng.integers(0, 300 if g == "xx" else 40, 40)) for g in langs]
    if long_words:
        texts[min(range(n), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())] = "en1 " * long_words
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string")
    return docs, docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


def test_kneser_ney_limits_a_rare_language_by_all_its_trusted_documents(spark):
    docs, labels = kneser_ney_table(spark, 4000, 120)
    out = kneser_ney.classify(docs, labels, max_docs=80, keep=["doc_id"]).select("row.lang", "threshold", "kept").collect()
    limits = {r.lang: r.threshold for r in out}
    assert len({r.threshold for r in out}) == 2 and limits["xx"] > 2 * limits["en"]
    assert sum(r.kept for r in out if r.lang == "xx") >= 114 and sum(r.kept for r in out if r.lang == "en") >= 3800


def test_kneser_ney_passes_over_a_text_beyond_the_word_bound(spark):
    docs, labels = kneser_ney_table(spark, 400, 0, long_words=5000)
    for bound in (1000, 7000):  # the long text alone is beyond the first, and takes most of the second
        trusted = kneser_ney.trusted_ids(labels)
        sample = kneser_ney.training_sample(docs, trusted, 100, bound).select(F.size(F.split("text", " ")).alias("n")).collect()
        assert len(sample) >= 12 and sum(r.n for r in sample) <= bound
    out = kneser_ney.classify(docs, labels, max_docs=100, max_words=1000, keep=["doc_id"])
    assert out.where("perplexity is null").count() == 0 and out.where("kept").count() >= 380
    with pytest.raises(ValueError):
        kneser_ney.classify(docs, labels, max_words=10)
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0


def brute_links(texts, t=0.8):
    sets = []
    for x in texts:
        w = words(x)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    n = len(texts)
    near = [[j for j in range(n) if j != i and (sets[i] == sets[j] or (sets[i] and sets[j] and
             len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j])))] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *[label[j] for j in near[i]]]) for i in range(n)]
    return [(label[i], len(near[i])) for i in range(n)]


@pytest.mark.parametrize("limit", [3, 2000])
def test_ngram_join_finds_every_link(spark, limit):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 4000, 60)) for _ in range(4)]
    texts = list(base)
    for b in base[:2]:
        for _ in range(9):  # near copies, more than the small limit
            w = b.split()
            w[int(rng.integers(0, 60))] = "edited"
            texts.append(" ".join(w))
    texts += [base[0]] * 5 + [None, "", " \n", "a b", "a b", "a c"]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join_documents(docs_of(spark, texts), limit=limit).collect()}
    assert [got[i] for i in range(len(texts))] == brute_links(texts)
    kept = ngram_join.drop_near_duplicates(docs_of(spark, texts), limit=limit)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in got.values()}) and kept.columns[-1] == "pattern"
    assert ngram_join.join_documents(docs_of(spark, texts).limit(0)).count() == 0


def test_ngram_join_keeps_one_of_repeated_rows(spark):
    texts = ["a b c d e f g"] * 6
    assert ngram_join.drop_near_duplicates(docs_of(spark, texts, [5, 5, 5, None, None, 6])).count() == 1


def test_warc_round_trip_and_revisits(spark):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/1", "x"), (2, "http://a/2\r\nEvil: 1", "x"), (3, None, None), (4, "u", ""), (None, "n", "y"), (6, "v", tricky),
            (7, "w", "é" * 10), (7, "w", "é" * 10), (8, "z", "<p>" * 40000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = work_dir(spark, "t1")
    got = warc.deduplicate(pages, folder).collect()
    dig = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    best = defaultdict(lambda: -1)
    for i, _, h in rows:
        best[dig(h)] = max(best[dig(h)], -1 if i is None else i)
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (i, len((h or "").encode()), dig(h)) for i, _, h in rows)
    ids = {r.record_id: r for r in got if r.record_type == "response"}
    assert len(ids) == len(best)
    for r in got:
        if r.record_type == "revisit":
            assert ids[r.refers_to_id].payload_digest == r.payload_digest and ids[r.refers_to_id].page_id == r.refers_to_page
        else:
            assert (r.page_id if r.page_id is not None else -1) == best[r.payload_digest]
    payloads = {r.payload_digest: bytes(r.payload) for r in warc.read_archives(spark, f"{folder}/deduplicated", "raw").collect()
                if r.record_type == "response"}
    assert all(payloads[dig(h)] == (h or "").encode() for _, _, h in rows)
    big = warc.resolve_revisits(warc.read_archives(spark, f"{folder}/captured"), min_bytes=5)
    assert {r.new_type for r in big.collect() if r.payload_bytes < 5} == {"response"}
    for r in spark.read.format("binaryFile").load(f"{folder}/captured").collect():
        assert all(f["content-length"] for f, _ in warc.parse_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(r.content)))))
    assert warc.deduplicate(pages.limit(0), work_dir(spark, "t1e")).count() == 0


def test_shards_fit_and_only_full_buckets_split(spark):
    ids = [*range(300), *[None] * 5, *[7] * 90]
    docs = docs_of(spark, ["x" * (i % 50) for i in range(len(ids))], ids)
    limit = 400
    got = sharding.shard(docs, "doc_id", "text", limit).select("row.doc_id", "hash", "bytes", "shard", "depth", "page", "shard_bytes",
                                                                "shard_rows", "oversize").collect()
    assert len(got) == len(ids)
    sums, rows = Counter(), Counter()
    for r in got:
        sums[(r["shard"], r.page)] += r.bytes
        rows[(r["shard"], r.page)] += 1
        assert f"{r.hash:060b}".startswith(r["shard"]) and len(r["shard"]) == r.depth
    assert all(r.shard_bytes == sums[(r["shard"], r.page)] and r.shard_rows == rows[(r["shard"], r.page)] for r in got)
    assert all(v <= limit or rows[k] == 1 for k, v in sums.items())
    total = Counter()
    for r in got:
        for d in range(61):
            total[f"{r.hash:060b}"[:d]] += r.bytes
    for r in got:  # every proper prefix of a shard was too large
        assert all(total[r["shard"][:d]] > limit for d in range(r.depth))
    assert sharding.shard(docs.limit(0), "doc_id", "text", limit).count() == 0


def test_mix_meets_targets_and_time_runs_forward(spark):
    docs = docs_of(spark, ["w " * (1 + i % 40) for i in range(400)] + [None, ""])
    got = curriculum.mix(docs, [5, 2, 1], slopes=[0.5, 0.0, -0.5]).select("row.doc_id", "row.source", "size", "source_size", "target", "taken",
                                                                          "positions").collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.taken == len(r.positions) * r.size and all(0 <= p <= 1 for p in r.positions)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    left, free = 1.5 * sum(sizes.values()), set(order)
    want = {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= set(over)
    for s in order:
        assert math.isclose(target[s], want[s], rel_tol=1e-9) and abs(taken[s] - want[s]) <= 40
    again = curriculum.mix(docs.repartition(5), [5, 2, 1], slopes=[0.5, 0.0, -0.5]).select("row.doc_id", "positions").collect()
    assert {r.doc_id: r.positions for r in again} == {r.doc_id: r.positions for r in got}
    assert curriculum.training_order(curriculum.mix(docs, [5, 2, 1])).count() == sum(r.taken // r.size for r in got if r.size)
    assert curriculum.mix(docs.limit(0), [5, 2, 1]).count() == 0


def test_winnowing_picks_rightmost_minima(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 4, int(n)).tolist()) for i, n in enumerate(rng.integers(0, 14, 60))]
    df = spark.createDataFrame(rows, "i long, h array<int>")
    for r in df.select("i", "h", winnowing.selected(F.col("h"), 4).alias("s")).collect():
        n, want = len(r.h), set()
        for a in range(max(1, n - 3) if n else 0):
            part = list(range(a, min(a + 4, n)))
            want.add(min(part, key=lambda k: (r.h[k], -k)))
        assert sorted((s["hash"], s["position"]) for s in r.s) == sorted((r.h[k], k) for k in want)


def test_winnowing_edited_texts(spark):
    texts = [*TEXTS, "alpha beta gamma delta epsilon zeta eta theta iota kappa"]
    ids = [3 * i for i in range(len(texts))]
    got = {r.doc_id: r for r in winnowing.edited_likeness(docs_of(spark, texts, ids)).collect()}
    chain = sorted(zip(ids, texts), reverse=True)
    for (i, t), (_, u) in zip(chain, chain[1:] + chain[:1]):
        t, u = t or "", u or ""
        m = len(t) // 3
        assert got[i].edited == t[:len(t) - m] + u[:m] and got[i].n_chars == len(t)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[12].fingerprint == got[15].fingerprint  # equal texts
    rows = docs_of(spark, ["a b c d e", "a b c d e", "q r s t u v"], [1, 1, None])
    assert winnowing.edited_likeness(rows).count() == 3
    assert winnowing.edited_likeness(rows.limit(0)).count() == 0


def brute_ppm(train, order):
    """Code length by the textbook: follow contexts from the longest, exclude what was offered."""
    counts = defaultdict(Counter)
    for seq in train:
        x = bytes([ppm.START]) * order + seq
        for p in range(order, len(x)):
            for d in range(order + 1):
                counts[x[p - d:p]][x[p]] += 1

    def prob(context, symbol):
        out, excluded = 1.0, set()
        for d in range(len(context), -1, -1):
            c = counts.get(context[len(context) - d:])
            if c is None:
                continue
            left = {s: n for s, n in c.items() if s not in excluded}
            total = sum(left.values()) + len(left)
            if symbol in left:
                return out * left[symbol] / total
            if left:
                out *= len(left) / total
            excluded |= set(left)
        return out / (256 - len(excluded))
    return prob


def test_ppm_equals_the_textbook_and_sums_to_one(spark):
    texts = ["abracadabra abra", "a cad bra", "Abba\tabba", None, "zz top é", "abra abra cadabra", "q"]
    docs = docs_of(spark, texts)
    learns = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    got = {r.doc_id: r for r in ppm.score_texts(docs, learns, order=3).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    seqs = {i: b" ".join(ppm.tokens(t or "")) + bytes([ppm.END]) for i, t in enumerate(texts)}
    prob = brute_ppm([seqs[i] for i in seqs if not held[i]], 3)
    assert math.isclose(sum(prob(b"abr", s) for s in range(256)), 1.0) and math.isclose(sum(prob(b"xyz", s) for s in range(256)), 1.0)
    count = Counter(w for i, t in enumerate(texts) if not held[i] for w in [*ppm.tokens(t or ""), ppm.END_WORD])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        x = bytes([ppm.START]) * 3 + seqs[i]
        want = sum(math.log10(prob(x[p - 3:p], x[p])) for p in range(3, len(x)))
        toks = [*ppm.tokens(t or ""), ppm.END_WORD]
        r = got[i]
        assert math.isclose(r.score, want, rel_tol=1e-5) and r.held_out == held[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(toks), sum(count[w] > 0 for w in toks), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks), rel_tol=1e-9)
    assert ppm.score_texts(docs.limit(0), learns).count() == 0


def test_ppm_keeps_every_gram_in_any_portions(spark):
    rng = np.random.default_rng(9)
    texts = ["".join(map(chr, rng.integers(97, 123, 1000))) for _ in range(1200)]  # 2.7 million grams of all orders
    docs = docs_of(spark, [*texts, *texts[:3]]).repartition(3)
    learns = F.col("doc_id") < len(texts)
    got = {r.doc_id: r.score for r in ppm.score_texts(docs, learns).collect()}
    cut = {r.doc_id: r.score for r in ppm.score_texts(docs, learns, portion=100_000, shard=100_000).collect()}
    assert got.keys() == cut.keys() and all(math.isclose(got[i], cut[i], rel_tol=1e-9) for i in got)
    prob = brute_ppm([t.encode() + bytes([ppm.END]) for t in texts], 5)
    for i in range(3):
        x = bytes([ppm.START]) * 5 + texts[i].encode() + bytes([ppm.END])
        want = sum(math.log10(prob(x[p - 5:p], x[p])) for p in range(5, len(x)))
        assert math.isclose(got[i], want, rel_tol=1e-5) and math.isclose(got[i + len(texts)], want, rel_tol=1e-5)


def test_pipeline_stages_by_their_parts(spark):
    import corpus_pipeline as P
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, d)
        assert kept.columns == docs.columns, name
    out = P.run(spark, d)
    want = Counter(r.doc_id for r in kept.collect())
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == want and set(want.values()) <= {1, 2}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(hashlib.sha256(text[r.doc_id].encode()).hexdigest() == r.decoded_sha256 for r in rows)
