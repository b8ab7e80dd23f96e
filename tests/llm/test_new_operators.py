"""Decontamination, fill-in-the-middle and spelling variants against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontamination, fim, spelling
from quarry.llm.queries import ORACLE

DOCS = "doc_id long, text string, row string, key string, hash string, word string, n long"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "r", "k", "h", "w", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- decontamination -------------------------------------------------------------------------

def brute_contamination(texts, items, width=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = cut(t)
        for k in range(len(w) - width + 1) if len(w) > width else [0] * bool(w):
            windows.setdefault(tuple(w[k:k + width]), set()).add("" if i is None else str(i))
    out = []
    for t in texts:
        w, hit, found = cut(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k:k + size]))):
                    hit |= set(range(k, k + size))
                    found |= own
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, ITEM), (20, ITEM.upper()), (3, "short item"), (3, "other  Short-words"), (None, "null id"), (5, None), (6, ""), (7, "..!"),
         (8, "É" + ITEM), (9, " ".join(f"x{i % 3}" for i in range(14)))]
TEXTS = [None, "", " \n", ITEM, f"say: {ITEM.replace(' ', ', ')}!", " ".join(ITEM.split()[:9]), " ".join(ITEM.split()[1:]) + " tail", "a short\titem b",
         "SHORT ITEM short item", "null id null id other short words", "é" + ITEM, "x0 x1 x2 " * 9, f"{ITEM} {ITEM} mid {ITEM}", "clean " * 40,
         "kein Ärger mit Straße", "w" * 100_000, f"{'pre ' * 3000}{ITEM}{' post' * 3000}"]


@pytest.mark.parametrize("set_rows", [1_000_000, 3])
def test_contamination_equals_brute_force(spark, set_rows):
    texts = [*TEXTS, *TEXTS[3:5] * 20]
    ids = [None, 7, 7, *range(10, 10 + len(texts) - 3)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.contamination(docs_of(spark, texts, ids), items, set_rows=set_rows).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert Counter(map(tuple, got)) == Counter((i, *x) for i, x in zip(ids, brute_contamination(texts, ITEMS)))


def test_random_texts_against_overlapping_windows(spark):
    rng = random.Random(4)
    make = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, make(rng.randint(1, 9))) for i in range(12)]
    texts = [make(rng.randint(0, 40)) for _ in range(120)]
    got = decontamination.contamination(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"), width=4)
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.select("row.doc_id", *got.columns[1:]).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_contamination(texts, items, 4)


def test_decontaminated_documents_and_spans(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, TEXTS)
    hit = [x[4] for x in brute_contamination(TEXTS, ITEMS)]
    kept = decontamination.remove_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [i for i, h in enumerate(hit) if not h]
    cut = decontamination.remove_spans(docs, items)
    got = {r.doc_id: r.text for r in cut.collect()}
    assert cut.columns == docs.columns and len(got) == len(TEXTS)
    assert all(got[i] == t for i, t in enumerate(TEXTS) if not hit[i])
    assert got[3] == "" and got[4] == "say: !" and got[6] == " tail" and got[7] == "a  b" and got[8] == ""
    assert got[12] == " mid " and got[16] == "pre " * 3000 + " post" * 3000
    assert not any(x[4] for x in brute_contamination([got[4], got[12], got[16]], ITEMS))


def test_decontamination_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, TEXTS)
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    clean = decontamination.contamination(docs, items.limit(0)).select("n_hit", "n_items", "items_sha256", "contaminated").distinct().collect()
    assert [tuple(r) for r in clean] == [(0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontamination.remove_spans(docs, items.limit(0)).count() == len(TEXTS)


# --- fill in the middle ------------------------------------------------------------------------

FIM_TEXTS = [None, "", "one", "a1b22  c\n\nd", "naïve café 日本語 – x", "has <P> inside", "<S>", "<M", "S> <P", "<<S", "\U0001F600 emoji \U0001F600\U0001F600", "x" * 70_000,
             "K Å K", "ab " * 400_000, "word " * 300]


def test_fim_equals_units_counted_one_by_one(spark):
    texts = FIM_TEXTS * 12
    out = fim.transform(docs_of(spark, texts))
    rows = out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(rows) == len(texts) and out.columns[0] == "row"
    for r in rows:
        t = texts[r.doc_id] or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
        h = [int(hashlib.sha256(f"1:{r.doc_id}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
        a, z = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = ("".join(x) for x in (units[:a], units[a:z], units[z:]))
        form = "plain" if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
        want = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r.n, r.form, r.output, r.back) == (len(units), form, want, t)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (len(p), len(m)))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.transform(docs_of(spark, texts).limit(0)).count() == 0
    same = fim.transform(docs_of(spark, ["a b c d"] * 3, [None, None, 4])).select("row.doc_id", "output").collect()
    assert len({r.output for r in same if r.doc_id is None}) == 1


def test_unit_list_reaches_every_rank(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(2)
    for n in (0, 1, 15, 16, 17, 255, 257, 5000):
        t = "".join(rng.choice("aBz 1é\U0001F600") for _ in range(n))
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
        lanes = fim.UnitList(fim.unit_widths(t))
        assert len(lanes) == len(units)
        ends = np.cumsum([0, *map(len, units)])
        assert [lanes.code_points(k) for k in range(len(units) + 1)] == ends.tolist()
        assert all(sum(points) == len(t) and sum(links) == len(units) for links, points in lanes.lanes)


# --- spelling variants -------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(texts, ids, min_length=5, min_count=3):
    count = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in count.items() if len(w) >= min_length and k >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def test_spelling_groups_equal_brute_force(spark):
    rng = random.Random(7)
    letters, words = "abÉéà", []
    for size in (5, 6, 7, 8, 9, 5, 6, 7):
        base = "".join(rng.choice(letters) for _ in range(size))
        for _ in range(40):
            w, at, kind = base, rng.randrange(size), rng.randrange(3)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(w))
                w = w[:at] + (rng.choice(letters) if kind else "") + w[at + (kind != 2):]
            words.append(w)
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "aabaaa", "aaaaab", "baaaaa", "ababab", "bababa", "abababa", "a" * 3000, "a" * 2999, "a" * 1500 + "b" + "a" * 1499]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(150)] + [None, "", "12 ! ", "solo", " ".join(words * 3)]
    ids = [*range(len(texts) - 2), None, None]
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n)
                 for r in spelling.spelling_groups(docs_of(spark, texts, ids)).collect())
    want = brute_groups(texts, ids)
    assert got == want and sum(x[4] for x in want) > 300 and any(x[2] != x[1] and x[1] for x in want)


def test_pivots_are_disjoint_and_least(spark):
    rng = random.Random(3)
    for _ in range(300):
        grams = sorted(rng.sample(range(12), rng.randint(3, 6)))
        grams = [(p, rng.randint(0, 9)) for p in grams]
        pairs = [(a[1] + b[1], a[0], b[0]) for i, a in enumerate(grams) for b in grams[i + 1:] if b[0] - a[0] >= 2]
        if pairs:
            got = spelling.choose_pivots(grams)
            own = dict(grams)
            assert got[1] - got[0] >= 2 and own[got[0]] + own[got[1]] == min(pairs)[0]


def test_entries_of_words_are_never_gathered(spark, monkeypatch):
    words = spelling.staged(spark.createDataFrame([("spelling", 5), ("speling", 3), ("another", 4)], "word string, n long"), "words")
    plans = []

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    monkeypatch.setattr(spelling, "staged", planned)
    spelling.near_pairs(words)
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_spelling_of_tables_without_words(spark):
    for texts in ([], [None, "", "a b c"], ["rareword other"]):
        docs = docs_of(spark, texts) if texts else docs_of(spark, ["x"]).limit(0)
        out = spelling.spelling_groups(docs)
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_fill_in_middle", "op13_spelling_variants"])
def test_sql_runs_on_the_smallest_tables(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    assert con.execute(ORACLE[name]).fetchall()
