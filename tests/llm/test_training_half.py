"""the language model learns from all trusted text, not from a bounded sample."""

import hashlib
import os

import numpy as np

from quarry.llm import kneser_ney
from quarry.plans.lineage import scope


def test_every_second_trusted_document_is_learned_from(spark, monkeypatch):
    # more words than the bound of a caller who gives only max_docs, here lowered
    monkeypatch.setattr(kneser_ney, "MAX_WORDS", 50)
    monkeypatch.setattr(kneser_ney, "MAX_DOCS", 4)
    rows = [(i, ("en", "de", None)[i % 3], f"some words of text {i} stand here") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trusted = docs.where("doc_id < 60").selectExpr("doc_id as id")
    got = {r.id: r.text for r in kneser_ney.training_half(docs.union(docs), trusted).collect()}
    want = set()
    for lang in ("en", "de", None):
        ids = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, of, _ in rows if of == lang and i < 60)
        want |= {i for _, i in ids[::2]}
    assert set(got) == want and all(got[i] == rows[i][2] for i in want)


def test_blocks_are_cut_and_found(spark):
    keys = list(range(-3000, 3000, 3))
    rows = spark.createDataFrame([("a", k, k / 2) for k in keys] + [("b", 7, 1.0)], "kind string, key long, value float")
    with scope(spark):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
        try:
            tables = kneser_ney.write_blocks(rows, kneser_ney.work_dir(spark, "blocks"), most=100)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(tables["a"].parts()) > len(tables["a"].files)
        hit, value = tables["a"].find(np.arange(-3100, 3100), 9.0)
        for k, h, v in zip(range(-3100, 3100), hit, value):
            assert (h, v) == ((True, k / 2) if k in range(-3000, 3000, 3) else (False, 9.0))
        assert tables["b"].find(np.array([7]), 0.0)[1][0] == 1.0


def test_slices_make_the_same_model_and_free_their_files(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i * j % 37}" for j in range(i % 23)),) for i in range(300)], "text string")
    whole, sliced = (kneser_ney.train(texts, words) for words in (10 ** 9, 500))
    assert whole["unknown"] == sliced["unknown"] and len(sliced["p3"].files) > len(whole["p3"].files)
    for kind in ("p1", "g1", "p2", "g2", "p3"):
        keys = np.sort(whole[kind].keys())
        assert np.array_equal(keys, sliced[kind].keys())  # the blocks of all slices, one after another, are sorted
        a, b = whole[kind].find(keys, 9.0), sliced[kind].find(keys, 9.0)
        assert a[0].all() and b[0].all() and np.allclose(a[1], b[1], atol=1e-6)


def test_training_leaves_the_model_and_no_shuffle_files(spark):
    def files(of):
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {n for n in os.listdir(folder) if n.startswith(of)}

    def shuffles():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in disk.getAllFiles().mkString("\n").split("\n") if n.endswith(".data")}

    texts = spark.createDataFrame([(f"a{i} b{i % 7} c{i % 11}",) for i in range(400)], "text string")
    with scope(spark):
        old_tables, old_shuffles = files("kn-"), shuffles()
        kneser_ney.train(texts, 100)
        left = {n.rsplit("-", 1)[0] for n in files("kn-") - old_tables}
        assert not left & {"kn-sequences", "kn-trigrams", "kn-bigrams", "kn-p2", "kn-p3", "kn-backs"}
        assert not shuffles() - old_shuffles
