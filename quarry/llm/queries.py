"""The registered queries of this subpackage: thin calls of its operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, curriculum, decontamination, fim, kneser_ney, ngram_join, ppm, quality_rules, sharding,
                        spelling, token_files, warc, winnowing)
from quarry.llm.common import work_dir

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_BYTES = 1 << 20
#: Weights of the sources in turn, and how their rates change over the training time (the heaviest early).
WEIGHTS = [5, 2, 1]
SLOPES = [0.5, 0.0, -0.5]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.deduplicate(table(spark, sf_dir, "pages"), work_dir(spark, "warc"), min_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("row.doc_id", "row.lang", "n_tokens", "log10_prob", "perplexity", "threshold", "kept")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), "doc_id", "text", SHARD_BYTES, keep=["doc_id"])
    return out.select("row.doc_id", "bytes", "shard", "depth", "page", "shard_bytes", "shard_rows", "oversize")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                      public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.round("posterior", 9).alias("posterior"), "kept")


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = curriculum.mix(table(spark, sf_dir, "documents"), WEIGHTS, budget=1.5, max_repeats=2, slopes=SLOPES, keep=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", "taken",
                      F.round(F.get("positions", F.lit(0)), 9).alias("position"),
                      F.round(F.get("positions", F.lit(1)), 9).alias("second_position"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.edited_likeness(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                      winnowing.digest(F.col("fingerprint")).alias("fingerprint"),
                      winnowing.digest(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    work_dir(spark, "token-files"), public_tokenizers.path(TOKENIZER),
                                    public_tokenizers.PATTERN, END_ID, added_tokens=True)


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learns = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    return ppm.score_texts(table(spark, sf_dir, "documents"), learns)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                      F.sha2(F.encode(fim.restored(F.col("output"), F.col("form")), "UTF-8"), 256).alias("restored_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_ngram_join": op3_ngram_join,
    "op4_extendible_shards": op4_extendible_shards,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_rules": op6_quality_rules,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_winnowing": op8_winnowing,
    "op9_token_files": op9_token_files,
    "op10_ppm": op10_ppm,
    "op11_decontamination": op11_decontamination,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
}

#: DuckDB SQL for the queries that SQL can express; the others are held against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op1_warc_revisits": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(x, (i // 8) * 10 + 1, 10))::BIGINT >> ((7 - i % 8) * 5)::INTEGER) & 31) + 1)::BIGINT, 1)),
        'string_agg', '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to FROM m""",
    "op4_extendible_shards": f"""
WITH r AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h, strlen(coalesce(text, '')) AS bytes FROM documents),
t AS (SELECT r.*, d::INTEGER AS depth, h >> (60 - d)::INTEGER AS prefix FROM r, range(0, 41) x(d)),
s AS (SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM t GROUP BY 1, 2),
f AS (SELECT t.*, shard_bytes, shard_rows FROM t JOIN s USING (depth, prefix) WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1
      QUALIFY depth = min(depth) OVER (PARTITION BY doc_id))
SELECT doc_id, bytes, left(lpad(bin(h), 60, '0'), depth) AS shard, depth, 0::BIGINT AS page, shard_bytes, shard_rows,
       shard_bytes > {SHARD_BYTES} AS oversize FROM f""",
    "op7_curriculum_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(doc_id::VARCHAR) AS h FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM s0),
s2 AS (SELECT *, [5.0, 2.0, 1.0][k + 1]::DOUBLE AS w, [0.5, 0.0, -0.5][k + 1]::DOUBLE AS slope, 2.0::DOUBLE * source_size AS cap FROM s1),
s3 AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS need,
              coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
              sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s2),
s4 AS (SELECT *, (need - filled) / open AS level FROM s3),
s5 AS (SELECT *, (SELECT arg_min(level, cap / w) FROM s4 WHERE level * w <= cap) AS settled FROM s4),
s6 AS (SELECT source, source_size, slope, least(cap, coalesce(settled * w, cap)) AS target FROM s5),
p AS (SELECT d.*, source_size, target, slope,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS begins
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
q AS (SELECT *, [x FOR x IN [begins, begins + source_size] IF size > 0 AND 2 * x + size <= 2 * target] AS passes FROM p),
o AS (SELECT *, [CASE WHEN slope = 0 THEN least(x / target, 1) ELSE 2 * least(x / target, 1) /
                 ((1 + slope) + sqrt(greatest((1 + slope) * (1 + slope) - 4 * slope * least(x / target, 1), 0))) END FOR x IN passes] AS t FROM q)
SELECT doc_id, size, source_size, target, (len(passes) * size)::BIGINT AS taken, round(t[1], 9) AS position,
       round(t[2], 9) AS second_position FROM o""",
    "op11_decontamination": r"""
WITH d0 AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win
      FROM (SELECT item, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM (SELECT *, least(len(ws), 10) AS size FROM b WHERE len(ws) > 0))),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d0),
h AS (SELECT r, i, size, win FROM (SELECT r, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win FROM p, (SELECT DISTINCT size FROM w)
      WHERE i + size - 1 <= len(ws)) WHERE win IN (SELECT win FROM w)),
c AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM h JOIN w ON h.size = w.size AND h.win = w.win) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d0 LEFT JOIN c ON d0.r = c.r LEFT JOIN t ON d0.r = t.r""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS r1, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS r2,
             ('0x' || substr(x, 17, 8))::BIGINT % 100 AS r3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS r4 FROM d),
c AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 90 THEN 'plain'
                     WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form, array_to_string(u[1:least(r1, r2)], '') AS pre,
             array_to_string(u[least(r1, r2) + 1:greatest(r1, r2)], '') AS mid, array_to_string(u[greatest(r1, r2) + 1:], '') AS suf FROM h)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM c""",
    "op13_spelling_variants": r"""
WITH RECURSIVE r0 AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
r1 AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
       FROM r0 WHERE length(run) >= 5 GROUP BY ALL),
r2 AS (SELECT run, k, hex(encode(id || ':' || run)) AS x FROM r1),
r3 AS (SELECT run, k, xor(list_reduce(list_transform(range(len(x) * 4), lambda i: CASE WHEN i % 8 = 0
                THEN ('0x' || substr(x, i // 4 + 1, 2))::BIGINT ELSE 0 END),
                lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END, 4294967295), 4294967295) AS h FROM r2),
w0 AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, k FROM r3),
w AS (SELECT word, sum(k)::BIGINT AS n FROM w0 WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
x AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
e AS (SELECT a.word, b.word AS other FROM x a JOIN x b ON a.i = b.i AND a.d = b.d WHERE a.word <> b.word
      UNION SELECT x.word, w.word FROM x JOIN w ON x.d = w.word UNION SELECT w.word, x.word FROM x JOIN w ON x.d = w.word),
f AS (SELECT e.word, count(*) AS n_near, first(e.other ORDER BY o.n DESC, e.other) AS other, max(o.n) AS other_n FROM e JOIN w o ON e.other = o.word GROUP BY e.word),
j AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
             CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM w LEFT JOIN f ON w.word = f.word),
s AS (SELECT word, word AS root, 0 AS step FROM j UNION ALL SELECT s.word, j.form, step + 1 FROM s JOIN j ON s.root = j.word WHERE j.form IS NOT NULL)
SELECT j.word, form, arg_max(root, step) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM j JOIN s ON j.word = s.word
GROUP BY j.word, form, n, n_near, form_n""",
}
