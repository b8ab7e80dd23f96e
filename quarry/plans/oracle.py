"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code paths: set operations and window
functions over the same parquet views, iterations unrolled as CTEs, shortest
paths by recursive CTEs.  Doubles are rounded to 6 places, as in the catalog.
"""

from __future__ import annotations

from quarry.functions.hashing import DEFAULT_FAMILY, RECOMMENDER_FAMILY
from quarry.functions.text import NON_WORD_PATTERN, STRIP_PATTERN
from quarry.plans import catalog as C


def _normal(x: str) -> str:
    return (f"nfc_normalize(regexp_replace(lower(regexp_replace({x}, '{STRIP_PATTERN}', '', 'g')), "
            f"'{NON_WORD_PATTERN}', '', 'g'))")


def _tokens(x: str) -> str:
    return f"list_filter(string_split({_normal(x)}, ' '), lambda t: t <> '')"


def _fingerprint(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct({_tokens(x)})), ' ')"


# ---------------------------------------------------------------- text
FINGERPRINT = f"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents),
counts AS (SELECT value, count(*) AS count FROM lines WHERE value IS NOT NULL GROUP BY value),
keyed AS (SELECT value, count, {_fingerprint('value')} AS fingerprint FROM counts),
sizes AS (SELECT fingerprint, count(*) AS n_values, CAST(sum(count) AS BIGINT) AS n_total
          FROM keyed GROUP BY fingerprint HAVING count(*) >= 2)
SELECT k.fingerprint, k.value, k.count, s.n_values, s.n_total FROM keyed k JOIN sizes s USING (fingerprint)
"""

def _doc_tokens(x: str) -> str:
    return f"""
doc_toks AS (SELECT doc_id, {_tokens('x')} AS toks FROM (SELECT DISTINCT doc_id, {x} AS x FROM documents) WHERE x IS NOT NULL),
tok AS (SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS token FROM doc_toks),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) AS BIGINT) AS token_id FROM (SELECT DISTINCT token FROM tok))
"""


DOC_TOKENS = _doc_tokens("text")

TOKENS = f"WITH {DOC_TOKENS} SELECT doc_id, pos, token FROM tok"
VOCABULARY = f"WITH {DOC_TOKENS} SELECT token, token_id FROM vocab"

# ---------------------------------------------------------------- LSH recommender
REC = f"""
cp AS (SELECT DISTINCT o.o_custkey AS id, l.l_partkey AS item FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
h AS (SELECT id, i, min({RECOMMENDER_FAMILY.sql('item', 'i')}) AS h FROM cp, range(1, {C.REC_K + 1}) t(i) GROUP BY id, i),
bands AS (SELECT CAST((i - 1) // {C.REC_ROWS} AS INTEGER) AS band, id,
                 string_agg(CAST(h AS VARCHAR), ',' ORDER BY i) AS band_sig
          FROM h WHERE i <= {C.REC_BANDS * C.REC_ROWS} GROUP BY id, (i - 1) // {C.REC_ROWS})
"""

MINHASH_SIGNATURE = f"WITH {REC} SELECT id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY i) AS sig FROM h GROUP BY id"
LSH_BANDS = f"WITH {REC} SELECT band, id, band_sig FROM bands"
LSH_BUCKETS = f"""WITH {REC}, bs AS (SELECT band, band_sig, count(*) AS size FROM bands GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT b.band, b.band_sig, b.id, bs.size FROM bands b JOIN bs USING (band, band_sig)"""

# ---------------------------------------------------------------- document matching
_K_DOC = C.DOC_BANDS * C.DOC_ROWS
def _docs(tokens: str, distinct_sets: bool = True) -> str:
    """Matching of documents: of those with equal word sets one stands for all, unless ``distinct_sets`` is false."""
    return f"""{tokens},
sets0 AS (SELECT DISTINCT t.doc_id AS id, v.token_id AS item FROM tok t JOIN vocab v USING (token)),
skey AS (SELECT id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS k FROM sets0 GROUP BY id),
cgrp AS (SELECT id, min(id) OVER (PARTITION BY k) AS rep FROM skey),
copies AS (SELECT id, rep FROM cgrp WHERE id <> rep),
sets AS (SELECT s.* FROM sets0 s{" JOIN cgrp c ON c.id = s.id AND c.rep = c.id" if distinct_sets else ""}),
dh AS (SELECT id, i, min({DEFAULT_FAMILY.sql('item', 'i')}) AS h FROM sets, range(1, {_K_DOC + 1}) t(i) GROUP BY id, i),
dbands AS (SELECT (i - 1) // {C.DOC_ROWS} AS band, id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY i) AS band_sig
           FROM dh GROUP BY id, (i - 1) // {C.DOC_ROWS}),
bpairs AS (SELECT a.band, a.band_sig, a.id AS id_a, b.id AS id_b FROM dbands a JOIN dbands b
           ON a.band = b.band AND a.band_sig = b.band_sig AND a.id < b.id),
dcand AS (SELECT DISTINCT id_a, id_b FROM bpairs),
dsz AS (SELECT id, count(*) AS size FROM sets GROUP BY id),
dinter AS (SELECT c.id_a, c.id_b, count(*) AS inter FROM dcand c JOIN sets a ON a.id = c.id_a
           JOIN sets b ON b.id = c.id_b AND b.item = a.item GROUP BY 1, 2),
dsim AS (SELECT c.id_a, c.id_b, coalesce(i.inter, 0) AS inter, sa.size AS size_a, sb.size AS size_b, coalesce(i.inter, 0) / (sa.size + sb.size - coalesce(i.inter, 0)) AS similarity
         FROM dcand c JOIN dsz sa ON sa.id = c.id_a JOIN dsz sb ON sb.id = c.id_b
         LEFT JOIN dinter i ON i.id_a = c.id_a AND i.id_b = c.id_b),
dmatch AS (SELECT * FROM dsim WHERE similarity >= {C.DOC_THRESHOLD})
"""


DOCS = _docs(DOC_TOKENS)
LSH_CANDIDATES = f"WITH {DOCS} SELECT id_a, id_b FROM dcand"
PAIR_SIMILARITY = f"""WITH {DOCS}
SELECT id_a, id_b, inter, size_a, size_b, round(similarity, 6) AS similarity FROM dsim"""
# copies are neighbours too, of each other and of all sets that theirs is near
TOPK = f"""{_docs(DOC_TOKENS, distinct_sets=False)},
sym AS (SELECT id_a AS "user", id_b AS neighbour, similarity FROM dsim
        UNION ALL SELECT id_b, id_a, similarity FROM dsim),
topk AS (SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY similarity DESC, neighbour) AS INTEGER) AS rank FROM sym
         QUALIFY rank <= {C.REC_TOP})"""
SIMILAR_TOPK = f'WITH {TOPK} SELECT "user", neighbour, round(similarity, 6) AS similarity, rank FROM topk'
WORD_RATINGS = 'r AS (SELECT doc_id AS "user", token AS item, count(*) AS rating FROM tok GROUP BY 1, 2)'
_THEIRS = 'nr AS (SELECT t."user", r.item, r.rating FROM topk t JOIN r ON r."user" = t.neighbour)'
_UNSEEN = """unseen AS (SELECT * FROM nr WHERE NOT EXISTS
  (SELECT 1 FROM r o WHERE o."user" = nr."user" AND o.item = nr.item))"""
PREDICT = f"""WITH {TOPK}, {WORD_RATINGS}, {_THEIRS}, {_UNSEEN}
SELECT "user", item, round(avg(rating), 6) AS rating FROM unseen GROUP BY 1, 2"""
MATCH_RECORDS = f"""WITH {DOCS} SELECT id_a, id_b, round(similarity, 6) AS similarity FROM dmatch
UNION ALL SELECT rep, id, 1.0 FROM copies"""
MATCH_CONTAINMENT = f"""WITH {DOCS}
SELECT id_a, id_b, round(inter / least(size_a, size_b), 6) AS similarity FROM dsim
WHERE inter / least(size_a, size_b) >= {C.DOC_THRESHOLD} UNION ALL SELECT rep, id, 1.0 FROM copies"""
MATCH_TWO_COLUMNS = f"""WITH {_docs(_doc_tokens("text || ' ' || source"))}
SELECT id_a, id_b, round(similarity, 6) AS similarity FROM dmatch UNION ALL SELECT rep, id, 1.0 FROM copies"""
MATCH_GROUPS = f"""WITH {DOCS},
pass AS (SELECT b.* FROM bpairs b JOIN dmatch m ON m.id_a = b.id_a AND m.id_b = b.id_b),
mem AS (SELECT DISTINCT band, band_sig, member FROM
        (SELECT band, band_sig, id_a AS member FROM pass UNION ALL SELECT band, band_sig, id_b FROM pass)),
allm AS (SELECT band || ':' || band_sig AS name, member FROM mem
         UNION SELECT m.band || ':' || m.band_sig, c.id FROM mem m JOIN copies c ON c.rep = m.member
         UNION SELECT '-1:' || rep, member FROM (SELECT rep, id AS member FROM copies UNION ALL SELECT rep, rep FROM copies)),
lists AS (SELECT name, list(member ORDER BY member) AS ms FROM allm GROUP BY name),
firsts AS (SELECT min(name) AS group_name, ms FROM lists GROUP BY ms)
SELECT len(ms) AS group_size, ms[1] AS group_min, group_name, unnest(ms) AS member FROM firsts
"""

# ---------------------------------------------------------------- ALS, rank 1, item factors start at 1.0
_REG = C.ALS_REG
ALS = f"""
r AS (SELECT o.o_custkey AS "user", p.p_brand AS item, sum(l.l_quantity) AS rating
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
nz AS (SELECT * FROM r WHERE rating <> 0),
us AS (SELECT DISTINCT "user" AS id FROM r), it AS (SELECT DISTINCT item AS id FROM r),
nu AS (SELECT count(*) AS n FROM us), ni AS (SELECT count(*) AS n FROM it),
v0 AS (SELECT id, 1.0::DOUBLE AS f FROM it),
u1 AS (SELECT us.id, coalesce(b.b, 0) / ((SELECT sum(f * f) FROM v0) + {_REG} * (SELECT n FROM ni)) AS f
       FROM us LEFT JOIN (SELECT "user", sum(rating * v.f) AS b FROM nz JOIN v0 v ON v.id = nz.item GROUP BY 1) b ON b."user" = us.id)
"""
ALS_HALF_STEP = f"""WITH {ALS},
xtr AS (SELECT us.id, coalesce(b.b, 0) AS b FROM us LEFT JOIN
        (SELECT "user", sum(rating * v.f) AS b FROM nz JOIN v0 v ON v.id = nz.item GROUP BY 1) b ON b."user" = us.id)
SELECT x.id AS "user", round(x.b, 6) AS xtr, round((SELECT sum(f * f) FROM v0), 6) AS gram, round(u.f, 6) AS f0
FROM xtr x JOIN u1 u ON u.id = x.id"""


def _inverse(name: str, source: str, n_fixed: str, rank: int) -> list[str]:
    """CTEs of one row each: XᵀX + reg · n · I with the identity beside it, then Gauss-Jordan, a pivot at a time."""
    span = range(rank)
    cells = [f"sum(f{min(i, j)} * f{max(i, j)})" + (f" + {_REG} * (SELECT n FROM {n_fixed})" if i == j else "") + f" AS a{i}_{j}"
             for i in span for j in span]
    ones = [f"{float(i == j)}::DOUBLE AS e{i}_{j}" for i in span for j in span]
    out = [f"{name}_0 AS (SELECT {', '.join(cells + ones)} FROM {source})"]
    for p in span:
        cols = [f"{m}{i}_{j} / a{p}_{p} AS {m}{i}_{j}" if i == p else
                f"{m}{i}_{j} - a{i}_{p} * {m}{p}_{j} / a{p}_{p} AS {m}{i}_{j}" for m in "ae" for i in span for j in span]
        out.append(f"{name}_{p + 1} AS (SELECT {', '.join(cols)} FROM {name}_{p})")
    return out


def _als_sql(rank: int, iterations: int, seed: int, start: float | None = None) -> str:
    """CTEs from ``r`` (user, item, rating) to the factor tables ``u<iterations>`` and ``v<iterations>``; item factors
    start at ``start`` or at a hash of id, seed and place."""
    span = range(rank)
    init = [f"{start}::DOUBLE AS f{k}" for k in span] if start is not None else [f"('0x' || substr(md5(id::VARCHAR || ':{seed}:{k}'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS f{k}" for k in span]
    parts = ["nz AS MATERIALIZED (SELECT * FROM r WHERE rating <> 0)",
             'us AS MATERIALIZED (SELECT DISTINCT "user" AS id FROM r)', "it AS MATERIALIZED (SELECT DISTINCT item AS id FROM r)",
             "nu AS (SELECT count(*) AS n FROM us)", "ni AS (SELECT count(*) AS n FROM it)",
             f"v0 AS MATERIALIZED (SELECT id, {', '.join(init)} FROM it)"]

    def half(new, old, ids, key, other, n_fixed):
        parts.extend(_inverse("inv_" + new, old, n_fixed, rank))
        sums = ", ".join(f"sum(rating * x.f{k}) AS b{k}" for k in span)
        solved = ", ".join(" + ".join(f"e{i}_{j} * coalesce(b{j}, 0)" for j in span) + f" AS f{i}" for i in span)
        parts.append(f'{new} AS MATERIALIZED (SELECT {ids}.id, {solved} FROM {ids} LEFT JOIN (SELECT nz."{key}" AS id, {sums} '
                     f'FROM nz JOIN {old} x ON x.id = nz."{other}" GROUP BY 1) b ON b.id = {ids}.id CROSS JOIN inv_{new}_{rank})')

    for k in range(1, iterations + 1):
        half(f"u{k}", f"v{k - 1}", "us", "user", "item", "ni")
        half(f"v{k}", f"u{k}", "it", "item", "user", "nu")
    return ",\n".join(parts)


_BRAND_RATINGS = """r AS MATERIALIZED (SELECT o.o_custkey AS "user", p.p_brand AS item, sum(l.l_quantity) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2)"""
_N, _SPAN = C.ALS_ITERS, range(C.ALS_RANK)
_ALS = _als_sql(C.ALS_RANK, C.ALS_ITERS, C.ALS_SEED)
_DOT = " + ".join(f"u.f{k} * v.f{k}" for k in _SPAN)
_ROUNDED = ", ".join(f"round(f{k}, 6) AS f{k}" for k in _SPAN)
ALS_RANK5 = f"""WITH {_BRAND_RATINGS}, {_ALS}
SELECT 'user' AS side, CAST(id AS VARCHAR) AS id, {_ROUNDED} FROM u{_N}
UNION ALL SELECT 'item', CAST(id AS VARCHAR), {_ROUNDED} FROM v{_N}"""
ALS_RANK1 = f"""WITH {_BRAND_RATINGS}, {_als_sql(1, C.ALS_ITERS, C.ALS_SEED, 1.0)}
SELECT 'user' AS side, CAST(id AS VARCHAR) AS id, round(f0, 6) AS f0 FROM u{_N}
UNION ALL SELECT 'item', CAST(id AS VARCHAR), round(f0, 6) FROM v{_N}"""
ALS_RMSE = f"""WITH {_BRAND_RATINGS}, {_ALS}
SELECT round(sqrt(avg((coalesce(r.rating, 0) - ({_DOT})) ** 2)), 6) AS rmse
FROM u{_N} u CROSS JOIN v{_N} v LEFT JOIN r ON r."user" = u.id AND r.item = v.id"""
# the best of a document are taken as they come: its cells are too many to sort
ALS_PREDICT = f"""WITH {DOC_TOKENS}, {WORD_RATINGS.replace(' AS (', ' AS MATERIALIZED (', 1)}, {_ALS},
scored AS (SELECT u.id AS "user", v.id AS item, {_DOT} AS rating FROM u{_N} u CROSS JOIN v{_N} v
           WHERE NOT EXISTS (SELECT 1 FROM nz WHERE nz."user" = u.id AND nz.item = v.id)),
best AS (SELECT "user", unnest(min({{'less': 0 - round(rating, 9), 'item': item, 'rating': rating}}, {C.ALS_TOP})) AS b FROM scored GROUP BY 1)
SELECT "user", b.item AS item, round(b.rating, 6) AS rating FROM best"""

ALS_TOP_UNRATED = f"""WITH r AS MATERIALIZED (SELECT o.o_custkey AS "user", l.l_partkey AS item, max(l.l_quantity) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2), {_ALS},
scored AS (SELECT u.id AS "user", v.id AS item, {_DOT} AS rating FROM u{_N} u CROSS JOIN v{_N} v
           WHERE NOT EXISTS (SELECT 1 FROM nz WHERE nz."user" = u.id AND nz.item = v.id))
SELECT "user", item, round(rating, 6) AS rating FROM scored
QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY round(rating, 9) DESC, item) <= {C.ALS_TOP}"""

# ---------------------------------------------------------------- graphs
PART_EDGES = """
li AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem),
mn AS (SELECT l_orderkey, min(l_linenumber) AS ln FROM li GROUP BY 1),
head AS (SELECT li.l_orderkey, min(li.l_partkey) AS hp FROM li JOIN mn ON mn.l_orderkey = li.l_orderkey AND li.l_linenumber = mn.ln GROUP BY 1),
pe AS (SELECT head.hp AS src, li.l_partkey AS dst FROM li JOIN head USING (l_orderkey) WHERE head.hp <> li.l_partkey)
"""


def _pagerank_sql(rounds: int) -> str:
    parts = [PART_EDGES,
             "e AS (SELECT DISTINCT src, dst FROM pe)",
             "l AS (SELECT e.src, e.dst, d.outdeg FROM e JOIN (SELECT src, count(*) AS outdeg FROM e GROUP BY src) d USING (src))",
             "r0 AS (SELECT DISTINCT src AS node, 1.0::DOUBLE AS rank FROM l)"]
    for k in range(1, rounds + 1):
        parts.append(f"r{k} AS (SELECT l.dst AS node, sum(r.rank / l.outdeg) * 0.85 + 0.15 AS rank "
                     f"FROM l JOIN r{k - 1} r ON r.node = l.src GROUP BY l.dst)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT node, round(rank, 6) AS rank FROM r{rounds}"


def _hits_sql(rounds: int) -> str:
    parts = [PART_EDGES,
             "w AS (SELECT src, dst, count(*)::DOUBLE AS w FROM pe GROUP BY 1, 2)",
             "nodes AS (SELECT src AS node FROM pe UNION SELECT dst FROM pe)",
             "h0 AS (SELECT node, 1.0::DOUBLE AS s FROM nodes)"]
    for k in range(1, rounds + 1):
        parts.append(f"ar{k} AS (SELECT w.dst AS node, sum(w.w * h.s) AS s FROM w JOIN h{k - 1} h ON h.node = w.src GROUP BY 1)")
        parts.append(f"a{k} AS (SELECT node, s / (SELECT max(s) FROM ar{k}) AS s FROM ar{k})")
        parts.append(f"hr{k} AS (SELECT w.src AS node, sum(w.w * a.s) AS s FROM w JOIN a{k} a ON a.node = w.dst GROUP BY 1)")
        parts.append(f"h{k} AS (SELECT node, s / (SELECT max(s) FROM hr{k}) AS s FROM hr{k})")
    return ("WITH " + ",\n".join(parts) +
            f"\nSELECT n.node, round(coalesce(h.s, 0), 6) AS hub, round(coalesce(a.s, 0), 6) AS authority "
            f"FROM nodes n LEFT JOIN h{rounds} h USING (node) LEFT JOIN a{rounds} a USING (node)")


NATION = """
lanes AS (SELECT DISTINCT least(s.s_nationkey, c.c_nationkey) AS src, greatest(s.s_nationkey, c.c_nationkey) AS dst
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
          JOIN customer c ON o.o_custkey = c.c_custkey WHERE s.s_nationkey <> c.c_nationkey),
und AS (SELECT src AS u, dst AS v FROM lanes),
adj AS (SELECT u, v FROM und UNION ALL SELECT v, u FROM und),
gnodes AS (SELECT DISTINCT u AS node FROM adj),
walk(source, node, dist) AS (SELECT node, node, 0 FROM gnodes
      UNION SELECT w.source, a.v, w.dist + 1 FROM walk w JOIN adj a ON a.u = w.node
            WHERE w.dist + 1 < (SELECT count(*) FROM gnodes)),
sp AS (SELECT source, node, min(dist) AS dist FROM walk GROUP BY 1, 2),
paths(source, node, dist) AS (SELECT node, node, 0 FROM gnodes
      UNION ALL SELECT p.source, a.v, p.dist + 1 FROM paths p JOIN adj a ON a.u = p.node
      JOIN sp ON sp.source = p.source AND sp.node = a.v AND sp.dist = p.dist + 1),
bfs AS (SELECT source, node, CAST(dist AS INTEGER) AS dist, count(*)::DOUBLE AS sigma FROM paths GROUP BY 1, 2, 3)
"""
BFS_PATHS = f"WITH RECURSIVE {NATION} SELECT source, node, dist, round(sigma, 6) AS sigma FROM bfs"
_BETWEENNESS_TAIL = """,
orient AS (SELECT u AS a, v AS b, u, v FROM und UNION ALL SELECT v, u, u, v FROM und),
contrib AS (SELECT o.u, o.v, sa.sigma * bt.sigma / st.sigma AS x FROM orient o
            JOIN bfs sa ON sa.node = o.a JOIN bfs st ON st.source = sa.source
            JOIN bfs bt ON bt.source = o.b AND bt.node = st.node
            WHERE sa.dist + 1 + bt.dist = st.dist)
SELECT und.u, und.v, round(coalesce(0.5 * s.b, 0), 6) AS betweenness FROM und
LEFT JOIN (SELECT u, v, sum(x) AS b FROM contrib GROUP BY 1, 2) s USING (u, v)"""
EDGE_BETWEENNESS = "WITH RECURSIVE " + NATION + _BETWEENNESS_TAIL

PART_PATHS = f"""{PART_EDGES},
und AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM pe),
adj AS MATERIALIZED (SELECT u, v FROM und UNION ALL SELECT v, u FROM und),
srcs AS MATERIALIZED (SELECT min(p_partkey) AS node FROM part GROUP BY p_brand),
sp(source, node, dist) USING KEY (source, node) AS (SELECT node, node, 0 FROM srcs
      UNION SELECT s.source, a.v, s.dist + 1 FROM sp s JOIN adj a ON a.u = s.node
      WHERE NOT EXISTS (SELECT 1 FROM recurring.sp k WHERE k.source = s.source AND k.node = a.v)),
paths(source, node, dist, path) AS (SELECT node, node, 0, [node] FROM srcs
      UNION ALL SELECT p.source, a.v, p.dist + 1, list_append(p.path, a.v) FROM paths p JOIN adj a ON a.u = p.node
      JOIN sp ON sp.source = p.source AND sp.node = a.v AND sp.dist = p.dist + 1)"""
PART_BFS_PATHS = f"""WITH RECURSIVE {PART_PATHS}
SELECT source, node, dist, count(*)::DOUBLE AS sigma FROM paths GROUP BY 1, 2, 3"""
# every shortest path gives each of its edges one share of its pair's paths
PART_EDGE_BETWEENNESS = f"""WITH RECURSIVE {PART_PATHS},
shares AS (SELECT path, 1.0::DOUBLE / count(*) OVER (PARTITION BY source, node) AS x FROM paths),
steps AS (SELECT path, x, unnest(range(1, len(path))) AS i FROM shares),
sums AS (SELECT least(path[i], path[i + 1]) AS u, greatest(path[i], path[i + 1]) AS v, sum(x) AS b FROM steps GROUP BY 1, 2)
SELECT und.u, und.v, round(coalesce(b, 0), 6) AS betweenness FROM und LEFT JOIN sums USING (u, v)"""


# ---------------------------------------------------------------- k-means
KMEANS = f"""WITH RECURSIVE pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
dims AS MATERIALIZED (SELECT id, unnest(range(len(vec))) AS d, unnest(vec) AS x FROM pts),
seed AS (SELECT id, row_number() OVER (ORDER BY md5(id::VARCHAR || ':{C.KMEANS_SEED}'), id) - 1 AS cid FROM pts
         ORDER BY cid LIMIT {C.KMEANS_K}),
lloyd(round, cid, d, c, shift) AS (
  SELECT 0, s.cid, d.d, d.x, 1e300::DOUBLE FROM seed s JOIN dims d USING (id)
  UNION ALL
  SELECT o.round + 1, o.cid, o.d, coalesce(m.c, o.c), sum((coalesce(m.c, o.c) - o.c) ** 2) OVER ()
  FROM lloyd o LEFT JOIN (
    SELECT a.cid, p.d, avg(p.x) AS c FROM (
      SELECT p.id, c.cid FROM dims p JOIN lloyd c USING (d) GROUP BY p.id, c.cid
      QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY sum((p.x - c.c) ** 2), c.cid) = 1) a
    JOIN dims p USING (id) GROUP BY a.cid, p.d) m USING (cid, d)
  WHERE o.shift > {C.KMEANS_CONVERGE}),
fin AS (SELECT cid, d, c FROM lloyd WHERE round = (SELECT max(round) FROM lloyd))"""
KMEANS_FIT = KMEANS + "\nSELECT CAST(cid AS INTEGER) AS cid, CAST(d AS INTEGER) AS dim, round(c, 6) AS value FROM fin"
KMEANS_ASSIGN = KMEANS + """,
dist AS (SELECT p.id, c.cid, sum((p.x - c.c) ** 2) AS x FROM dims p JOIN fin c USING (d) GROUP BY 1, 2)
SELECT id, CAST(cid AS INTEGER) AS cid, round(x, 6) AS sq_dist FROM dist
QUALIFY row_number() OVER (PARTITION BY id ORDER BY x, cid) = 1"""

# ---------------------------------------------------------------- baskets, itemsets, rules
BASKETS_CTE = f"""
bk AS (SELECT l.l_orderkey AS basket, list_sort(list(DISTINCT p.p_type)) AS items
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1),
nb AS (SELECT count(*) AS n FROM bk),
sub AS (SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS s
        FROM bk, range(1, CAST(1 AS BIGINT) << len(items)) t(m)),
fi AS (SELECT s, array_to_string(s, '|') AS items, CAST(len(s) AS INTEGER) AS size, count(*) AS support FROM sub GROUP BY s
       HAVING count(*) >= ceil({C.BASKET_SUPPORT} * (SELECT n FROM nb)))
"""
BASKETS = "SELECT l.l_orderkey AS basket, array_to_string(list_sort(list(DISTINCT p.p_type)), '|') AS items " \
          "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1"
FREQUENT_ITEMSETS = f"WITH {BASKETS_CTE} SELECT items, size, support FROM fi"
ASSOCIATION_RULES = f"""WITH {BASKETS_CTE},
rl AS (SELECT s, support, unnest(s) AS consequent FROM fi WHERE len(s) >= 2),
rr AS (SELECT array_to_string(list_filter(s, lambda x: x <> consequent), '|') AS antecedent, consequent, support FROM rl)
SELECT rr.antecedent, rr.consequent, rr.support, round(rr.support / a.support, 6) AS confidence
FROM rr JOIN fi a ON a.items = rr.antecedent WHERE rr.support / a.support >= {C.RULE_CONFIDENCE}"""

RULE_MATCHES = f"""WITH {BASKETS_CTE},
rl AS (SELECT s, support, unnest(s) AS consequent FROM fi WHERE len(s) >= 2),
rr AS (SELECT list_filter(s, lambda x: x <> consequent) AS antecedent, consequent, support FROM rl),
rc AS (SELECT rr.antecedent, rr.consequent, rr.support / a.support AS confidence FROM rr JOIN fi a ON a.s = rr.antecedent
       WHERE rr.support / a.support >= {C.MATCH_CONFIDENCE})
SELECT bk.basket, rc.consequent AS item, round(max(rc.confidence), 6) AS confidence, count(*) AS n_rules
FROM bk JOIN rc ON list_has_all(bk.items, rc.antecedent) AND NOT list_contains(bk.items, rc.consequent) GROUP BY 1, 2"""

FREQUENT_PAIRS = f"""WITH ob AS (SELECT DISTINCT l.l_orderkey AS basket, p.p_brand AS item
                      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT count(DISTINCT basket) AS n FROM ob)
SELECT a.item AS item_a, b.item AS item_b, count(*) AS support FROM ob a JOIN ob b
  ON a.basket = b.basket AND a.item < b.item
GROUP BY 1, 2 HAVING count(*) >= ceil({C.PAIR_SUPPORT} * (SELECT n FROM n))"""


# ---------------------------------------------------------------- sinks and sources
FINGERPRINT_RANKS = f"""SELECT fingerprint, row_number() OVER (PARTITION BY fingerprint ORDER BY count DESC, value) AS rank,
  value, count, n_values, n_total FROM ({FINGERPRINT})"""
SQL_CLUSTERS = f"""SELECT DISTINCT fingerprint, n_values, n_total,
  CAST(len(list_filter(string_split(fingerprint, ' '), lambda t: t <> '')) AS INTEGER) AS n_tokens FROM ({FINGERPRINT})"""
IO_RATINGS = """SELECT o.o_custkey AS "user", l.l_partkey AS item, max(l.l_quantity) AS rating
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2"""
IO_LAST_RATINGS = """SELECT o.o_custkey AS "user", l.l_partkey AS item,
  arg_max(l.l_quantity, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity)) AS rating
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2"""
IO_REJECTS = """WITH r AS (SELECT o.o_custkey AS u, l.l_partkey AS i, l.l_quantity AS q, l_orderkey % 7 = 0 AS bad
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT CASE WHEN bad THEN 'x' || u || ',' || i || ',' || q ELSE u::VARCHAR END AS line, bad::INTEGER AS rejected, count(*) AS n FROM r GROUP BY 1, 2"""
IO_EDGES = f"""WITH {PART_EDGES} SELECT src::VARCHAR AS src, dst::VARCHAR AS dst, count(*) AS n FROM pe GROUP BY 1, 2"""
IO_VECTORS = """SELECT CAST(len(e) AS INTEGER) AS dims, round(e[1], 6) AS first, round(e[-1], 6) AS last, round(list_sum(e), 6) AS total
FROM (SELECT CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""
IO_RECORDS = "SELECT DISTINCT p_brand AS name, p_type AS extra FROM part WHERE p_brand <> '' AND p_type <> ''"
IO_BASKETS = """SELECT b || ':' || string_agg(i::VARCHAR, ',' ORDER BY i) AS line
FROM (SELECT DISTINCT l_orderkey AS b, l_partkey AS i FROM lineitem) GROUP BY b"""
IO_MATCH_GROUPS = f"""WITH RECURSIVE {NATION}
SELECT string_agg(v::VARCHAR, ',' ORDER BY v) AS line FROM adj GROUP BY u"""
IO_CLUSTERS = f"""SELECT fingerprint || ':' || string_agg(value || '(' || count || ')', ',' ORDER BY count DESC, value) AS line
FROM ({FINGERPRINT}) GROUP BY fingerprint"""
IO_SCORE_LINES = f"""WITH h AS ({_hits_sql(C.GRAPH_ROUNDS)}),
p AS (SELECT *, CAST(row_number() OVER (ORDER BY node::VARCHAR) - 1 AS INTEGER) AS place FROM h)
SELECT place, hub AS score FROM p UNION ALL SELECT place, authority FROM p"""


ORACLE: dict[str, str] = {
    "fingerprint_clusters": FINGERPRINT,
    "tokens": TOKENS,
    "vocabulary": VOCABULARY,
    "minhash_signature": MINHASH_SIGNATURE,
    "lsh_bands": LSH_BANDS,
    "lsh_buckets": LSH_BUCKETS,
    "lsh_candidates": LSH_CANDIDATES,
    "pair_similarity": PAIR_SIMILARITY,
    "similar_topk": SIMILAR_TOPK,
    "predict_from_neighbours": PREDICT,
    "match_records": MATCH_RECORDS,
    "match_groups": MATCH_GROUPS,
    "match_containment": MATCH_CONTAINMENT,
    "match_two_columns": MATCH_TWO_COLUMNS,
    "als_half_step": ALS_HALF_STEP,
    "als_rank1": ALS_RANK1,
    "als_rmse": ALS_RMSE,
    "als_predict": ALS_PREDICT,
    "als_rank5": ALS_RANK5,
    "als_top_unrated": ALS_TOP_UNRATED,
    "pagerank": _pagerank_sql(C.GRAPH_ROUNDS),
    "hits": _hits_sql(C.GRAPH_ROUNDS),
    "bfs_paths": BFS_PATHS,
    "edge_betweenness": EDGE_BETWEENNESS,
    "part_bfs_paths": PART_BFS_PATHS,
    "part_edge_betweenness": PART_EDGE_BETWEENNESS,
    "lane_bfs_paths": BFS_PATHS,
    "lane_edge_betweenness": EDGE_BETWEENNESS,
    "kmeans_fit": KMEANS_FIT,
    "kmeans_assign": KMEANS_ASSIGN,
    "baskets": BASKETS,
    "frequent_itemsets": FREQUENT_ITEMSETS,
    "association_rules": ASSOCIATION_RULES,
    "frequent_pairs": FREQUENT_PAIRS,
    "rule_matches": RULE_MATCHES,
    "fingerprint_ranks": FINGERPRINT_RANKS,
    "sql_clusters": SQL_CLUSTERS,
    "io_ratings": IO_RATINGS,
    "io_last_ratings": IO_LAST_RATINGS,
    "io_rejects": IO_REJECTS,
    "io_edges": IO_EDGES,
    "io_vectors": IO_VECTORS,
    "io_records": IO_RECORDS,
    "io_baskets": IO_BASKETS,
    "io_match_groups": IO_MATCH_GROUPS,
    "io_clusters": IO_CLUSTERS,
    "io_score_lines": IO_SCORE_LINES,
}
