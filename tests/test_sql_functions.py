"""The session's SQL functions equal the column expressions."""

import unicodedata

from pyspark.sql import functions as F

from quarry.functions.sql import definitions, register
from quarry.functions.text import composition_map, fingerprint_key, normal_text, normal_tokens
from quarry.functions.vectors import nearest

VALUES = ["Hello,  World!", "  Él é  é ", "a\tb", "x²½_", "İ", "한글 각", "ǅ Ⅳ K Å", "", None, "it's 'quoted'", "\U0002f800 word",
          "".join(c for c in composition_map() if unicodedata.category(c)[0] in "LN")]


def test_text_functions_in_sql(spark):
    names = register(spark)
    assert len(names) == len(definitions()) and "fingerprint_key" in names
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    df.createOrReplaceTempView("sql_values")
    got = {r.i: (r.n, r.t, r.k) for r in spark.sql("SELECT i, normal_text(v) AS n, normal_tokens(v) AS t, fingerprint_key(v) AS k FROM sql_values").collect()}
    want = {r.i: (r.n, r.t, r.k) for r in df.select("i", normal_text(F.col("v")).alias("n"), normal_tokens(F.col("v")).alias("t"),
                                                    fingerprint_key(F.col("v")).alias("k")).collect()}
    assert got == want and got[5][0] == unicodedata.normalize("NFC", VALUES[5])


def test_nearest_centre_in_sql(spark):
    register(spark)
    centres = [[0.0, 0.0], [2.0, 0.0], [0.0, 5.0]]
    df = spark.createDataFrame([(i, [float(i % 4), float(i % 7)]) for i in range(40)] + [(99, [1.0, 0.0])], "id long, vec array<double>")
    df.createOrReplaceTempView("sql_points")
    table = "array(" + ", ".join(f"array({a}D, {b}D)" for a, b in centres) + ")"
    got = spark.sql(f"SELECT id, nearest_centre(vec, {table}) AS c, sq_dist(vec, array(0D, 0D)) AS d FROM sql_points").collect()
    want = {r.id: r.c for r in df.select("id", nearest(F.col("vec"), centres).alias("c")).collect()}
    assert all((r.c.sq_dist, r.c.cid) == (want[r.id].sq_dist, want[r.id].cid) for r in got)
    assert next(r.c.cid for r in got if r.id == 99) == 0  # a tie goes to the lowest
    assert all(r.d == (r.id % 4) ** 2 + (r.id % 7) ** 2 for r in got if r.id < 40)


def test_no_python_behind_the_functions(spark):
    register(spark)
    spark.range(1).selectExpr("'é' AS v").createOrReplaceTempView("sql_one")
    plan = spark.sql("SELECT fingerprint_key(v) FROM sql_one")._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "Python" not in plan
