"""Spark-vs-DuckDB comparison used by the tests (and by hand at larger scale)."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols, s_rows = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    d_cols, d_rows = canon([c[0] for c in cur.description], cur.fetchall())
    diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
    return {"cols": s_cols == d_cols, "rows": (len(s_rows), len(d_rows)), "values": s_rows == d_rows,
            "col_names": (s_cols, d_cols), "diff": diff}
