"""Queries of the subpackage against their SQL in DuckDB."""

import duckdb
import pytest

from quarry.llm.queries import ORACLE, QUERIES

D = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, D)
    assert sorted(got.columns) == sorted(rel.columns)
    cols = sorted(got.columns)
    key = lambda row: tuple((x is None, round(x, 6) if isinstance(x, float) else x) for x in row)
    a = sorted(key(r) for r in got.select(*cols).toPandas().astype(object).where(lambda f: f.notna(), None).itertuples(index=False))
    b = sorted(key(r) for r in rel.select(", ".join(f'"{c}"' for c in cols)).fetchall())
    assert a == b
