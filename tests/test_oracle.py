"""Every registered query against its DuckDB SQL at sf0.001 (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from quarry.plans.catalog import QUERIES
from quarry.plans.oracle import ORACLE
from compare import compare, duck
from conftest import SF001


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    assert r["cols"], r["col_names"]
    assert r["rows"][0] == r["rows"][1]
    assert r["values"], r["diff"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(ORACLE[name])
    assert ours == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["node", "rank"]
    assert df.count() > 0
