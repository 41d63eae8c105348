"""Every feed query against its DuckDB oracle, on the smallest driver tables (the
driver runs the same comparison at sf0.01).  The corpus queries have own tests."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import DUCK_TYPES, TABLES, digest

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["os", "n_hits"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.ORACLES[name])
    types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    orows = duck.execute(entry.ORACLES[name]).fetchall()
    assert len(rows) == len(orows) and len(rows) > 0
    assert digest(df.columns, rows) == digest(rel.columns, orows)
