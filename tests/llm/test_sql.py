"""Every registered query of the subpackage that has SQL against it, on the smallest tables."""

import duckdb
import pytest

from reelmill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    found = db.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall())
    assert sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect()) == want
