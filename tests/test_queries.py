"""Every registered query of the library's own operators against its SQL on the smallest tables."""

import duckdb
import pytest

from reelmill.operators import graph
from reelmill.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name not in ORACLE_SQL:
        assert got
        return
    found = db.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_component_groups_of_a_large_component(spark, tmp_path):
    """A name on each of 3,000 nodes takes 45 MB; no side with such rows may be broadcast."""
    docs = [(k, 7 if k % 2 else 1000 + k // 8) for k in range(6000)]
    spark.createDataFrame(docs, "doc_id long, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = duckdb.execute(ORACLE_SQL["component_groups"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    nodes, edges = spark.range(3000).selectExpr("id AS node"), spark.range(1, 3000).selectExpr("id AS a", "id - 1 AS b")
    rows = nodes.selectExpr("node AS doc_id", "array(node) AS tokens", "'a.mp4' AS path", "'train' AS split")
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(8 << 20))
    try:
        named = graph.named_components(nodes, edges)
        got = [(r["doc_id"], r["group_id"]) for r in QUERIES["component_groups"](spark, str(tmp_path)).collect()]
        whole = graph.group_ids(rows, named, "tokens", "path", "split").selectExpr("doc_id", "length(group_id)").collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == 6000 and sorted(got) == sorted(want)
    assert len(whole) == 3000 and {n for _, n in whole} == {len("identity-component/") + len("-".join(map(str, range(3000))))}
