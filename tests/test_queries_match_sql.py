"""Every registered query of the engine that has SQL, against that SQL on the same tables."""

import pytest

from threadmill.plans import datasets, steps, streams  # noqa: F401
from threadmill.plans.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{DATA}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, con, name):
    got = QUERIES[name](spark, DATA)
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(tuple(map(plain, r)) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == want
