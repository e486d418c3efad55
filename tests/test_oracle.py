"""Every query against its SQL counterpart."""
import duckdb
import pytest

from checks.compare import TABLES, kinds, table
from checks.oracle import ORACLE
from checks.queries import REGISTRY, bound

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(ORACLE) == set(REGISTRY)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_result(spark, name):
    df = bound(name)(spark, SF)
    got = table(df.columns, df.collect())
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = db.execute(ORACLE[name])
    want = table([c[0] for c in cur.description], cur.fetchall())
    assert got[0] == want[0] and kinds(got[1]) == kinds(want[1])
    assert got[1] == want[1]
