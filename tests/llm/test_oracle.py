"""Corpus queries against their SQL, where SQL can express them."""
import duckdb
import pytest

from checks.compare import TABLES, kinds, table
from tests.llm.conftest import SF
from tillwork.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_result(spark, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = db.execute(ORACLE[name])
    want = table([c[0] for c in cur.description], cur.fetchall())
    assert kinds(got[1]) == kinds(want[1]) and got == want
