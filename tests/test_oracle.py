"""Every registered query against its DuckDB oracle on the sf0.001 tables;
keys without SQL must at least run."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.oracle_check import compare, duck

from conftest import SF_SMALL

QS = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns and df.count() >= 0


@pytest.mark.parametrize("key", sorted(QS))
def test_query_matches_oracle(spark, con, key):
    df = QS[key](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if key not in SQL:
        assert len(cols) > 0
        return
    res = con.execute(SQL[key])
    status, detail = compare(cols, rows, [d[0] for d in res.description], res.fetchall())
    assert status == "OK", f"{key}: {detail}"
