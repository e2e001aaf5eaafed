"""The registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from stratigraph.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    db = duckdb.connect()
    for t in os.listdir(SF):
        db.execute(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    result = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    wanted = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == wanted
