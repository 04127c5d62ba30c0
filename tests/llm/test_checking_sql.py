"""Every query that has SQL equals it, on whole tables."""

import duckdb
import pytest

from staylens.llm import queries

TABLES = "documents embeddings pages conversations".split()


def value(x):
    return repr(x + 0.0) if isinstance(x, float) else repr(x)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    df = queries.QUERIES[name](spark, small)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    got = sorted(tuple(value(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == sorted(tuple(value(r[i]) for i in order) for r in result.fetchall())
