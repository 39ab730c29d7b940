"""Queries that SQL can express equal their SQL."""

import duckdb
import pytest
from llm_tables import SF_SMALL

from rowcast.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in got.select(*names).collect())
