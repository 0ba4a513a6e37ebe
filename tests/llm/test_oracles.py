import math

import duckdb
import pytest

import __spark_entry__ as entry
from nestlift.llm.oracle import ORACLE
from nestlift.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def rounded(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) and math.isfinite(x) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert entry.oracle_sql()[name] == ORACLE[name]
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert rounded(got.select(*columns).collect()) == rounded(want.fetchall())
