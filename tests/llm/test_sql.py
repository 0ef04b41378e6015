"""The operators' queries against their SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from gridrefs.llm.queries import QUERIES
from gridrefs.llm.sql import SQL

DATA = "/root/testdata/sf0.001"


def plain(v):
    return round(float(v), 6) if isinstance(v, int | float) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    got = con.execute(SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall()), key=repr)
    assert ours and ours == theirs
