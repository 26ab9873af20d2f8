"""The registered corpus queries against their SQL."""

from pathlib import Path

import duckdb
import pytest
from corpus_cases import SF

from shelfprice.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sql, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    found = sql.sql(ORACLE[name])
    order = [found.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=str)
    assert sorted((tuple(r) for r in frame.select(columns).collect()), key=str) == want
