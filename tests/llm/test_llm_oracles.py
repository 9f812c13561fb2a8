"""Every operator query with SQL equals its DuckDB oracle on sf0.001, column types included."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from demandlab.llm import queries

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    assert {c: TYPES[t] for c, t in df.dtypes} == {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    cols = sorted(df.columns)
    rows = lambda found: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in found), key=repr)
    assert rows(df.select(*cols).collect()) == rows(con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())
