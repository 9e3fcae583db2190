"""The registered queries against their SQL, and the registry itself."""

import duckdb
import pytest

import __spark_entry__ as E
from aevia.llm.oracle import ORACLE
from aevia.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(llm, key):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = QUERIES[key](llm, SF), con.execute(ORACLE[key])
    names = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, rel.fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert {*QUERIES, "pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())
