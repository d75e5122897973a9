"""Driver contract and value checks of every registered query against DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from cargoline.schema import FINAL_COLUMNS
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == list(FINAL_COLUMNS)
    assert df.count() == 844


def test_every_query_has_an_oracle():
    own = {q for q in E.queries() if q not in E.LLM_QUERIES}
    assert own == set(E.oracle_sql()) - set(E.LLM_ORACLES)
    assert len(own) >= 50


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order)
                   for r in rows)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_equals_oracle(spark, duck, name, capsys):
    df = E.queries()[name](spark, SF_SMALL)
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    assert "EvalPython" not in plan, "no Python in the query plan"
    sql = E.oracle_sql()[name]
    cur = duck.execute(sql)
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _norm(df.columns, df.collect()) == _norm(d_cols, cur.fetchall())
