"""Every registered query against its oracle SQL on DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tablekit.plans.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_key, type_diffs

QUERIES = {k: f for k, f in E.queries().items() if k not in E.EXTRA_QUERIES}
ORACLE = {k: s for k, s in E.oracle_sql().items() if k not in E.EXTRA_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_reason():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    d_cols, d_types, d_rows = rel.columns, rel.types, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert type_diffs(df.schema, d_cols, d_types) == []
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_cols, s_rows) == rows_key(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["payments", "n_name", "r_name"]
    assert df.count() >= 0


@pytest.mark.parametrize("name,key", [
    ("sort_asc", None), ("group_multi_agg", None), ("nation_payments", None),
    ("group_agg_nulls_last", lambda r: (r.avg_price is None, -(r.avg_price or 0), r.o_custkey, r.o_orderpriority))])
def test_sorted_queries_are_sorted(spark, con, name, key):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    if key:
        assert [key(r) for r in rows] == sorted(key(r) for r in rows)
        assert any(r.avg_price is None for r in rows) and any(r.avg_price for r in rows)
    else:  # the oracle text has the same ORDER BY
        got = [tuple(str(v) for v in r) for r in rows]
        cols = QUERIES[name](spark, SF_SMALL).columns
        want = [tuple(str(v) for v in r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()]
        first = [r[:1] for r in got]
        assert len(rows) > 1 and first == [r[:1] for r in want]
