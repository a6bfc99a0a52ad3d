"""Every query with an oracle matches DuckDB on the smallest scale factor;
rows-only queries run and return rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, table_hash  # noqa: E402

ORACLE = sorted(E.oracle_sql())
ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()))
SLOW = {"gbt_score", "fm_classify", "fm_mixed", "beta_binomial_fit"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", ORACLE)
def test_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert table_hash(df.columns, rows) == table_hash(ocols, orows)


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in SLOW])
def test_rows_only_runs(spark, sf_dir, name):
    assert E.queries()[name](spark, sf_dir).count() > 0


def test_every_query_has_a_stable_schema(spark, sf_dir):
    a = E.entry(spark)
    assert a.count() > 0
    assert a.schema == E.entry(spark).schema
    assert len(a.columns) == 40
