"""Every registered query against its oracle on the driver's smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_queries import ORACLE
from tests.comparing import FAMILIES, TESTDATA, duck, rows_of

FOLDER = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_an_oracle():
    assert set(entry.order_queries()) == set(ORACLE)


@pytest.mark.parametrize("name", list(entry.order_queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in cur.description}
    assert {c: FAMILIES[t] for c, t in df.dtypes} == kinds
    want = rows_of(list(kinds), cur.fetchall())
    assert want, "an oracle without rows proves nothing"
    assert rows_of(df.columns, df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 1476
