"""The driver contract: entry, registry, and every oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["vec_id", "n_groups", "groups", "score", "prediction"]


def test_every_query_has_oracle_or_reason():
    from tenor.plans import contract
    qs, sq = E.queries(), E.oracle_sql()
    for k in qs:
        if k in contract.QUERIES:
            assert k in sq or k in contract.NO_ORACLE, k
    assert set(sq) <= set(qs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _own_oracles():
    """Oracles of the library's own queries; the optional subpackage tests its own."""
    from tenor.plans import contract
    contract.load_all()
    return sorted(contract.ORACLES)


@pytest.mark.parametrize("name", _own_oracles())
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
