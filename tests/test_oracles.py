"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from pulsegrid.plans import registry
from tests.conftest import SF_SMALL
from tests.helpers import duck, rows

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = con.execute(ORACLES[name]).df()
    sc, sr = rows(sdf)
    oc, orows = rows(odf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_type", "last", "mean", "max", "last_t"]
    assert df.count() >= 0
