"""Every registered traffic query against its SQL, or for those without SQL that it gives rows."""

import pytest

from roadloom.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, compare, name):
    if name in ORACLES:
        compare(spark, QUERIES[name], ORACLES[name])
    else:
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.entry(spark).columns) == 6


@pytest.mark.parametrize("name", ["w05_hampel", "w06_temporal_fill", "m03_dct", "m06_decode_profile"])
def test_every_edge(spark, name):
    from roadloom.plans.views import Tables

    sf = "/root/testdata/sf0.001"
    edges = {r.edge_no for r in Tables(spark, sf).obs.select("edge_no").distinct().collect()}
    assert {r.edge_no for r in QUERIES[name](spark, sf).select("edge_no").distinct().collect()} == edges
