"""Every query of the core that SQL can say, against DuckDB on the smallest tables."""

import pytest
from oracle import differences
from siltworks.plans import catalogue, general

ALL = {**general.QUERIES, **catalogue.QUERIES}
SQL = {**general.SQL, **catalogue.SQL}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, name):
    assert differences(spark, small, ALL[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_runs(spark, small, name):
    """What SQL cannot say is tested elsewhere; here it must find something in the whole tables."""
    assert ALL[name](spark, small).take(1), name


def test_names():
    assert not set(SQL) - set(ALL)


def test_edges_of_many_records_are_never_broadcast(spark, small):
    """Catalyst takes rows made of a document for as few bytes as the document; the documents are parsed once."""
    plan = catalogue.reader_fgdc_edges(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan and "ArrowEvalPython" not in plan
