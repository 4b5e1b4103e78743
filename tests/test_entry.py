"""Driver contract: entry smoke, registry consistency, every query runs."""

import re

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "state_click" in df.columns and "action_click" in df.columns


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data queries, where installed, have their own tests
    rows_only = {n for n in set(q) - set(o) if not re.match(r"op\d+_|pipeline$", n)}
    assert not rows_only


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs_on_smoke_data(spark, name):
    df = E.queries()[name](spark, SMOKE)
    df.write.format("noop").mode("overwrite").save()
    assert len(df.columns) == len(set(df.columns))
