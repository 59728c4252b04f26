"""Every query with a SQL twin gives the twin's rows; every other one runs."""

import pytest

from fwdcurve.plans import registry
from twins import agree

registry.load()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_twin(spark, sf_dir, name):
    agree(spark, registry.QUERIES[name], registry.SQL[name], sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - registry.SQL.keys()))
def test_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["rpt9_commodities", "jon13_pairs", "src15_close_columns", "win4_bollinger", "win6_returns", "win7_rebase", "val18_parameter_search"])
def test_all_names_and_days(name):
    assert "IN ('Brand#" not in registry.SQL[name] and "day(b.d) = 1" not in registry.SQL[name]
