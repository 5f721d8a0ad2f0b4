"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from workload import registry

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLE:
        assert df.columns
        return
    same, message, _ = compare(df, con, ORACLE[name])
    assert same, message


def test_every_query_has_sql():
    assert set(registry.ORACLE) == set(registry.QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["amostra", "analito", "unidade", "qualificador", "valor"]
    assert df.count() > 0
