"""Every registered query against its SQL, over the whole tables."""


import pytest
from oracle_check import compare, connection

from postern.plans.oracle import ORACLE
from postern.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_without_a_package_of_the_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__

    with monkeypatch.context() as m:
        for name in ("postern.llm.queries", "corpus_pipeline"):
            m.delitem(sys.modules, name, raising=False)
        m.setitem(sys.modules, "public_tokenizers", None)
        assert set(importlib.reload(__spark_entry__).queries()) == set(QUERIES)
    importlib.reload(__spark_entry__)
