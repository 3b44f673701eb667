"""Every named query against the same query in SQL."""

import pytest

from quayside.bindings import registry


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(name, spark, sf_dir, oracle):
    frame = registry.QUERIES[name](spark, sf_dir)
    expected = oracle.sql(registry.ORACLES[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(c) for c in columns]
    found = sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect())
    assert found == sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(registry.QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plain_queries_do_without_packages_of_the_others(monkeypatch):
    import sys

    import __spark_entry__

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("quayside.llm")]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("public_tokenizers", "xxhash"):
        monkeypatch.setitem(sys.modules, name, None)
    with pytest.warns(UserWarning, match="no queries for training data"):
        assert set(__spark_entry__.queries()) == set(registry.QUERIES)
