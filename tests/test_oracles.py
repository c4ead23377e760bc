"""Every registered query against its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare import compare
from sitelens.plans.catalog import QUERIES

KEYS = sorted(QUERIES)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())
    assert set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, small_dir, key):
    res = compare(spark, key, small_dir)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "path", "freq"]
    assert df.count() > 0
