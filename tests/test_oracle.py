"""Every registered query equals its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

from eventmart.catalogue.registry import registered
from tests.conftest import SMALL
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def second_engine():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_sql(spark, second_engine, name):
    run, sql = registered()[name]
    df = run(spark, SMALL)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, second_engine, sql) == []


def test_only_file_sizes_lack_sql():
    assert [n for n, (_, sql) in registered().items() if sql is None] == ["table_growth"]
