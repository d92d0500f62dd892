import os

import pytest

import __spark_entry__ as entry
from tests.compare import DATA, same

CORE = sorted(n for n, q in entry.queries().items() if "lamella.llm" not in q.__module__)
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.mark.parametrize("name", CORE)
def test_query(spark, name):
    # Every query outside the llm subpackage has SQL.
    same(spark, entry.queries()[name], entry.oracle_sql()[name])


def test_entry_point(spark):
    assert entry.entry(spark).columns == ["ccxt_version", "exchange", "symbol", "change_kind"]
