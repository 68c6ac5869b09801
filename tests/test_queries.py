"""Every registered query against its SQL."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as driver  # noqa: E402
from check_oracles import compare  # noqa: E402
from tradeflow.plans.oracles import ORACLES  # noqa: E402
from tradeflow.plans.queries import QUERIES  # noqa: E402


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    same, note = compare(spark, sf_dir, name)
    assert same, note


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["price", "symbol", "ts", "volume"]
    assert df.count() > 0
