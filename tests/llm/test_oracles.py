"""Corpus queries against their SQL, and their registration."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as driver  # noqa: E402
from check_oracles import compare  # noqa: E402
from tradeflow.llm.oracles import ORACLES  # noqa: E402


def test_each_operator_has_one_query():
    names = sorted(n for n in driver.queries() if n.startswith("op"))
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    same, note = compare(spark, sf_dir, name)
    assert same, note
