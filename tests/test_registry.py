"""Registered queries against their SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spec
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
if not Path(SF).exists():
    pytest.skip("no tables", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = spec.entry(spark)
    assert df.columns[:3] == ["source", "service", "severity"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(spec.oracle_sql()) <= set(spec.queries())


@pytest.mark.parametrize("name", sorted(spec.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    line = compare(spark, con, SF, name)
    assert line.startswith("ok"), line
