"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from scorewright.registry.oracle import ORACLES
from scorewright.registry.spark_queries import QUERIES
from tests.oracle_check import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok_cols, ok_rows, ok_vals, ns, nd, *_ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert ok_cols, f"{name}: column names differ"
    assert ok_rows, f"{name}: {ns} spark rows vs {nd} oracle rows"
    assert ok_vals, f"{name}: values differ"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity_id", "metric_id", "level_id", "value_text", "value_rgb", "bench_text", "period"]
    assert df.count() > 0
