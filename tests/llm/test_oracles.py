"""Every query that has SQL against DuckDB on the smallest tables; every query keeps one row per document or page."""

import pytest

from scorewright.llm.oracles import ORACLES
from scorewright.llm.queries import QUERIES
from tests.llm import data
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    ok_cols, ok_rows, ok_vals, ns, nd, *_ = compare(spark, duck(data.SMALL), name, QUERIES[name], ORACLES[name], data.SMALL)
    assert ok_cols and ok_rows and ok_vals, (name, ok_cols, ns, nd)


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLES) <= set(QUERIES)
