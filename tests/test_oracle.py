"""Every registered query against its DuckDB oracle (sf0.001 by default).

Set TALLYBAYES_ORACLE_SF=/root/testdata/sf0.01 to run at the driver's scale.
"""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402
from test_owner import left  # noqa: E402

from tallybayes.plans.catalog import QUERIES  # noqa: E402
from tallybayes.plans.oracle import oracle_sql  # noqa: E402

# not from conftest: tests/llm has one too, and either may be imported under that name
SF_ORACLE = os.environ.get("TALLYBAYES_ORACLE_SF", "/root/testdata/sf0.001")


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - set(oracle_sql()) == {"random_split_rows"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_and_leaves_nothing(spark, name):
    before = left(spark)
    res = compare(spark, SF_ORACLE, [name], verbose=False)[name]
    assert res[0] in ("MATCH", "ROWS_ONLY"), res
    assert not left(spark) - before  # its result has been released


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "label", "prediction", "score"]
    assert df.count() > 0
