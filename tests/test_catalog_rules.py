"""Guards for the registered queries: whole driver tables, no inline data."""

from __future__ import annotations

import inspect
import re

from tallybayes.plans import catalog, oracle


def test_no_registered_query_builds_inline_data():
    src = inspect.getsource(catalog)
    assert "createDataFrame" not in src
    assert "spark.range" not in src


def test_only_the_preview_operator_limits_rows():
    src = inspect.getsource(catalog)
    assert ".limit(" not in src and ".sample(" not in src
    # the one LIMIT in the oracle SQL is the ordered preview
    limits = [k for k, q in oracle.oracle_sql().items() if re.search(r"\bLIMIT\b", q)]
    assert limits == ["sample_rows"]


def test_every_registered_query_has_a_docstring():
    for name, fn in catalog.QUERIES.items():
        assert inspect.getdoc(fn), name
