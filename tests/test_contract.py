"""Every registered query against its SQL counterpart, and the driver's entry points."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

import __spark_entry__ as contract
from civicspark.expected import expected_sql
from civicspark.workload import registered
from oracle import difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = expected_sql()


def test_every_query_has_sql():
    assert set(registered()) == set(SQL)
    assert set(registered()) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_its_sql(spark, name):
    df = registered()[name](spark, FOLDER)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "PythonUDF"):
        assert unwanted not in text.getvalue()
    assert difference(df, FOLDER, SQL[name]) is None
