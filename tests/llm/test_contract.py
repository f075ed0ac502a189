"""Queries of this package that SQL can express give its rows; the native one runs without Python."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from telescale.llm.queries import ORACLE, QUERIES
from tests.conftest import SF
from tests.contract import differences, duck


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(spark, duck(SF), name, SF) is None


def test_queries_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())


def test_url_lists_run_without_python(spark):
    text = queries()["op2_url_lists"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
