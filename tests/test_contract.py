"""Every registered query gives the rows of its SQL, and the plans keep their shape."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from telescale.operators.ordered import ROWS_KEY
from telescale.plans.catalog import QUERIES
from telescale.plans.oracle import ORACLE
from tests.conftest import SF
from tests.contract import differences, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, SF) is None


@pytest.mark.parametrize("name", [
    "job_start_records", "stage_job_mapping", "stage_pairing", "stage_rescaling_ratio", "job_rescaling_ratio",
    "alive_executor_count", "scale_out_intervals", "scale_decisions", "latest_attempt_per_stage", "job_end_records",
    "stage_features", "sink_messages", "effective_recommendation", "stage_order_in_job", "orphan_stages",
    "last_known_timeline", "last_known_asof", "interior_intervals", "response_match", "initial_scale_requests",
    "answers_to_decisions", "job_rescaling_ratio_from_zero", "fleet_job_end_rows", "app_end_records", "interval_clip",
])
def test_query_equals_sql_when_all_applications_are_hot(spark, con, name):
    spark.conf.set(ROWS_KEY, "12")
    try:
        assert differences(spark, con, name, SF) is None
    finally:
        spark.conf.unset(ROWS_KEY)


def test_entry(spark):
    assert entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_plans_have_no_cartesian_product_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in text


def test_one_shuffle_serves_a_chain_of_windows(spark):
    text = plan(queries()["alive_executor_count"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [In(event_type, [error,signup])]" in text
    assert "value" not in text.split("ReadSchema")[1].split(">")[0]


@pytest.mark.parametrize("name, scans, exchanges", [
    ("job_end_records", 6, 8), ("stage_features", 6, 8), ("effective_recommendation", 4, 8), ("scale_decisions", 4, 8),
])
def test_events_are_read_few_times(spark, name, scans, exchanges):
    text = plan(queries()[name](spark, SF))
    assert text.count("FileScan") <= scans and text.count("Exchange") <= exchanges


SF_MORE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [
    "missing_required_config", "app_start_records", "job_end_records", "stage_features", "effective_recommendation",
    "scale_decisions", "sink_messages", "host_disk_total",
])
def test_query_equals_sql_on_more_rows(spark, name):
    assert differences(spark, duck(SF_MORE), name, SF_MORE) is None
