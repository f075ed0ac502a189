"""Expected values of the scalar expressions, worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telescale.functions import expr


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("a, b, want", [
    (0, 0, 0.0), (0, 5, 0.0), (5, 0, 1.0), (6, 3, 2.0), (-1, 4, -0.25), (1, 3, 1 / 3), (2**53, 1, float(2**53)),
])
def test_safe_ratio(spark, a, b, want):
    assert value(spark, expr.safe_ratio(F.lit(a), F.lit(b))) == want


@pytest.mark.parametrize("name, algorithm, args", [
    ("Sort with Params(1, 2)", "Sort", ["1", "2"]),
    ("Sort", "Sort", []),
    ("Sort with Params(", "Sort with Params(", []),
    ("Sort with Params(1,,)", "Sort", ["1"]),
    ("Sort with Params()", "Sort", [""]),
    ("Sort with Params(,,)", "Sort", []),
    ("Sort with Params(,1)", "Sort", ["", "1"]),
    ("Sort with Params(f(x))", "Sort", ["f(x)"]),
    ("with Params(1)", "", ["1"]),
    ("A with Params(1 with Params(2)", "A with Params(1 with Params(2)", []),
    ("A with Params(1with Params(", "A", ["1"]),
    ("\t K \n with Params( a\t, b )", "K", ["a", "b"]),
    ("", "", []),
])
def test_algorithm_and_args(spark, name, algorithm, args):
    assert value(spark, expr.algorithm_name(F.lit(name))) == algorithm
    assert value(spark, expr.algorithm_args(F.lit(name))) == args


@pytest.mark.parametrize("text, want", [
    ("0.4", 1), ("10.9", 10), ("1024", 1024), (None, 1), ("-7", 1), ("1e12", 2147483647), ("NaN", 1), ("big", None),
])
def test_datasize(spark, text, want):
    assert value(spark, expr.datasize_mb(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("setting, memory, want", [
    (None, "12G", "1.2000000000000002G"), ("2G", "12G", "2G"), (None, "512m", "51.2m"), (None, "1.5g", "0.15000000000000002g"),
    (None, "1024", "102.4"), (None, "lots", None),
])
def test_memory_overhead(spark, setting, memory, want):
    assert value(spark, expr.memory_overhead(F.lit(setting).cast("string"), F.lit(memory))) == want


@pytest.mark.parametrize("text, default, want", [
    (None, True, True), (None, False, False), ("true", False, True), ("TRUE", False, True), ("False", True, False),
    ("1", True, None),
])
def test_flag(spark, text, default, want):
    assert value(spark, expr.flag(F.lit(text).cast("string"), default)) is want


@pytest.mark.parametrize("start, length, window, want", [
    (12, 2, (10, 20), 2), (5, 7, (10, 20), 2), (18, 9, (10, 20), 2), (12, 0, (10, 20), 8), (1, 2, (10, 20), 0),
    (25, 3, (10, 20), 0),
])
def test_interval_clip(spark, start, length, window, want):
    got = expr.interval_clip(F.lit(start), F.lit(length), F.lit(window[0]), F.lit(window[1]))
    assert value(spark, got) == want


def test_machine_type(spark):
    got = expr.machine_type(F.lit("Debian  GNU/Linux\t12"), F.lit(8), F.lit(3 * 2**29), F.lit(0.5))
    assert value(spark, got) == "os:DebianGNU/Linux12-cores:8-memory:1536.0-disk_size:0.5"


def test_small_defaults(spark):
    assert value(spark, expr.failure_reason(F.lit(None).cast("string"))) == ""
    assert value(spark, expr.failure_reason(F.lit("lost"))) == "lost"
    assert value(spark, expr.stage_key(F.lit(7))) == "7"
    assert value(spark, expr.whole_number(F.lit("x"))) is None
