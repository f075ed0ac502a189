"""The rescaling ratio against its literal definition."""

from __future__ import annotations

import random

import pytest

from telescale.operators.rescaling import interior_intervals, job_windows, rescaling_time_ratio

POINTS = "app_id long, t_ms long, seq long"
WINDOWS = "app_id long, id long, window_start long, window_end long"


def touching(points, start, end):
    lengths = [b - a for a, b in zip(points, points[1:])] + [0]
    return [(t, n) for t, n in zip(points, lengths) if t + n >= start and t <= end]


def literal(points, start, end, stretch=True):
    total = 0
    for t, n in touching(points, start, end)[1:-1]:
        stop = (end if stretch else t) if n == 0 else t + n
        total += max(start, min(stop, end)) - min(max(start, t), end)
    if total == 0:
        return 0.0
    return 1.0 if end == start else total / (end - start)


CASES = [
    ([], (10, 20), 0.0), ([12, 18], (10, 20), 0.0), ([12], (10, 20), 0.0), ([12, 14, 18], (10, 20), 0.4),
    ([5, 12, 18], (10, 20), 0.6), ([5, 12, 12, 18], (10, 20), 1.4), ([5, 12, 18], (12, 12), 0.0),
    ([10, 10, 15, 20], (10, 20), 1.0), ([10, 10, 10, 20], (10, 20), 2.0),
]


def frames(spark, cases):
    points = [(i, t, j) for i, (ts, _) in enumerate(cases) for j, t in enumerate(ts)]
    windows = [(i, k, s, e) for i, (_, ws) in enumerate(cases) for k, (s, e) in enumerate(ws)]
    return spark.createDataFrame(points, POINTS), spark.createDataFrame(windows, WINDOWS)


def test_hand_made_cases(spark, hot):
    points, windows = frames(spark, [(ts, [w]) for ts, w, _ in CASES])
    got = {r.app_id: r.rescaling_time_ratio for r in rescaling_time_ratio(windows, points, hot=hot).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(CASES)}
    assert [literal(ts, *w) for ts, w, _ in CASES] == [want for _, _, want in CASES]


@pytest.mark.parametrize("tie_mode", ["stretch", "plain"])
def test_random_cases(spark, hot, tie_mode):
    rng = random.Random(5)
    cases = []
    for _ in range(300):
        span = rng.choice([8, 30, 200])
        points = sorted(rng.randrange(span) for _ in range(rng.randrange(12)))
        starts = [rng.randrange(span) for _ in range(4)]
        cases.append((points, [(s, s + rng.randrange(span)) for s in starts]))
    points, windows = frames(spark, cases)
    rows = rescaling_time_ratio(windows, points, tie_mode, hot=hot).collect()
    assert len(rows) == 1200
    counts = {(r.app_id, r.id): r for r in interior_intervals(windows, points, hot=hot).collect()}
    for r in rows:
        ts = cases[r.app_id][0]
        assert r.rescaling_time_ratio == literal(ts, r.window_start, r.window_end, tie_mode == "stretch"), (ts, r)
        n = len(touching(ts, r.window_start, r.window_end))
        count = counts[r.app_id, r.id]
        assert (count.n_overlapping, count.n_interior) == (n, max(0, n - 2)), (ts, r)


def test_one_application_with_many_windows_of_one_start(spark, hot):
    points = spark.range(200).selectExpr("0L app_id", "id * 7 t_ms", "id seq")
    ends = spark.range(150).selectExpr("0L app_id", "id", "id * 9 + 20 end_ms")
    starts = spark.createDataFrame([(0, 3)], "app_id long, app_start_ms long")
    windows = job_windows(ends, starts)
    series = [7 * i for i in range(200)]
    for r in rescaling_time_ratio(windows, points, hot=hot).collect():
        assert r.rescaling_time_ratio == literal(series, 3, r.end_ms)


def test_zero_start_and_bad_arguments(spark):
    points, windows = frames(spark, [([12, 14, 18], [(10, 20)])])
    ends = spark.createDataFrame([(0, 20)], "app_id long, end_ms long")
    starts = spark.createDataFrame([(0, 10)], "app_id long, app_start_ms long")
    row = rescaling_time_ratio(job_windows(ends, starts, "zero"), points).first()
    assert row.rescaling_time_ratio == literal([12, 14, 18], 0, 20)
    with pytest.raises(ValueError):
        rescaling_time_ratio(windows, points, "other")
    with pytest.raises(ValueError):
        job_windows(ends, starts, "other")
