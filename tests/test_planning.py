"""Dates, grids, plans, ranges and incremental windows."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fieldgauge import functions as fx
from fieldgauge import plans
from fieldgauge.operators import expected_vs_actual, missing_in_range, missing_observations
from fieldgauge.schemas import CHECKPOINT_SCHEMA


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        (date(2026, 2, 1), date(2026, 2, 1), 1),
        (date(2026, 2, 1), date(2026, 2, 5), 5),
        (date(2026, 2, 5), date(2026, 2, 1), 0),
        (date(2024, 2, 28), date(2024, 3, 1), 3),
    ],
)
def test_date_spine(spark, start, end, days):
    got = sorted(r.dt for r in plans.date_spine(spark, start, end).collect())
    assert got == [(start + timedelta(days=i)).isoformat() for i in range(days)]
    sensors = spark.createDataFrame([("a",), ("b",)], "sensor_id string")
    plan = plans.collection_plan(sensors, start, end)
    assert plan.columns == ["sensor_id", "dt"]
    assert sorted(map(tuple, plan.collect())) == sorted((s, d) for s in "ab" for d in got)
    assert plans.expected_rows(sensors, start, end).first().expected_rows == 2 * days


def test_days_between_columns(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), date(2024, 1, 3)), ("b", date(2024, 1, 3), date(2024, 1, 1)), ("c", None, None)],
        "k string, s date, e date",
    )
    got = sorted((r.k, r.dt) for r in plans.days_between(df, "s", "e").collect())
    assert got == [("a", "2024-01-01"), ("a", "2024-01-02"), ("a", "2024-01-03")]


def test_date_tokens(spark):
    as_of = date(2026, 3, 1)
    tokens = ["yesterday", " TODAY ", "Last_Week", "2026-02-15", "2026-02-30", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in tokens], "t string").select(fx.resolve_date("t", as_of))
    assert [r[0] for r in df.collect()] == [
        date(2026, 2, 28),
        as_of,
        date(2026, 2, 22),
        date(2026, 2, 15),
        None,
        None,
        None,
        None,
    ]


@pytest.mark.parametrize("n", [1, 2, 9, 10, 100, 10_001])
def test_sensor_grid_equals_arithmetic(spark, n):
    side = math.ceil(math.sqrt(n))
    step = 0.5 / side
    rows = plans.sensor_dimension(spark, 52.3676, 4.9041, n).collect()
    assert len(rows) == n
    for ordinal, row in enumerate(rows, start=1):
        i, j = divmod(ordinal - 1, side)
        assert row.sensor_id == f"SENSOR_{ordinal:04d}"
        assert row.region == f"ZONE_{i}_{j}"
        assert row.latitude == pytest.approx(52.3676 - 0.25 + i * step, abs=0.5001e-4)
        assert row.longitude == pytest.approx(4.9041 - 0.25 + j * step, abs=0.5001e-4)


def test_assign_zone_inverts_the_grid(spark):
    for side in (1, 3, 5, 10, 40):
        grid = plans.sensor_dimension(spark, 52.52, 13.405, side * side)
        zoned = plans.assign_zone(grid, 52.52, 13.405, side)
        assert zoned.where("zone = region").count() == side * side
    outside = spark.createDataFrame([(52.0, 13.4), (52.5, 13.7), (None, 13.4)], "latitude double, longitude double")
    assert [r.zone for r in plans.assign_zone(outside, 52.52, 13.405, 5).collect()] == [None] * 3


def test_chunk_ranges_partition_the_range(spark):
    lengths = [1, 15, 16, 17, 32, 33, 400]
    first = date(2024, 1, 1)
    rows = [(n, first, first + timedelta(days=n - 1)) for n in lengths] + [(0, first, first - timedelta(days=1))]
    df = spark.createDataFrame(rows, "n int, s date, e date")
    chunks = plans.chunk_ranges(df, "s", "e").orderBy("n", "chunk").collect()
    assert {r.n for r in chunks} == set(lengths)
    for n in lengths:
        mine = [r for r in chunks if r.n == n]
        assert len(mine) == math.ceil(n / 16)
        assert mine[0].chunk_start == first and mine[-1].chunk_end == first + timedelta(days=n - 1)
        assert all((r.chunk_end - r.chunk_start).days < 16 for r in mine)
        assert all(b.chunk_start == a.chunk_end + timedelta(days=1) for a, b in zip(mine, mine[1:]))


def test_incremental_window(spark):
    jobs = spark.createDataFrame([("resumes",), ("done",), ("new",)], "job_name string")
    checkpoints = spark.createDataFrame(
        [("resumes", "2024-01-10", "success", "t", "x"), ("done", "2024-01-31", "success", "t", "x")], CHECKPOINT_SCHEMA
    )

    def windows(start):
        df = plans.incremental_window(jobs, checkpoints, date(2024, 1, 31), date(2024, 2, 1), start)
        return {r.job_name: (r.status, r.start_date, r.end_date, r.has_work) for r in df.collect()}

    assert windows(date(2024, 1, 20)) == {
        "resumes": ("success", "2024-01-11", "2024-01-31", True),
        "done": ("success", "2024-02-01", "2024-01-31", False),
        "new": ("new", "2024-01-20", "2024-01-31", True),
    }
    assert windows(None)["new"] == ("new", "2024-01-02", "2024-01-31", True)


def test_plan_is_received_plus_missing(spark, readings):
    sensors = spark.createDataFrame([(f"S{i}",) for i in range(7)], "sensor_id string")
    plan = plans.collection_plan(sensors, date(2024, 1, 1), date(2024, 1, 9))
    observed = readings(
        *[
            {"sensor_id": f"S{i}", "dt": f"2024-01-0{d}", "ingestion_timestamp": str(k)}
            for i in range(6)
            for d in range(1, 10)
            for k in range(2)
            if (i * d) % 4 != 1
        ]
    )
    missing = {tuple(r) for r in missing_observations(plan, observed).collect()}
    listed = missing_in_range(sensors, observed, date(2024, 1, 1), date(2024, 1, 9)).collect()
    assert len(listed) == len(missing) and {tuple(r) for r in listed} == missing
    assert missing_in_range(sensors, observed, date(2024, 1, 9), date(2024, 1, 1)).count() == 0
    received = {(r.dt, r.sensor_id) for r in observed.collect()}
    planned = {(r.dt, r.sensor_id) for r in plan.collect()}
    assert missing | received == planned and not missing & received
    assert {d for d, s in missing if s == "S6"} == {f"2024-01-0{d}" for d in range(1, 10)}


def test_expected_vs_actual(spark, readings):
    days = plans.date_spine(spark, date(2024, 1, 14), date(2024, 1, 15))
    sensors = spark.createDataFrame([("a",), ("b",), ("c",)], "sensor_id string")
    observed = readings({"sensor_id": "a"}, {"sensor_id": "b", "temperature_min": None})
    got = {r.dt: tuple(r)[1:] for r in expected_vs_actual(days, sensors, observed).collect()}
    assert got == {"2024-01-14": (3, 0, 3, 0, False), "2024-01-15": (3, 2, 1, 1, True)}
