"""Metrics, health history, page chains and maintenance reports."""

import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge import operators as op
from fieldgauge.schemas import HEALTH_SCHEMA, OBSERVATION_SCHEMA


def test_quality_metrics(readings):
    df = op.classified(readings({}, {"precipitation": None}, {"temperature_max": None}, {"dt": "2024-01-16"}))
    row = op.quality_metrics(df).first()
    assert tuple(row) == (4, 2, 50.0, 1, 1)
    by_day = {r.dt: r.completeness_rate for r in op.quality_metrics(df, ["dt"]).collect()}
    assert by_day == {"2024-01-15": pytest.approx(100 / 3), "2024-01-16": 100.0}
    assert tuple(op.quality_metrics(df.limit(0)).first()) == (0, 0, 0.0, 0, 0)


def test_quality_metrics_is_one_pass(readings, final_plan):
    assert final_plan(op.quality_metrics(op.classified(readings({})))).count("Scan ") == 1


def test_request_metrics(spark):
    df = spark.createDataFrame(
        [("d", 200, 1.0, "50", "100"), ("d", 500, 6000.0, "9", "100"), ("d", None, None, None, None)],
        "day string, http_status int, latency_ms double, rate_limit_remaining string, rate_limit_limit string",
    )
    assert tuple(op.request_metrics(df, ["day"]).first()) == ("d", 3, 2, 2 / 3, 0, 0, 1, 1)
    assert tuple(op.request_metrics(df.limit(0)).first()) == (0, 0, 0.0, 0, 0, 0, 0)
    codes = [(c, 1.0, "9", "10") for c in (200, 201, 204, 302, 401, 404, 429)]
    many = spark.createDataFrame(codes, df.drop("day").schema)
    assert tuple(op.request_metrics(many).first())[:5] == (7, 1, 1 / 7, 1, 1)


def test_health_summary_and_alerts(spark):
    def check(status, latency=None, error=None):
        return (status, 200, latency, "t", None, None, error, None, "j", "x")

    rows = [check("success", 100.0)] * 9 + [check("failed", None, "timeout")]
    good = spark.createDataFrame(rows, HEALTH_SCHEMA).withColumn("day", F.lit("2024-01-01"))
    bad = spark.createDataFrame(rows + [check("failed", None, "connection_error")], HEALTH_SCHEMA).withColumn(
        "day", F.lit("2024-01-02")
    )
    summary = {r.day: r for r in op.health_daily_summary(good.union(bad)).collect()}
    assert (summary["2024-01-01"].success_rate, summary["2024-01-01"].is_alert) == (0.9, False)
    assert summary["2024-01-01"].avg_latency_ms == 100.0 and summary["2024-01-02"].timeouts == 1
    assert [r.day for r in op.failure_alerts(good.union(bad)).collect()] == ["2024-01-02"]
    lost = op.health_daily_summary(good.where("status = 'failed'")).first()
    assert lost.avg_latency_ms is None and lost.is_alert


def test_percentiles_equal_numpy(spark):
    rng = random.Random(4)
    groups = {
        "one": [5.0],
        "two": [1.0, 2.0],
        "same": [3.5] * 40,
        "many": [rng.lognormvariate(4, 1) for _ in range(997)],
        "hot": [round(rng.choice([1.5, 2.5, rng.random() * 100]), 2) for _ in range(2000)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("one", None)], "day string, latency_ms double")
    rows = {r.day: r for r in op.latency_percentiles(df.repartition(7)).collect()}
    for name, values in groups.items():
        got = rows[name]
        assert got.checks == len(values)
        assert (got.p50, got.p95, got.p99) == pytest.approx(tuple(np.percentile(values, [50, 95, 99])), rel=1e-12)


def test_percentiles_of_all_and_of_odd_groups(spark):
    rng = random.Random(5)
    values = [rng.choice([-1, 1]) * rng.lognormvariate(0, 6) for _ in range(1501)] + [0.0, -0.0, 1e300]
    df = spark.createDataFrame([(None, v) for v in values], "day string, latency_ms double")
    expected = pytest.approx(tuple(np.percentile(values, [0, 5, 50, 100])), rel=1e-12)
    for by in ((), ("day",)):
        row = op.latency_percentiles(df, by, (0, 5, 50, 100)).first()
        assert row.checks == len(values) and (row.p0, row.p5, row.p50, row.p100) == expected
    odd = spark.createDataFrame([("n", 1.0), ("n", float("nan")), ("n", float("inf"))], df.schema)
    row = op.latency_percentiles(odd, percents=(0, 50, 100)).first()
    assert (row.p0, row.p50) == (1.0, float("inf")) and np.isnan(row.p100)


def test_percentiles_order_one_piece_of_a_range_at_a_time(spark, final_plan):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("day"), (F.col("id") * 1.5).alias("latency_ms"))
    plan = final_plan(op.latency_percentiles(df))
    by_value = [line for line in plan.splitlines() if " Window [" in line and ", [_value#" in line]
    assert by_value and all(re.search(r"\[day#\d+, _range#\d+L?, _piece#\d+L?\], \[_value#", line) for line in by_value)


def test_page_chains(spark):
    rows = [
        ("full", 1, "c", True),
        ("full", 2, None, False),
        ("gap", 1, "c", True),
        ("gap", 4, "", None),
        ("gap", 4, "", None),
        ("open", 1, "c", False),
        ("open", 2, None, True),
        ("capped", 1, "c", True),
        ("capped", 2, "c", True),
        ("capped", 3, "c", True),
        ("early", 1, None, False),
        ("early", 2, "c", True),
    ]
    df = spark.createDataFrame(rows, "chain_id string, page int, next_cursor string, has_more boolean")
    got = {r.chain_id: r for r in op.page_chain_audit(df, max_pages=3).collect()}

    def view(name):
        r = got[name]
        return (r.pages, r.missing_pages, r.duplicate_pages, r.first_end_page, r.is_ended, r.is_capped, r.is_terminated)

    assert view("full") == (2, 0, 0, 2, True, False, True)
    assert view("gap") == (2, 2, 1, 4, True, False, True)
    assert view("open") == (2, 0, 0, None, False, False, False)
    assert view("capped") == (3, 0, 0, None, False, True, True)
    assert view("early") == (2, 0, 0, 1, False, False, False)


def test_retention(readings):
    as_of = date(2026, 1, 1)
    ages = [0, 89, 90, 454, 455, 1000]
    df = readings(*[{"sensor_id": str(a), "dt": (as_of - timedelta(days=a)).isoformat()} for a in ages])
    tiers = {r.age_days: r.tier for r in op.retention_tier(df, as_of).collect()}
    assert tiers == {0: "hot", 89: "hot", 90: "cold", 454: "cold", 455: "expired", 1000: "expired"}
    assert sorted(int(r.sensor_id) for r in op.live_rows(df, as_of).collect()) == [0, 89, 90, 454]


def test_skew(readings):
    df = readings(*[{"sensor_id": str(i)} for i in range(8)], {"dt": "2024-01-16"}, {"dt": "2024-01-17"}, {"dt": "2024-01-18"})
    got = {r.dt: (r.row_count, r.is_skewed) for r in op.partition_skew(df).collect()}
    assert got["2024-01-15"] == (8, True) and got["2024-01-16"] == (1, False)


def test_schema_drift(readings):
    df = readings({}, {"precipitation": None})
    assert {r.status for r in op.schema_drift(df).collect()} == {"ok"}
    changed = df.drop("region").withColumn("latitude", F.col("latitude").cast("string")).withColumn("extra", F.lit(1))
    got = {r.column_name: (r.expected_type, r.actual_type, r.status, r.rows_with_value) for r in op.schema_drift(changed).collect()}
    assert got["region"] == ("string", None, "missing", 0)
    assert got["latitude"] == ("double", "string", "type_changed", 2)
    assert got["extra"] == (None, "int", "unexpected", 2)
    assert got["precipitation"] == ("double", "double", "ok", 1)
    assert len(got) == len(OBSERVATION_SCHEMA.names) + 1


def test_value_ranges(readings):
    df = readings(*[{"precipitation": p} for p in (None, -1.0, 0.0, 5.0, 10.0, 10.5)])
    row = op.value_range_report(df, {"precipitation": (0, 10)}).first()
    assert tuple(row) == ("precipitation", 1, 1, 3, 1)


def test_stale_checkpoints(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", "2024-01-01T06:00:00"), ("b", "2024-01-01", "2024-01-01T05:59:59")],
        "job_name string, last_processed_date string, updated_at string",
    )
    rows = {r.job_name: r for r in op.stale_checkpoints(df, F.to_timestamp(F.lit("2024-01-02 06:00:00"))).collect()}
    assert (rows["a"].age_hours, rows["a"].is_stale, rows["b"].is_stale) == (24.0, False, True)
