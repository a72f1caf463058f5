"""Edge cases of bands, flags, scores and fills."""

import pytest
from pyspark.sql import functions as F

from fieldgauge import functions as fx
from fieldgauge.operators import classified, transform
from fieldgauge.schemas import TRANSFORMED_SCHEMA, UNASSIGNED_REGION, UNKNOWN_SENSOR


def test_temperature_bands_and_scores(readings):
    cases = [
        (-1.0, -2.0, "freezing", 100),
        (1.0, -1.0, "cold", 100),
        (12.0, 8.0, "mild", 100),
        (22.0, 18.0, "warm", 100),
        (32.0, 28.0, "hot", 100),
        (None, 5.0, "hot", 25),
        (5.0, None, "hot", 25),
        (float("nan"), 1.0, "hot", 100),
    ]
    df = readings(
        *[
            {"sensor_id": f"S{i}", "temperature_max": high, "temperature_min": low}
            for i, (high, low, _, _) in enumerate(cases)
        ]
    )
    rows = {r.sensor_id: r for r in classified(df).collect()}
    for i, (high, low, band, score) in enumerate(cases):
        row = rows[f"S{i}"]
        assert (row.temp_category, row.data_quality_score) == (band, score), (high, low)
        assert row.is_complete == (score == 100)
    assert rows["S5"].temperature_avg is None and rows["S5"].temperature_range is None


def test_null_average_can_be_told_apart(readings):
    df = classified(readings({"temperature_max": None})).select(
        fx.temperature_category(null_label=None).alias("none"),
        fx.temperature_category(null_label="unknown").alias("named"),
    )
    assert df.first() == (None, "unknown")


def test_precipitation_levels(readings):
    cases = [
        (None, "unknown", 75),
        (0.0, "none", 100),
        (-1.0, "light", 100),
        (2.4, "light", 100),
        (2.5, "moderate", 100),
        (9.99, "moderate", 100),
        (10.0, "heavy", 100),
        (49.9, "heavy", 100),
        (50.0, "extreme", 100),
    ]
    df = readings(*[{"sensor_id": f"S{i}", "precipitation": p} for i, (p, _, _) in enumerate(cases)])
    rows = {r.sensor_id: r for r in classified(df).collect()}
    for i, (amount, level, score) in enumerate(cases):
        assert (rows[f"S{i}"].precipitation_level, rows[f"S{i}"].data_quality_score) == (level, score), amount


def test_worked_example(readings):
    row = classified(readings({"temperature_max": 8.5, "temperature_min": 2.3, "precipitation": 1.2})).first()
    assert row.temperature_max_f == pytest.approx(47.3, abs=1e-9)
    assert row.temperature_min_f == pytest.approx(36.14, abs=1e-9)
    assert row.temperature_range == pytest.approx(6.2, abs=1e-9)
    assert row.temperature_avg == pytest.approx(5.4, abs=1e-9)
    assert (row.temp_category, row.precipitation_level) == ("cold", "light")
    warm = classified(readings({"temperature_max": 25.5, "temperature_min": 20.0})).first()
    assert (warm.temperature_max_f, warm.temp_category) == (77.9, "warm")


def test_transform_layout(readings):
    df = transform(readings({}))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        (f.name, f.dataType) for f in TRANSFORMED_SCHEMA.fields
    ]
    row = df.first()
    assert row.processing_version == "1.0" and row.processed_at is not None


def test_transform_stamp_can_be_fixed(readings):
    row = transform(readings({}), processed_at=F.lit("2024-01-16 03:00:00").cast("timestamp")).first()
    assert str(row.processed_at) == "2024-01-16 03:00:00"


def test_default_fill(spark):
    df = spark.createDataFrame([(None, None), ("", ""), ("a", "b")], "s string, r string").select(
        fx.default_fill("s", UNKNOWN_SENSOR), fx.default_fill("r", UNASSIGNED_REGION)
    )
    assert [tuple(r) for r in df.collect()] == [("UNKNOWN", "UNASSIGNED")] * 2 + [("a", "b")]


def test_request_classes(spark):
    df = spark.createDataFrame(
        [
            (200, None, 5000.0, "10", "100"),
            (429, None, 5000.01, "9", "100"),
            (401, None, 1.0, None, "100"),
            (500, None, 1.0, "x", "100"),
            (404, None, None, "0", "100"),
            (None, "Read timeout", None, "", ""),
            (None, "ConnectionError: refused", None, "5", None),
            (None, None, None, None, None),
            (204, None, 1.0, "1", "10"),
        ],
        "s int, cause string, ms double, left string, allowed string",
    ).select(
        fx.response_outcome("s"),
        fx.health_status("s"),
        fx.failure_class("s", "cause"),
        fx.is_high_latency("ms"),
        fx.is_rate_limit_low("left", "allowed"),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("ok", "success", None, False, False),
        ("rate_limited", "failed", None, True, True),
        ("auth", "failed", None, False, False),
        ("error", "failed", None, False, False),
        ("error", "failed", None, False, True),
        ("error", "failed", "timeout", False, False),
        ("error", "failed", "connection_error", False, False),
        ("error", "failed", "unexpected_error", False, False),
        ("ok", "failed", None, False, False),
    ]


def test_names_and_values_need_no_escaping(spark):
    df = spark.createDataFrame([("", -3.0, 200), (None, None, None), ("x", 40.0, 429)], "`a b` string, `t°` double, `s-1` int")
    found = df.select(
        fx.default_fill(df["a b"], "it's"),
        fx.banded(F.col("`t°`"), [(0, "it's cold")], "o'clock"),
        fx.to_fahrenheit("`t°`"),
        fx.response_outcome(df["s-1"]),
        fx.failure_class("`s-1`", "`a b`"),
    )
    assert [tuple(r) for r in found.collect()] == [
        ("it's", "it's cold", 26.6, "ok", None),
        ("it's", "o'clock", None, "error", "unexpected_error"),
        ("x", "o'clock", 104.0, "rate_limited", None),
    ]
