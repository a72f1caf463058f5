"""Payload parsing, typed loads, checkpoints and health history."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.schemas import CHECKPOINT_SCHEMA, OBSERVATION_SCHEMA
from fieldgauge.sinks import append_checkpoint, append_health_results, checkpoint_record
from fieldgauge.operators import health_results
from fieldgauge.sources import (
    load_observations,
    parse_daily_payload,
    read_checkpoint,
    read_health_history,
)


def parse(spark, *payloads, dt="2024-01-15"):
    rows = [
        (f"S{i}", "Z", 1.0, 2.0, "t", dt, p if p is None or isinstance(p, str) else json.dumps(p))
        for i, p in enumerate(payloads)
    ]
    df = spark.createDataFrame(
        rows,
        "sensor_id string, region string, latitude double, longitude double, ingestion_timestamp string, "
        "dt string, payload string",
    )
    out = parse_daily_payload(df)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [
        (f.name, f.dataType) for f in OBSERVATION_SCHEMA.fields
    ]
    return sorted(
        (r.sensor_id, r.dt, r.temperature_max, r.temperature_min, r.precipitation) for r in out.collect()
    )


def test_payload_with_days(spark):
    daily = {
        "time": ["2024-01-01", "2024-01-02", "2024-01-03"],
        "temperature_2m_max": [1, None, "3.5"],
        "temperature_2m_min": [0.5, -1.25e1],
        "precipitation_sum": [],
    }
    assert parse(spark, {"latitude": 9, "daily": daily, "other": [1]}) == [
        ("S0", "2024-01-01", 1.0, 0.5, None),
        ("S0", "2024-01-02", None, -12.5, None),
        ("S0", "2024-01-03", 3.5, None, None),
    ]


def test_payload_for_one_requested_day(spark):
    got = parse(
        spark,
        {"daily": {"temperature_2m_max": [4.0, 9.0], "temperature_2m_min": [1.0], "precipitation_sum": [0.0]}},
        {"daily": {"temperature_2m_max": [None]}},
        {"daily": {}},
        {},
        "{broken",
        None,
        {"daily": {"time": [], "temperature_2m_max": ["n/a"], "precipitation_sum": [2]}},
    )
    assert got == [
        ("S0", "2024-01-15", 4.0, 1.0, 0.0),
        ("S1", "2024-01-15", None, None, None),
        ("S2", "2024-01-15", None, None, None),
        ("S3", "2024-01-15", None, None, None),
        ("S6", "2024-01-15", None, None, 2.0),
    ]


def test_payload_defaults_and_source(spark):
    df = spark.createDataFrame(
        [(None, "", 1.0, 2.0, "t", "2024-01-15", "{}")],
        "sensor_id string, region string, latitude double, longitude double, ingestion_timestamp string, "
        "dt string, payload string",
    )
    row = parse_daily_payload(df).first()
    assert (row.sensor_id, row.region, row.source) == ("UNKNOWN", "UNASSIGNED", "open-meteo")


def test_payload_parsing_has_no_shuffle(spark, final_plan):
    df = spark.createDataFrame(
        [("s", "r", 1.0, 2.0, "t", "{}")],
        "sensor_id string, region string, latitude double, longitude double, ingestion_timestamp string, payload string",
    )
    assert "Exchange" not in final_plan(parse_daily_payload(df))


def test_load_keeps_day_text_and_drops_incomplete(spark, readings, tmp_path):
    path = str(tmp_path / "landed")
    rows = readings({}, {"sensor_id": "b", "precipitation": None}, {"sensor_id": "c", "dt": "2024-01-16"})
    broken = rows.selectExpr(*[c if c != "region" else "nullif(sensor_id, 'c') as region" for c in rows.columns])
    broken.write.partitionBy("dt").parquet(path)
    loaded = load_observations(spark, path)
    assert loaded.columns == OBSERVATION_SCHEMA.names
    assert dict(loaded.dtypes)["dt"] == "string"
    assert sorted(r.sensor_id for r in loaded.collect()) == ["SENSOR_0001", "b"]


def test_load_from_json(spark, readings, tmp_path):
    path = str(tmp_path / "json")
    readings({}).write.json(path)
    assert load_observations(spark, path, "json").collect() == readings({}).collect()


def test_checkpoints(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_checkpoint(spark, path).count() == 0
    append_checkpoint(checkpoint_record(spark, "a", "2024-01-01", "2024-01-02T03:00:00"), path)
    append_checkpoint(checkpoint_record(spark, "a", "2024-01-05", "2024-01-06T03:00:00", "failed", "run-2"), path)
    append_checkpoint(checkpoint_record(spark, "b", "2024-01-03", "2024-01-04T03:00:00"), path)
    assert read_checkpoint(spark, path, "a").first().asDict() == {
        "job_name": "a",
        "last_processed_date": "2024-01-01",
        "status": "failed",
        "updated_at": "2024-01-06T03:00:00",
        "execution_id": "run-2",
    }
    assert read_checkpoint(spark, path).count() == 2
    assert read_checkpoint(spark, path, "c").count() == 0
    assert read_checkpoint(spark, path).schema == CHECKPOINT_SCHEMA


def test_single_document_checkpoint(spark, tmp_path):
    record = {"job_name": "a", "last_processed_date": "2024-01-05", "status": "success", "rows": 3}
    (tmp_path / "latest.json").write_text(json.dumps(record, indent=2))
    assert read_checkpoint(spark, str(tmp_path), "a", single_document=True).first().last_processed_date == "2024-01-05"


def test_checkpoints_of_other_layouts(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"last_date": "2024-01-05", "rows": 7}, indent=2))
    other = T.StructType([T.StructField("last_date", T.StringType()), T.StructField("rows", T.LongType())])
    found = read_checkpoint(spark, str(tmp_path), single_document=True, schema=other)
    assert [tuple(r) for r in found.collect()] == [("2024-01-05", 7)]
    assert read_checkpoint(spark, str(tmp_path / "none"), schema=other).schema == other
    log = str(tmp_path / "log")
    wider = T.StructType([*CHECKPOINT_SCHEMA.fields, T.StructField("rows", T.LongType())])
    rows = [("a", f"2024-01-0{d}", status, f"2024-01-0{d + 1}", "e", d) for d, status in ((1, "success"), (2, "failed"))]
    spark.createDataFrame(rows, wider).write.json(log)
    newest = read_checkpoint(spark, log, "a", schema=wider).first()
    assert (newest.last_processed_date, newest.status, newest.rows) == ("2024-01-01", "failed", 2)


def test_health_history_layouts(spark, tmp_path):
    probes = spark.createDataFrame(
        [(200, 12.345, "2024-01-01T01:02:03", "5", "100", None), (None, None, "2024-01-02T00:00:00", None, None, "Timeout")],
        "http_status int, latency_ms double, timestamp string, rate_limit_remaining string, "
        "rate_limit_limit string, cause string",
    )
    root = tmp_path / "health-checks"
    append_health_results(health_results(probes, "check"), str(root))
    got = {r.day: r for r in read_health_history(spark, str(root)).collect()}
    assert set(got) == {"2024-01-01", "2024-01-02"}
    assert (got["2024-01-01"].status, got["2024-01-01"].latency_ms) == ("success", 12.35)
    assert (got["2024-01-02"].status, got["2024-01-02"].error) == ("failed", "timeout")
    one_day = read_health_history(spark, str(root)).where("day = '2024-01-02'")
    assert [r.error for r in one_day.collect()] == ["timeout"]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    single = tmp_path / "old" / "2024-01-03"
    single.mkdir(parents=True)
    (single / "03-00-00-result.json").write_text(json.dumps({"status": "success", "latency_ms": 1.5}, indent=2))
    row = read_health_history(spark, str(tmp_path / "old"), single_document=True).first()
    assert (row.day, row.status, row.latency_ms) == ("2024-01-03", "success", 1.5)


def test_days_that_are_none_are_rejected_with_a_reason(spark, readings, tmp_path):
    from fieldgauge.sources import rejected_observations

    days = ["2024-01-15", "", "2024-02-30", "15.01.2024", "2024-1-5"]
    rows = readings(*[{"dt": d, "sensor_id": d} for d in days], {"sensor_id": "n"}).withColumn(
        "dt", F.when(F.col("sensor_id") != "n", F.col("dt"))
    )
    got = {r.sensor_id: r.reason for r in rejected_observations(rows).collect()}
    assert got == {**dict.fromkeys(days[1:], "invalid dt"), "n": "missing dt"}
    path = str(tmp_path / "raw")
    rows.write.parquet(path)
    assert [r.dt for r in load_observations(spark, path).collect()] == days[:1]
    assert load_observations(spark, path, rejects=True).count() == 5


def test_tokens_with_any_white_space(spark):
    from datetime import date

    from fieldgauge.functions import resolve_date

    df = spark.createDataFrame([("\tyesterday\n",), ("\r\n Today",)], "t string")
    assert [r[0] for r in df.select(resolve_date("t", date(2024, 1, 2))).collect()] == [date(2024, 1, 1), date(2024, 1, 2)]
