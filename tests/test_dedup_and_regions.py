"""Newest record per key and regional aggregates, hot groups included."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from fieldgauge.operators import classified, latest_per_key, region_aggregates, transform
from fieldgauge.schemas import OBSERVATION_SCHEMA


def test_later_fraction_wins(readings):
    df = readings(
        {"ingestion_timestamp": "2024-01-15T10:00:00", "precipitation": 1.0},
        {"ingestion_timestamp": "2024-01-15T10:00:00.5", "precipitation": 2.0},
    )
    assert [r.precipitation for r in latest_per_key(df).collect()] == [2.0]


def test_null_order_comes_last_and_ties_break(spark):
    rows = [("d", "s", None, 9, "a"), ("d", "s", "t1", 1, "b"), ("d", "s", "t1", 2, "c"), ("d", "u", None, 1, "e")]
    df = spark.createDataFrame(rows, "dt string, sensor_id string, ingestion_timestamp string, n int, v string")
    kept = latest_per_key(df, tie_break=["n"])
    assert kept.columns == df.columns
    assert {r.sensor_id: r.v for r in kept.collect()} == {"s": "c", "u": "e"}


def test_column_named_twice_in_order_is_fine(readings):
    kept = latest_per_key(readings({}, {}), tie_break=["sensor_id"])
    assert kept.count() == 1


def test_ties_do_not_depend_on_row_order(readings):
    rows = [{"precipitation": float(i)} for i in range(20)]
    kept = [latest_per_key(readings(*r).repartition(n)).first() for r, n in ((rows, 3), (rows[::-1], 5))]
    assert kept[0] == kept[1]


def test_map_side_combine_and_day_filter_reach_the_scan(spark, readings, tmp_path, final_plan):
    path = str(tmp_path / "table")
    readings({}, {"dt": "2024-01-16"}).write.partitionBy("dt").parquet(path)
    stored = spark.read.schema(OBSERVATION_SCHEMA).parquet(path).select(*OBSERVATION_SCHEMA.names)
    plan = final_plan(transform(stored.where(F.col("dt") >= "2024-01-16")))
    assert "partial_max" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(dt" in line for line in scans)


def make_rows(reading, seed):
    """About a third of all rows share one region and day, another few one sensor and day."""
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        hot = rng.random() < 0.34
        rows.append(
            reading(
                dt="2024-01-15" if hot else f"2024-01-{rng.randint(10, 20)}",
                sensor_id=f"S{rng.randint(0, 400)}" if rng.random() < 0.8 else "S0",
                region="HOT" if hot else rng.choice(["A", "B", "C"]),
                temperature_max=rng.choice([None, rng.randint(-160, 640) / 16]),
                temperature_min=rng.randint(-320, 160) / 16,
                precipitation=rng.choice([None, rng.randint(0, 900) / 16]),
                ingestion_timestamp=f"2024-01-21T{i:06d}",
            )
        )
    return rows


def brute_force(rows):
    newest = {}
    for row in rows:
        r = dict(zip(OBSERVATION_SCHEMA.names, row))
        key = (r["dt"], r["sensor_id"])
        if key not in newest or r["ingestion_timestamp"] > newest[key]["ingestion_timestamp"]:
            newest[key] = r
    groups = defaultdict(list)
    for r in newest.values():
        groups[(r["region"], r["dt"])].append(r)
    expected = {}
    for members in groups.values():
        averages = [
            (r["temperature_max"] + r["temperature_min"]) / 2 for r in members if r["temperature_max"] is not None
        ]
        amounts = [r["precipitation"] for r in members if r["precipitation"] is not None]
        for r in members:
            expected[(r["dt"], r["sensor_id"])] = (
                r["ingestion_timestamp"],
                sum(averages) / len(averages) if averages else None,
                sum(amounts) if amounts else None,
            )
    return expected


def test_transform_equals_brute_force(spark, reading):
    rows = make_rows(reading, 7)
    result = transform(spark.createDataFrame(rows, OBSERVATION_SCHEMA).repartition(5)).collect()
    actual = {
        (r.dt, r.sensor_id): (r.ingestion_timestamp, r.region_avg_temp, r.region_total_precipitation) for r in result
    }
    assert len(result) == len(actual)
    assert actual == brute_force(rows)


def test_nulls_in_groups(readings):
    df = classified(
        readings(
            {"sensor_id": "a", "precipitation": 1.0},
            {"sensor_id": "b", "precipitation": None},
            {"sensor_id": "c", "region": "Z", "precipitation": None, "temperature_max": None},
        )
    )
    got = {r.sensor_id: r for r in region_aggregates(df).collect()}
    assert got["a"].region_total_precipitation == got["b"].region_total_precipitation == 1.0
    assert got["c"].region_total_precipitation is None and got["c"].region_avg_temp is None


def test_null_region_and_day_form_groups(spark, readings):
    df = readings({"sensor_id": "a"}, {"sensor_id": "b"}).withColumn("region", F.lit(None).cast("string"))
    assert [r.region_total_precipitation for r in region_aggregates(classified(df)).collect()] == [2.0, 2.0]
    dayless = transform(df.withColumn("dt", F.lit(None).cast("string")))
    assert [(r.sensor_id, r.region_total_precipitation) for r in dayless.orderBy("sensor_id").collect()] == [("a", 2.0), ("b", 2.0)]


def test_totals_share_the_deduplication_shuffle(spark, reading, tmp_path, final_plan):
    path = str(tmp_path / "rows")
    spark.createDataFrame(make_rows(reading, 3), OBSERVATION_SCHEMA).write.parquet(path)
    plan = final_plan(transform(spark.read.parquet(path)))
    assert "ReusedExchange" in plan


def test_hot_region_is_split_over_tasks(spark, readings, tmp_path, final_plan):
    path = str(tmp_path / "rows")
    hot = [{"sensor_id": f"S{i:05d}", "region": "HOT" if i % 3 else f"Z{i}"} for i in range(6000)]
    classified(readings(*hot)).repartition(8).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert "skew=true" in final_plan(region_aggregates(spark.read.parquet(path)))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
