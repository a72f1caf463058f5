"""Writing, replacing, merging and compacting day folders."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldgauge.schemas import OBSERVATION_SCHEMA, TRANSFORMED_SCHEMA
from fieldgauge.sinks import compact_days, file_plan, overwrite_days, upsert_days, write_observations
from fieldgauge.sources import discover_partitions, read_table, recent_readings, register_table


def files(path, day):
    return list(Path(path, f"dt={day}").glob("*.parquet"))


def test_append_adds_and_overwrite_replaces(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    rows = readings({}, {"dt": "2024-01-16"})
    write_observations(rows, path)
    write_observations(rows.where("dt = '2024-01-15'"), path)
    assert read_table(spark, path, OBSERVATION_SCHEMA).count() == 3
    overwrite_days(rows.where("dt = '2024-01-15'"), path)
    stored = read_table(spark, path, OBSERVATION_SCHEMA)
    assert sorted(stored.collect()) == sorted(rows.collect())
    assert all(".snappy." in f.name for f in files(path, "2024-01-15"))


def test_rows_per_file_caps_files_not_rows(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    rows = readings(*[{"sensor_id": f"S{i}"} for i in range(25)])
    write_observations(rows, path, rows_per_file=10)
    assert len(files(path, "2024-01-15")) == 3
    assert read_table(spark, path, OBSERVATION_SCHEMA).count() == 25


def test_small_days_share_tasks(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    rows = readings(*[{"sensor_id": f"S{i}", "dt": f"2024-01-{d:02d}"} for i in range(20) for d in range(1, 6)])
    write_observations(rows.repartition(16), path)
    assert [len(files(path, f"2024-01-{d:02d}")) for d in range(1, 6)] == [1] * 5


def test_file_plan(spark, readings):
    rows = readings(*[{"sensor_id": f"S{i}"} for i in range(25)], {"dt": "2024-01-16"})
    got = {r.dt: (r.row_count, r.target_files) for r in file_plan(rows, rows_per_file=10).collect()}
    assert got == {"2024-01-15": (25, 2), "2024-01-16": (1, 1)}
    assert tuple(file_plan(rows, rows_per_file=10, by=()).first()) == (26, 2)
    assert tuple(file_plan(rows.limit(0), by=()).first()) == (0, 1)


def test_upsert_merges_with_stored_rows(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    assert upsert_days(readings({"sensor_id": "a"}, {"sensor_id": "b"}, {"dt": "2024-01-14"}), path).number == 1
    late = readings(
        {"sensor_id": "b", "ingestion_timestamp": "2024-01-15T11:00:00", "precipitation": 7.0},
        {"sensor_id": "a", "ingestion_timestamp": "2024-01-15T09:00:00", "precipitation": 99.0},
        {"sensor_id": "c", "precipitation": 4.0},
    )
    assert upsert_days(late, path).changed == {"rows": ["2024-01-15"]}
    stored = read_table(spark, path)
    got = {(r.dt, r.sensor_id): (r.precipitation, r.region_total_precipitation) for r in stored.collect()}
    assert got == {
        ("2024-01-15", "a"): (1.0, 12.0),
        ("2024-01-15", "b"): (7.0, 12.0),
        ("2024-01-15", "c"): (4.0, 12.0),
        ("2024-01-14", "SENSOR_0001"): (1.0, 1.0),
    }
    assert upsert_days(readings({}).limit(0), path).number == 2


def test_upsert_refuses_days_that_are_none(readings, tmp_path):
    for day in ("", "2024-02-30", "15.01.2024"):
        with pytest.raises(ValueError, match="ISO"):
            upsert_days(readings({"dt": day}), str(tmp_path / "t"))


def test_compaction(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    rows = readings(*[{"sensor_id": f"S{i}", "dt": f"2024-01-1{i % 3}"} for i in range(60)])
    write_observations(rows, path, rows_per_file=4)
    before = sorted(read_table(spark, path, OBSERVATION_SCHEMA).collect())
    assert len(files(path, "2024-01-10")) == 5
    version = compact_days(spark, path, ["2024-01-10", "2024-01-11", "2024-01-10", "1999-01-01"], OBSERVATION_SCHEMA)
    many = {day: sum(len(list(Path(path, f).glob("*.parquet"))) for f in folders) for day, folders in version.folders().items()}
    assert many == {"2024-01-10": 1, "2024-01-11": 1, "2024-01-12": 5}
    assert version.folders()["2024-01-12"] == ["dt=2024-01-12"]
    assert sorted(read_table(spark, path, OBSERVATION_SCHEMA).collect()) == before
    assert compact_days(spark, path, ["1999-01-01"], OBSERVATION_SCHEMA) == version
    with pytest.raises(ValueError, match="versions"):
        write_observations(rows, path)


def test_day_filter_prunes_folders_and_columns(spark, readings, tmp_path, final_plan):
    path = str(tmp_path / "table")
    write_observations(readings({}, {"dt": "2024-01-16"}), path)
    plan = final_plan(
        read_table(spark, path, OBSERVATION_SCHEMA).where(F.col("dt") >= "2024-01-16").select("sensor_id")
    )
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<sensor_id:string>" in plan


def test_catalog_table(spark, readings, tmp_path, final_plan):
    from fieldgauge.operators import transform

    path = str(tmp_path / "table")
    write_observations(transform(readings({}, {"dt": "2024-01-16"}, {"dt": "2024-01-16", "sensor_id": "A"})), path)
    register_table(spark, "readings_test", path)
    assert recent_readings(spark, "readings_test", "2024-01-01").count() == 0
    discover_partitions(spark, "readings_test")
    assert [f.name for f in spark.table("readings_test").schema.fields if f.name != "dt"] == [
        c for c in TRANSFORMED_SCHEMA.names if c != "dt"
    ]
    assert dict(spark.table("readings_test").dtypes)["dt"] == "string"
    recent = recent_readings(spark, "readings_test", "2024-01-16", limit=1)
    assert recent.columns[:2] == ["sensor_id", "date"]
    assert [tuple(r)[:2] for r in recent.collect()] == [("A", "2024-01-16")]
    plan = final_plan(recent_readings(spark, "readings_test", "2024-01-16"))
    assert "TakeOrderedAndProject" in plan and "dt#" in plan
    assert recent_readings(spark, "readings_test", "2024-01-01").count() == 3
    spark.sql("DROP TABLE readings_test")
