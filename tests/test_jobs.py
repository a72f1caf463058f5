"""The daily load and the incremental stream, end to end."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldgauge.operators import transform
from fieldgauge.plans import run_daily
from fieldgauge.schemas import RUN_SUMMARY_SCHEMA
from fieldgauge.sources import read_checkpoint, read_run_summaries, read_table
from fieldgauge.streaming import incremental_stream
from fieldgauge.versions import latest_version


def comparable(df):
    return sorted(map(tuple, df.drop("processed_at").collect()), key=repr)


@pytest.fixture
def month(readings):
    return readings(
        *[
            {
                "sensor_id": f"S{i}",
                "dt": f"2024-01-{d:02d}",
                "region": f"Z{i % 2}",
                "precipitation": None if d == 3 else float(i),
                "ingestion_timestamp": f"2024-01-{d:02d}T{k}",
            }
            for i in range(5)
            for d in range(1, 9)
            for k in range(2)
            if (i, d) != (4, 2)
        ]
    )


def test_daily_load_resumes(spark, month, tmp_path):
    root = str(tmp_path)
    sensors = spark.createDataFrame([(f"S{i}",) for i in range(5)], "sensor_id string")

    def run(end, day):
        return run_daily(
            month, sensors, root, "load", end, as_of=end, updated_at=f"2024-01-{day:02d}T03:00:00", start=date(2024, 1, 1)
        )

    first = run(date(2024, 1, 4), 5).first()
    assert (first.start_date, first.end_date) == ("2024-01-01", "2024-01-04")
    assert (first.num_sensors, first.rows_processed, first.failed_fetches) == (5, 38, 1)
    assert first.data_quality_rate == pytest.approx(14 / 19 * 100)
    assert run(date(2024, 1, 4), 6) is None
    second = run(date(2024, 1, 8), 9).first()
    assert (second.start_date, second.rows_processed, second.failed_fetches) == ("2024-01-05", 40, 0)
    assert read_checkpoint(spark, f"{root}/checkpoints", "load").first().last_processed_date == "2024-01-08"
    runs = read_run_summaries(spark, f"{root}/runs", "load")
    assert runs.schema == RUN_SUMMARY_SCHEMA and runs.count() == 2
    assert read_run_summaries(spark, f"{root}/none").count() == 0
    assert comparable(read_table(spark, f"{root}/table")) == comparable(transform(month))
    with pytest.raises(ValueError, match="no observations"):
        run(date(2024, 1, 9), 10)
    assert read_checkpoint(spark, f"{root}/checkpoints", "load").first().last_processed_date == "2024-01-08"


def test_summary_counts_are_observed_while_writing(spark, month, tmp_path, monkeypatch):
    from fieldgauge.plans import daily

    root, counted = str(tmp_path), []
    sensors = spark.createDataFrame([(f"S{i}",) for i in range(5)], "sensor_id string")
    summarise = daily.run_summary

    def watched(*args, **given):
        counted.append(given.pop("counted"))
        return summarise(*args, **given)  # read back from the table

    monkeypatch.setattr(daily, "run_summary", watched)
    for end, stamp in ((date(2024, 1, 4), "2024-01-05T03:00:00"), (date(2024, 1, 8), "2024-01-09T03:00:00")):
        read_back = run_daily(month, sensors, root, "load", end, end, stamp, start=date(2024, 1, 1)).first()
        rows, complete = counted[-1]
        assert read_back.data_quality_rate == pytest.approx(100 * complete / rows)
    assert counted == [(19, 14), (20, 20)]
    # A window with days that this run does not write is counted from the table.
    version = latest_version(spark, f"{root}/table")
    assert daily.observed_counts(version, ["2024-01-05"], "2024-01-05", "2024-01-08") is None


def test_history_in_steps(spark, month, tmp_path):
    root = str(tmp_path)
    sensors = spark.createDataFrame([(f"S{i}",) for i in range(5)], "sensor_id string")
    steps = []
    for step in range(10):
        end = date(2024, 1, 8)
        stamp = f"2024-01-09T03:00:{step:02d}"
        summary = run_daily(
            month, sensors, root, "load", end, as_of=end, updated_at=stamp, start=date(2024, 1, 1), max_days=3
        )
        if summary is None:
            break
        steps.append(tuple(summary.select("start_date", "end_date").first()))
    assert steps == [("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-06"), ("2024-01-07", "2024-01-08")]
    assert comparable(read_table(spark, f"{root}/table")) == comparable(transform(month))


def test_history_with_a_gap_and_a_silent_sensor(spark, readings, tmp_path):
    root = str(tmp_path)
    sensors = spark.createDataFrame([("a",), ("silent",)], "sensor_id string")
    rows = readings({"sensor_id": "a", "dt": "2024-01-01"}, {"sensor_id": "a", "dt": "2024-01-09"})
    end, steps = date(2024, 1, 9), []
    for step in range(9):
        stamp = f"2024-01-10T03:00:{step:02d}"
        done = run_daily(rows, sensors, root, "load", end, end, stamp, start=date(2024, 1, 1), max_days=3)
        if done is None:
            break
        steps.append(tuple(done.select("num_sensors", "rows_processed", "failed_fetches").first()))
    assert steps == [(2, 1, 5), (2, 0, 6), (2, 1, 5)]
    assert read_table(spark, f"{root}/table").count() == 2


def test_late_and_missing_days_are_loaded(spark, readings, tmp_path):
    root = str(tmp_path)
    sensors = spark.createDataFrame([("a",), ("b",)], "sensor_id string")
    stored = [{"sensor_id": "a", "dt": f"2024-01-0{d}", "ingestion_timestamp": "t1"} for d in range(1, 5)]
    late = [
        {"sensor_id": "b", "dt": "2024-01-02"},
        {"sensor_id": "a", "dt": "2024-01-03", "precipitation": 9.0, "ingestion_timestamp": "t2"},
        {"sensor_id": "a", "dt": "2023-12-31"},
    ]

    def run(rows, day, late_days):
        end = date(2024, 1, day)
        stamp = f"2024-01-{day + 1:02d}T0{late_days}:00:00"
        return run_daily(rows, sensors, root, "load", end, end, stamp, start=date(2024, 1, 1), late_days=late_days)

    def files(day):
        return latest_version(spark, f"{root}/table").folders()[day]

    run(readings(*stored), 4, 5)
    untouched = files("2024-01-01")
    assert run(readings(*stored, *late), 4, 0) is None
    assert comparable(read_table(spark, f"{root}/table")) == comparable(transform(readings(*stored)))
    assert run(readings(*stored, *late), 4, 5) is None
    assert comparable(read_table(spark, f"{root}/table")) == comparable(transform(readings(*stored, *late[:2])))
    assert files("2024-01-01") == untouched
    later = {"sensor_id": "b", "dt": "2024-01-05"}
    done = run(readings(*stored, *late, later, {"sensor_id": "b", "dt": "2024-01-04"}), 5, 3).first()
    assert (done.start_date, done.rows_processed, done.failed_fetches) == ("2024-01-05", 1, 1)
    assert read_table(spark, f"{root}/table").where("sensor_id = 'b'").count() == 3


def test_stream_merges_late_files(spark, month, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("landed", "table", "state"))

    def drain(files=None):
        incremental_stream(spark, source, table, state, files_per_batch=files).awaitTermination()
        return comparable(read_table(spark, table))

    even = F.xxhash64("sensor_id", "dt", "ingestion_timestamp") % 2 == 0
    early, late = month.where(even), month.where(~even)
    early.repartition(3).write.parquet(source)
    assert drain(files=1) == comparable(transform(early))
    assert drain() == comparable(transform(early))
    late.write.mode("append").parquet(source)
    assert drain() == comparable(transform(month))
