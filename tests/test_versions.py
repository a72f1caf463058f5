"""Commits: what readers see, second writers, deaths, replays and old files."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldgauge import versions
from fieldgauge.operators import transform
from fieldgauge.schemas import OBSERVATION_SCHEMA
from fieldgauge.session import create_text, read_text
from fieldgauge.sinks import compact_days, read_rejects, upsert_days, write_observations
from fieldgauge.sources import read_table, read_version, rejected_observations
from fieldgauge.versions import Change, commit, latest_version, read_version_record, remove_unused, version_numbers

STEPS = ("_write", "list_folders", "create_text")


class Lost(Exception):
    pass


def sensors_in(spark, path, version=None):
    stored = read_table(spark, path) if version is None else read_version(spark, path, version)
    return sorted((r.dt, r.sensor_id) for r in stored.collect())


def files(path):
    return {p.relative_to(path): p.read_bytes() for p in Path(path).rglob("*.parquet")}


def two_days(sensor):
    return {"sensor_id": sensor}, {"sensor_id": sensor, "dt": "2024-01-16"}


def pairs(sensors, days=("2024-01-15", "2024-01-16")):
    return [(day, sensor) for day in days for sensor in sensors]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_readers_see_whole_versions_between_all_steps(spark, readings, path, monkeypatch):
    upsert_days(readings(*two_days("a"), {"sensor_id": "z", "dt": "2024-01-01"}), path)
    before, seen = sensors_in(spark, path), []
    stored = files(path)
    for step in STEPS:
        inner = getattr(versions, step)

        def watched(*args, inner=inner):
            seen.append(sensors_in(spark, path))
            done = inner(*args)
            seen.append(sensors_in(spark, path))
            return done

        monkeypatch.setattr(versions, step, watched)
    upsert_days(readings(*two_days("b")), path)
    assert seen[:-1] == [before] * (len(seen) - 1) and len(seen) >= 6
    assert seen[-1] == sensors_in(spark, path) == [("2024-01-01", "z"), *pairs("ab")]
    # Nothing that was there has moved or changed, so a reader of the old version goes on.
    assert stored.items() <= files(path).items()
    assert sensors_in(spark, path, read_version_record(spark, path, 1)) == before


def overtaken(spark, monkeypatch, commits):
    """The next commit finds that these were quicker, just before it creates its manifest."""
    create, waiting, inside = versions._create, list(commits), []

    def late(*args):
        if waiting and not inside:
            inside.append(True)
            waiting.pop(0)()
            inside.clear()
        return create(*args)

    monkeypatch.setattr(versions, "_create", late)


def counted_writes(monkeypatch):
    write, written = versions._write, []
    monkeypatch.setattr(versions, "_write", lambda *args: written.append(args) or write(*args))
    return written


def test_second_writer_of_a_day_builds_it_anew(spark, readings, path, monkeypatch):
    upsert_days(readings(*two_days("a")), path)
    with monkeypatch.context() as patch:
        written = counted_writes(patch)
        overtaken(spark, patch, [lambda: upsert_days(readings({"sensor_id": "b"}), path)])
        upsert_days(readings(*two_days("c")), path)
    assert sensors_in(spark, path) == [*pairs("abc", ["2024-01-15"]), *pairs("ac", ["2024-01-16"])]
    assert version_numbers(spark, path) == [1, 2, 3] and len(written) == 3


def test_second_writer_of_other_days_keeps_its_files(spark, readings, path, monkeypatch):
    upsert_days(readings(*two_days("a")), path)
    with monkeypatch.context() as patch:
        written = counted_writes(patch)
        other = [lambda day=day: upsert_days(readings({"dt": day, "sensor_id": "b"}), path) for day in ("2024-02-01", "2024-02-02")]
        overtaken(spark, patch, other)
        upsert_days(readings(*two_days("c")), path)
    assert sensors_in(spark, path) == [*pairs("ac"), ("2024-02-01", "b"), ("2024-02-02", "b")]
    assert version_numbers(spark, path) == [1, 2, 3, 4] and len(written) == 3


def test_a_writer_that_never_gets_through_gives_up(spark, readings, path, monkeypatch):
    upsert_days(readings({"sensor_id": "a"}), path)
    again = [lambda i=i: upsert_days(readings({"sensor_id": f"b{i}"}), path) for i in range(9)]
    overtaken(spark, monkeypatch, again[: versions.ATTEMPTS])
    with pytest.raises(RuntimeError, match="kept changing"):
        commit(spark, path, [Change(lambda base: transform(readings({"sensor_id": "c"})), ["2024-01-15"])])
    assert ("2024-01-15", "c") not in sensors_in(spark, path)


@pytest.mark.parametrize("step", STEPS)
def test_death_at_any_step_changes_nothing(spark, readings, path, monkeypatch, step):
    upsert_days(readings(*two_days("a")), path)

    def die(*args):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, die)
        with pytest.raises(Lost):
            upsert_days(readings(*two_days("b")), path)
    assert sensors_in(spark, path) == pairs("a")
    upsert_days(readings(*two_days("b")), path)
    assert sensors_in(spark, path) == pairs("ab")
    later = datetime.now() + timedelta(minutes=1)
    gone = remove_unused(spark, path, later)
    assert len(gone) == (4 if step != "_write" else 2)  # what the dead writer left, and what was replaced
    assert sensors_in(spark, path) == pairs("ab")


def test_old_files_go_by_age_and_named_ones_stay(spark, readings, path):
    write_observations(transform(readings(*two_days("a"))), path)
    upsert_days(readings({"sensor_id": "b"}), path)
    upsert_days(readings({"sensor_id": "c"}), path)
    early, later = datetime.now() - timedelta(days=1), datetime.now() + timedelta(minutes=1)
    assert remove_unused(spark, path, early) == [] and version_numbers(spark, path) == [1, 2]
    first = read_version_record(spark, path, 1)
    assert remove_unused(spark, path, later) == ["dt=2024-01-15", first.folders()["2024-01-15"][0]]
    assert version_numbers(spark, path) == [2] and remove_unused(spark, path, later) == []
    assert sensors_in(spark, path) == [*pairs("abc", ["2024-01-15"]), ("2024-01-16", "a")]


def test_replays_double_nothing(spark, readings, path):
    rows = transform(readings({"sensor_id": "a"}))
    for key in (0, 0, 1, 0, 1):
        commit(spark, path, [Change(lambda base: rows)], writer="w", key=key)
    commit(spark, path, [Change(lambda base: rows)], writer="other", key=0)
    assert sensors_in(spark, path) == [("2024-01-15", "a")] * 3
    assert latest_version(spark, path).writers == {"w": 1, "other": 0}


def test_rows_and_rejects_are_one_commit(spark, readings, path):
    bad = rejected_observations(readings({"dt": "nonsense", "sensor_id": "x"}))
    upsert_days(readings({"sensor_id": "a"}), path, rejects=bad, writer="w", key=7)
    upsert_days(readings({"sensor_id": "a"}), path, rejects=bad, writer="w", key=7)
    upsert_days(readings({}).limit(0), path, rejects=bad, writer="w", key=8)
    got = read_rejects(spark, path, OBSERVATION_SCHEMA).select("sensor_id", "reason", "batch").collect()
    assert sorted(map(tuple, got)) == [("x", "invalid dt", 7), ("x", "invalid dt", 8)]
    assert sensors_in(spark, path) == [("2024-01-15", "a")]
    assert read_rejects(spark, path + "none", OBSERVATION_SCHEMA).count() == 0


def test_a_day_replaced_by_no_rows_leaves(spark, readings, path):
    upsert_days(readings(*two_days("a")), path)
    version = commit(spark, path, [Change(None, ["2024-01-15"])])
    assert sensors_in(spark, path) == [("2024-01-16", "a")] and version.changed == {"rows": ["2024-01-15"]}
    commit(spark, path, [Change(None, ["2024-01-16"])])
    assert read_table(spark, path).count() == 0


def test_only_named_folders_are_read(spark, readings, path, final_plan):
    upsert_days(readings(*two_days("a")), path)
    upsert_days(readings({"sensor_id": "b"}), path)
    assert len(read_table(spark, path).inputFiles()) == 2
    assert len(read_table(spark, path, since="2024-01-16").inputFiles()) == 1
    plan = final_plan(read_table(spark, path, OBSERVATION_SCHEMA).where(F.col("dt") >= "2024-01-16").select("sensor_id"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<sensor_id:string>" in plan


def test_compaction_of_appended_rows(spark, readings, path):
    for sensor in "abc":
        commit(spark, path, [Change(lambda base, s=sensor: transform(readings(*two_days(s))))])
    assert len(latest_version(spark, path).folders()["2024-01-15"]) == 3
    compact_days(spark, path, ["2024-01-15"])
    many = {day: len(folders) for day, folders in latest_version(spark, path).folders().items()}
    assert many == {"2024-01-15": 1, "2024-01-16": 3} and sensors_in(spark, path) == pairs("abc")


def test_observed_metrics_count_each_row_once(spark, readings, path):
    rows = readings(*[{"sensor_id": f"S{i}", "dt": f"2024-01-1{i % 4}"} for i in range(40)]).repartition(7)
    version = upsert_days(rows, path, observe=[F.count("*").alias("rows"), F.count_if(F.col("dt") == "2024-01-11").alias("one")])
    assert version.metrics == {"rows": 40, "one": 10}
    assert read_version_record(spark, path, 1) == version


def test_a_file_is_created_once(spark, tmp_path):
    (tmp_path / "f").mkdir()
    assert create_text(spark, str(tmp_path / "f" / "x"), "one") and not create_text(spark, str(tmp_path / "f" / "x"), "two")
    assert read_text(spark, str(tmp_path / "f" / "x")) == "one"
    assert [p.name for p in (tmp_path / "f").iterdir() if not p.name.endswith(".crc")] == ["x"]
