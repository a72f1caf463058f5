"""Request ranges, sketches, cursor chains, log snapshots and presence bitmaps against brute force."""

import json
import random
from datetime import date, datetime, timedelta
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.operators import (
    RANK_ERROR,
    absent_sensors,
    cursor_chain_audit,
    distinct_present,
    latency_percentiles,
    latency_sketches,
    merged_percentiles,
    missing_counts,
    missing_in_range,
    missing_ranges,
    presence_bitmaps,
    sensor_ordinal,
)
from fieldgauge.plans import date_spine, request_ranges
from fieldgauge.sinks import append_checkpoint, compact_checkpoints, remove_covered
from fieldgauge.sources import latest_checkpoints, read_checkpoint

START, END = date(2024, 1, 1), date(2024, 3, 31)
DAYS = [(START + timedelta(days=i)).isoformat() for i in range((END - START).days + 1)]


@pytest.fixture(scope="module")
def presence(spark):
    rng = random.Random(4)
    seen = {f"SENSOR_{i:04d}": {d for d in DAYS if rng.random() < p} for i, p in enumerate((0, 0.02, 0.1, 0.5, 0.9, 1), 1)}
    rows = [(s, d) for s, days in seen.items() for d in days for _ in range(rng.randint(1, 2))]
    rows += [("SENSOR_0002", "2023-12-31"), ("SENSOR_0002", "2024-04-01"), ("SENSOR_0777", DAYS[3])]
    sensors = spark.createDataFrame([(s,) for s in seen], "sensor_id string")
    return seen, sensors, spark.createDataFrame(rows, "sensor_id string, dt string")


def test_ranges_cover_missing_days_exactly(spark, presence):
    seen, sensors, observed = presence
    for width in (1, 7, 16, 1000):
        asked = request_ranges(sensors, observed, START, END, days=width).collect()
        covered = [(r.sensor_id, d) for r in asked for d in DAYS if r.start_date <= d <= r.end_date]
        assert sorted(covered) == sorted((s, d) for s, days in seen.items() for d in DAYS if d not in days)
        assert all(1 <= r.days <= width for r in asked)
        assert all(r.start_date not in seen[r.sensor_id] and r.end_date not in seen[r.sensor_id] for r in asked)
    listed = {(r.sensor_id, r.dt) for r in missing_in_range(sensors, observed, START, END).collect()}
    assert listed == set(covered)
    runs = missing_ranges(sensors, observed, START, END).orderBy("sensor_id", "start_day").collect()
    assert all((b.start_day - a.end_day).days > 1 for a, b in pairwise(runs) if a.sensor_id == b.sensor_id)
    assert request_ranges(sensors, observed, END, START).count() == 0
    assert request_ranges(sensors, observed.limit(0), START, START).count() == len(seen)


def test_bitmaps_equal_exact_queries(spark, presence, tmp_path):
    seen, sensors, observed = presence
    placed = observed.withColumn("ordinal", sensor_ordinal())
    presence_bitmaps(placed).write.parquet(str(tmp_path / "b"))
    bitmaps = spark.read.parquet(str(tmp_path / "b"))
    for first, last in ((DAYS[0], DAYS[0]), (DAYS[5], DAYS[20]), ("2023-01-01", "2025-01-01")):
        inside = F.col("dt").between(first, last)
        assert distinct_present(bitmaps.where(inside)).first().sensors == observed.where(inside).select("sensor_id").distinct().count()
    assert distinct_present(bitmaps.limit(0)).first() is None or distinct_present(bitmaps.limit(0)).first().sensors == 0
    planned = presence_bitmaps(sensors.withColumn("ordinal", sensor_ordinal()), by=())
    counts = missing_counts(bitmaps, planned, date_spine(spark, START, END)).collect()
    assert {r.dt: (r.planned, r.present, r.missing) for r in counts} == {
        d: (6, sum(d in days for days in seen.values()), sum(d not in days for days in seen.values())) for d in DAYS
    }
    gaps = absent_sensors(bitmaps, sensors.withColumn("ordinal", sensor_ordinal()), START, END)
    assert sorted(map(tuple, gaps.collect())) == sorted(map(tuple, missing_in_range(sensors, observed, START, END).collect()))
    assert absent_sensors(bitmaps, sensors.withColumn("ordinal", sensor_ordinal()), END, START).count() == 0


def test_bitmaps_of_many_buckets(spark):
    rows = spark.range(0, 100_000, 3).select(F.lit("2024-01-01").alias("dt"), F.col("id").alias("ordinal"))
    bitmaps = presence_bitmaps(rows)
    assert distinct_present(bitmaps).first().sensors == rows.count() and bitmaps.count() == 5
    sensors = spark.range(100_000).select(F.format_string("SENSOR_%04d", "id").alias("sensor_id"), F.col("id").alias("ordinal"))
    gone = absent_sensors(bitmaps, sensors, date(2024, 1, 1), date(2024, 1, 1)).select(F.expr("int(substring(sensor_id, 8))").alias("i"))
    assert gone.agg(F.count("*"), F.count_if(F.col("i") % 3 == 0)).first() == (66_666, 0)


def test_sketches_stay_within_their_error(spark, tmp_path):
    rng = np.random.default_rng(3)
    days = {f"d{i}": np.round(rng.lognormal(4, 1 + i / 9, 4000 * (i + 1)), 3) for i in range(6)}
    days["ties"] = np.full(5000, 7.0)
    rows = [(d, float(x)) for d, values in days.items() for x in values] + [("d0", None)]
    latency_sketches(spark.createDataFrame(rows, "day string, latency_ms double").repartition(8)).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    for chosen in (["d0"], ["ties"], ["d0", "d5"], list(days)):
        values = np.sort(np.concatenate([days[d] for d in chosen]))
        got = merged_percentiles(stored.where(F.col("day").isin(chosen))).first()
        assert got.checks == len(values)
        for percent in (50, 95, 99):
            low, high = (np.searchsorted(values, got[f"p{percent}"], side=s) / len(values) for s in ("left", "right"))
            assert low - RANK_ERROR <= percent / 100 <= high + RANK_ERROR
    assert merged_percentiles(stored.limit(0)).first()[:2] == (0, None)
    assert merged_percentiles(stored, by=["day"]).count() == len(days)


def test_exact_percentiles_of_crowded_latencies(spark, final_plan):
    rng = np.random.default_rng(5)
    crowded = np.concatenate([rng.uniform(100, 100.2, 40_000), rng.uniform(0, 1e-3, 30_000), [1e9, -1e9, 0.0]])
    rows = [("a", float(x)) for x in crowded] + [("b", 3.0)] * 9 + [("c", float("inf")), ("c", 1.0), ("c", float("-inf"))]
    df = spark.createDataFrame(rows, "day string, latency_ms double")
    got = {r.day: r for r in latency_percentiles(df, percents=(25, 50, 99)).collect()}
    exact = {r.day: r for r in df.groupBy("day").agg(*[F.percentile("latency_ms", p / 100).alias(f"p{p}") for p in (25, 50, 99)]).collect()}
    for p in (25, 50, 99):
        assert got["a"][f"p{p}"] == pytest.approx(exact["a"][f"p{p}"], rel=1e-12)
        assert got["b"][f"p{p}"] == 3.0
    assert got["c"].p50 == 1.0 and (got["a"].checks, got["c"].checks) == (70_003, 3)
    # No task orders more than a small part of a crowded range.
    final_plan(latency_percentiles(df, percents=(50,)))


def brute_chains(rows):
    pages = {}
    for chain, cursor, following in rows:
        pages.setdefault((chain, cursor or ""), []).append(following or "")
    before, named = {}, {}
    for (chain, page), nexts in pages.items():
        for following in set(nexts) - {""}:
            named.setdefault((chain, following), set()).add(page)
    for key, by in named.items():
        if key in pages and key[1]:
            before[key] = (key[0], min(by))
    found = {}
    for key, nexts in pages.items():
        at, steps = key, 0
        while at in before and steps <= len(pages):
            at, steps = before[at], steps + 1
        cycle = steps > len(pages)
        state = "cycle" if cycle else "reached" if at[1] == "" else "lost"
        fork = len(set(nexts)) > 1 or len(named.get(key, ())) > 1
        is_open = any(n and (key[0], n) not in pages for n in nexts)
        found[key] = (len(nexts), None if cycle else at[1], None if cycle else steps, state, fork, is_open)
    return found


def test_cursor_chains_equal_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for chain in range(60):
        names = [f"{rng.randrange(10**6):x}" for _ in range(rng.randint(1, 40))]
        links = list(pairwise([None, *names])) + [(names[-1], None)]
        for _ in range(rng.randrange(4)):  # pages lost, twice, going back, or naming two
            kind, i = rng.randrange(4), rng.randrange(len(links))
            if kind == 0:
                links.pop(i)
            elif kind == 1:
                links.append(links[i])
            elif kind == 2:
                links[i] = (links[i][0], rng.choice([*names, "nowhere"]))
            else:
                links.append((links[i][0], rng.choice(names)))
            if not links:
                break
        rows += [(chain, *link) for link in links]
    rng.shuffle(rows)
    got = cursor_chain_audit(spark.createDataFrame(rows, "chain_id int, cursor string, next_cursor string")).collect()
    assert {(r.chain_id, r.cursor): tuple(r)[2:] for r in got} == brute_chains(rows)
    states = {r.state for r in got}
    assert states == {"reached", "lost", "cycle"} and any(r.is_fork for r in got) and any(r.is_open for r in got)
    empty = spark.createDataFrame([], "chain_id int, cursor string, next_cursor string")
    assert cursor_chain_audit(empty).count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from fieldgauge.operators import pages as module

    n, rounds, scratch = 100_000, [], module._scratch
    monkeypatch.setattr(module, "_scratch", lambda df, label: rounds.append(label) or scratch(df, label))
    order = F.format_string("%06x", (F.col("id") * 7919) % n)
    following = F.when(F.col("id") < n - 1, F.format_string("%06x", ((F.col("id") + 1) * 7919) % n))
    landed = spark.range(n).select(F.lit(1).alias("chain_id"), F.when(F.col("id") > 0, order).alias("cursor"), following.alias("next_cursor"), "id")
    got = cursor_chain_audit(landed).join(landed.select(F.coalesce("cursor", F.lit("")).alias("cursor"), "id"), "cursor")
    assert got.agg(F.count("*"), F.count_if(F.col("position") == F.col("id")), F.count_if(F.col("state") == "reached")).first() == (n, n, n)
    assert rounds.count("pointers") <= 19


def record(job, day, status="success", hour=3):
    return (job, f"2024-01-{day:02d}", status, f"2024-01-{day + 1:02d}T{hour:02d}:00:00", f"e{job}{day}")


def test_snapshots_change_no_answer(spark, tmp_path, monkeypatch):
    from fieldgauge.schemas import CHECKPOINT_SCHEMA
    from fieldgauge.sinks import logs

    log, rng = str(tmp_path / "log"), random.Random(2)
    everything = []

    def answer():
        return sorted(read_checkpoint(spark, log).collect(), key=str)

    def wanted():
        return sorted(latest_checkpoints(spark.createDataFrame(everything, CHECKPOINT_SCHEMA)).collect(), key=str)

    assert compact_checkpoints(spark, log) == 0
    for step in range(5):
        new = [record(f"j{rng.randrange(4)}", rng.randrange(1, 25), rng.choice(["success", "failed"])) for _ in range(6)]
        everything += new
        append_checkpoint(spark.createDataFrame(new, CHECKPOINT_SCHEMA).coalesce(2), log)
        assert answer() == wanted()
        if step == 2:  # dies once the snapshot is written, before it counts
            with monkeypatch.context() as patch:
                patch.setattr(logs, "create_text", lambda *args: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    compact_checkpoints(spark, log)
        elif step != 3:
            compact_checkpoints(spark, log)
        assert answer() == wanted()
    later = datetime.now() + timedelta(minutes=1)
    assert remove_covered(spark, log, datetime.now() - timedelta(days=1)) == 0 and remove_covered(spark, log, later) > 5
    assert answer() == wanted() and remove_covered(spark, log, later) == 0
    # Only the snapshot is left to read: two rows a job at most.
    number, snapshot = logs.latest_snapshot(spark, log)
    assert number == 3 and spark.read.json(f"{log}/{snapshot['folder']}").count() <= 8
    assert compact_checkpoints(spark, log) == number
    assert read_checkpoint(spark, log, "j1").collect() == [r for r in wanted() if r.job_name == "j1"]


def test_payload_stream_accounts_for_every_row(spark, tmp_path, monkeypatch):
    from fieldgauge import versions
    from fieldgauge.schemas import OBSERVATION_SCHEMA
    from fieldgauge.sinks import read_rejects
    from fieldgauge.sources import read_table
    from fieldgauge.streaming import payload_stream
    from pyspark.errors import StreamingQueryException

    source, table, state = (tmp_path / n for n in ("landed", "table", "state"))
    source.mkdir()
    bodies = ['{"daily": {"time": ["%s"], "temperature_2m_max": [5], "temperature_2m_min": [1]}}', "<html>", '{"daily": {}}', None]

    def land(file, n):
        lines = []
        for i in range(n):
            body, day = bodies[i % 4], f"2024-01-{i % 9 + 1:02d}"
            row = {"sensor_id": f"{file}{i}", "region": "Z", "latitude": 1.0, "longitude": 2.0, "ingestion_timestamp": "t1"}
            row |= {"payload": body and (body % day if "%s" in body else body)} | ({"dt": day} if i % 8 != 2 else {})
            lines.append(json.dumps(row))
        (source / f"{file}.json").write_text("\n".join(lines))

    def drain():
        payload_stream(spark, str(source), str(table), str(state), files_per_batch=1).awaitTermination()

    def accounted():
        stored = [r.sensor_id for r in read_table(spark, str(table)).collect()]
        rejects = [(r.sensor_id, r.reason) for r in read_rejects(spark, str(table), OBSERVATION_SCHEMA).collect()]
        return sorted(stored), sorted(rejects)

    def wanted(**files):
        stored = [f"{f}{i}" for f, n in files.items() for i in range(n) if i % 4 == 0 or i % 8 == 6]
        rejects = [(f"{f}{i}", "missing dt" if i % 8 == 2 else "unreadable payload") for f, n in files.items() for i in range(n)]
        return sorted(stored), sorted(r for r in rejects if r[0] not in stored)

    land("a", 40)
    drain()
    assert accounted() == wanted(a=40)
    land("b", 21)
    create = versions._create
    with monkeypatch.context() as patch:  # dies once the commit is made, before the stream notes it
        patch.setattr(versions, "_create", lambda *args: create(*args) and 1 / 0)
        with pytest.raises(StreamingQueryException):
            drain()
    assert accounted() == wanted(a=40, b=21)
    drain()
    assert accounted() == wanted(a=40, b=21)
    land("c", 8)
    with monkeypatch.context() as patch:  # dies before the commit
        patch.setattr(versions, "_create", lambda *args: 1 / 0)
        with pytest.raises(StreamingQueryException):
            drain()
    assert accounted() == wanted(a=40, b=21)
    drain()
    assert accounted() == wanted(a=40, b=21, c=8)
