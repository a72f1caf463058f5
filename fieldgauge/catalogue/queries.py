"""Registered queries: name to a function of (session, table folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fx
from .. import operators as op
from .. import plans, sinks, sources, streaming
from ..schemas import (
    OBSERVATION_SCHEMA,
    PAYLOAD_REQUEST_SCHEMA,
    TRANSFORMED_SCHEMA,
    UNASSIGNED_REGION,
    UNKNOWN_SENSOR,
)
from ..session import scratch_path
from . import adapters as ad

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW = OBSERVATION_SCHEMA.names
TIE = ("event_id",)
WITH_ID = T.StructType([*OBSERVATION_SCHEMA.fields, T.StructField("event_id", T.LongType())])
FIRST, LAST = date.fromisoformat(ad.FIRST_DAY), date.fromisoformat(ad.LAST_DAY)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return op.latest_per_key(ad.observations(spark, sf), tie_break=TIE)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(_latest(spark, sf))


# The full transformation and its parts.


@query
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return op.transform(ad.observations(spark, sf), tie_break=TIE).drop("processed_at", "event_id")


@query
def unit_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(ad.observations(spark, sf)).select("event_id", "temperature_max_f", "temperature_min_f")


@query
def derived_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(ad.observations(spark, sf)).select("event_id", "temperature_range", "temperature_avg")


@query
def temp_category(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(ad.observations(spark, sf)).select("event_id", "temperature_avg", "temp_category")


@query
def precipitation_level(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(ad.observations(spark, sf)).select("event_id", "precipitation", "precipitation_level")


@query
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return op.classified(ad.observations(spark, sf)).select("event_id", "is_complete", "data_quality_score")


@query
def default_fill(spark: SparkSession, sf: str) -> DataFrame:
    precipitation = F.col("precipitation")
    holes = ad.observations(spark, sf).select(
        "event_id",
        F.when(precipitation.isNull(), "").when(precipitation > 0, F.col("sensor_id")).alias("sensor_id"),
        F.when(F.col("temperature_max").isNull(), "").when(precipitation > 0, F.col("region")).alias("region"),
    )
    return holes.select(
        "event_id",
        fx.default_fill("sensor_id", UNKNOWN_SENSOR).alias("sensor_id"),
        fx.default_fill("region", UNASSIGNED_REGION).alias("region"),
    )


@query
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    landed = scratch_path(spark, "landed") + "/raw"
    rows = ad.observations(spark, sf).withColumn(
        "region", F.when(F.col("temperature_min").isNotNull(), F.col("region"))
    )
    rows.withColumn("source", F.when(F.col("precipitation").isNotNull(), F.col("source"))).write.parquet(landed)
    return sources.load_observations(spark, landed, schema=WITH_ID)


@query
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that loading leaves out: no source, or a day that is none."""
    landed = scratch_path(spark, "landed") + "/raw"
    rows = ad.observations(spark, sf).withColumn(
        "dt", F.when(F.col("event_id") % 5 == 0, "").when(F.col("event_id") % 5 == 1, "2024-02-30").otherwise(F.col("dt"))
    )
    rows.withColumn("source", F.when(F.col("precipitation").isNotNull(), F.col("source"))).write.parquet(landed)
    return sources.load_observations(spark, landed, schema=WITH_ID, rejects=True).select("event_id", "reason")


@query
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(spark, sf).select(*RAW)


REGION_COLUMNS = ["dt", "sensor_id", "region", "region_avg_temp", "region_total_precipitation"]


@query
def region_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return op.region_aggregates(_labelled(spark, sf)).select(*REGION_COLUMNS)


@query
def quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return op.quality_metrics(_labelled(spark, sf))


@query
def quality_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return op.quality_metrics(_labelled(spark, sf), by=["dt"])


# Planning.


@query
def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Every day between the first and last reading of each sensor."""
    active = (
        ad.observations(spark, sf)
        .groupBy("sensor_id")
        .agg(F.to_date(F.min("dt")).alias("first_day"), F.to_date(F.max("dt")).alias("last_day"))
    )
    return plans.days_between(active, "first_day", "last_day").select("sensor_id", "dt")


@query
def relative_dates(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    token = (
        F.when(kind == "view", " Yesterday ")
        .when(kind == "click", "TODAY")
        .when(kind == "signup", "last_week")
        .when(kind == "error", fx.iso_day("ts"))
        .otherwise("someday")
    )
    return ad.table(spark, sf, "events").select(
        "event_id", token.alias("token"), fx.iso_day(fx.resolve_date(token, F.to_date("ts"))).alias("resolved")
    )


@query
def sensor_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Customers placed on the sensor grid that their number needs."""
    customers = ad.table(spark, sf, "customer").select((F.col("c_custkey") + 1).alias("ordinal"))
    n = customers.agg(F.count("*")).scalar()
    return plans.sensor_grid(customers, "ordinal", n, ad.CENTRE_LATITUDE, ad.CENTRE_LONGITUDE)


@query
def planned_sensors(spark: SparkSession, sf: str) -> DataFrame:
    """As many sensors as there are customers."""
    n = ad.table(spark, sf, "customer").count()
    return plans.sensor_dimension(spark, ad.CENTRE_LATITUDE, ad.CENTRE_LONGITUDE, n)


@query
def collection_plan(spark: SparkSession, sf: str) -> DataFrame:
    return plans.collection_plan(ad.sensors(ad.observations(spark, sf)), FIRST, LAST)


@query
def expected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return plans.expected_rows(ad.sensors(ad.observations(spark, sf)), FIRST, LAST)


@query
def chunk_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Request ranges covering each customer's first to last order."""
    span = (
        ad.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    )
    return plans.chunk_ranges(span, "first_day", "last_day").select(
        "o_custkey", "chunk", fx.iso_day("chunk_start").alias("chunk_start"), fx.iso_day("chunk_end").alias("chunk_end")
    )


@query
def assign_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Sensors of grids of several sides, found again in their zones; and points off the grid."""
    customers = ad.table(spark, sf, "customer").select("c_custkey")
    found = None
    for side in (1, 3, 5, 10, 16, 40):
        ordinal = F.col("c_custkey") % (side * side) + 1
        placed = customers.select(
            "c_custkey",
            F.lit(side).alias("side"),
            fx.grid_latitude(ordinal, F.lit(side), ad.CENTRE_LATITUDE).alias("latitude"),
            fx.grid_longitude(ordinal, F.lit(side), ad.CENTRE_LONGITUDE).alias("longitude"),
        )
        outside = placed.withColumn("side", -F.col("side")).withColumn("latitude", F.col("latitude") + 1.0)
        zoned = plans.assign_zone(placed.unionByName(outside), ad.CENTRE_LATITUDE, ad.CENTRE_LONGITUDE, side)
        zoned = zoned.select("c_custkey", "side", "zone")
        found = zoned if found is None else found.unionByName(zoned)
    return found


@query
def missing_observations(spark: SparkSession, sf: str) -> DataFrame:
    observed = ad.observations(spark, sf)
    return op.missing_observations(plans.collection_plan(ad.sensors(observed), FIRST, LAST), observed)


@query
def missing_by_sensor(spark: SparkSession, sf: str) -> DataFrame:
    observed = ad.observations(spark, sf)
    return op.missing_in_range(ad.sensors(observed), observed, FIRST, LAST)


@query
def expected_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per day, from two days before the first reading to one after the last."""
    days = plans.date_spine(spark, date(2023, 12, 30), date(2024, 1, 31))
    return op.expected_vs_actual(days, ad.sensors(ad.observations(spark, sf)), _latest(spark, sf))


@query
def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    """What each region has still to load, resuming from its last rainless report before the runs began to fail."""
    observed = ad.observations(spark, sf)
    log = observed.where(F.col("precipitation").isNull() & ~F.col("region").startswith("ZONE_3")).select(
        F.col("region").alias("job_name"),
        F.col("dt").alias("last_processed_date"),
        F.when(F.col("dt") < "2024-01-20", "success").otherwise("failed").alias("status"),
        F.col("ingestion_timestamp").alias("updated_at"),
        F.col("event_id").cast("string").alias("execution_id"),
    )
    windows = plans.incremental_window(
        observed.select(F.col("region").alias("job_name")).distinct(),
        sources.latest_checkpoints(log),
        end=date(2024, 1, 25),
        as_of=date(2024, 1, 30),
        start=date(2024, 1, 5),
    )
    # Counted per region and day first, so the join sees one row for each.
    counts = observed.groupBy(F.col("region").alias("job_name"), "dt").agg(F.count("*").alias("rows"))
    pending = plans.rows_between(windows.join(counts, "job_name"), F.col("start_date"), F.col("end_date"))
    keys = ["job_name", "last_processed_date", "status", "start_date", "end_date", "has_work"]
    return pending.groupBy(*keys).agg(F.sum("rows").alias("pending_rows"), F.count("*").alias("pending_days"))


@query
def checkpoint_latest(spark: SparkSession, sf: str) -> DataFrame:
    log = scratch_path(spark, "checkpoints") + "/log"
    sinks.append_checkpoint(ad.checkpoint_log(spark, sf), log)
    return sources.read_checkpoint(spark, log)


# Reading payloads, writing and querying tables.


@query
def parse_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Readings packed into responses of up to 16 days per sensor, then parsed back.

    One reading per sensor and day remains before packing, so a response holds at
    most 16.
    """
    latest = _latest(spark, sf)
    chunk = F.floor(F.datediff(F.to_date("dt"), F.lit(FIRST)) / 16)
    reading = F.struct("dt", "temperature_max", "temperature_min", "precipitation")
    packed = latest.groupBy("sensor_id", "region", "latitude", "longitude", chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(reading)).alias("readings"),
        F.max("ingestion_timestamp").alias("ingestion_timestamp"),
    )
    payload = F.to_json(
        F.struct(
            "latitude",
            "longitude",
            F.struct(
                F.col("readings.dt").alias("time"),
                F.col("readings.temperature_max").alias("temperature_2m_max"),
                F.col("readings.temperature_min").alias("temperature_2m_min"),
                F.col("readings.precipitation").alias("precipitation_sum"),
            ).alias("daily"),
        )
    )
    landed = packed.select(
        "sensor_id", "region", "latitude", "longitude", "ingestion_timestamp", payload.alias("payload")
    )
    return sources.parse_daily_payload(landed)


@query
def write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "table") + "/table"
    sinks.write_observations(ad.observations(spark, sf), path)
    return sources.read_table(spark, path, WITH_ID)


@query
def overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A day written again replaces itself."""
    path = scratch_path(spark, "table") + "/table"
    latest = _latest(spark, sf)
    sinks.overwrite_days(latest, path)
    sinks.overwrite_days(latest.where(F.col("dt") == "2024-01-10"), path)
    return sources.read_table(spark, path, WITH_ID)


@query
def append_union(spark: SparkSession, sf: str) -> DataFrame:
    observed = ad.observations(spark, sf)
    early = observed.where(F.col("dt") <= "2024-01-15")
    late = observed.where(~F.coalesce(F.col("dt") <= "2024-01-15", F.lit(False)))
    return early.unionByName(late)


@query
def compaction_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends leave two files per day; three days are rewritten into one each."""
    root = scratch_path(spark, "table")
    observed = ad.observations(spark, sf)
    sinks.write_observations(observed.where(F.col("precipitation").isNull()), f"{root}/table")
    sinks.write_observations(observed.where(F.col("precipitation").isNotNull()), f"{root}/table")
    sinks.compact_days(spark, f"{root}/table", ["2024-01-02", "2024-01-03", "2024-01-04"], WITH_ID)
    return sources.read_table(spark, f"{root}/table", WITH_ID)


@query
def file_sizing(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.file_plan(ad.observations(spark, sf), rows_per_file=100)


@query
def partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "table") + "/table"
    sinks.write_observations(ad.observations(spark, sf), path)
    return sources.read_table(spark, path, WITH_ID).where(F.col("dt") >= "2024-01-20")


@query
def catalog_query(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "table") + "/table"
    sinks.write_observations(op.transform(ad.observations(spark, sf), tie_break=TIE).drop("event_id"), path)
    # One name for each table folder: a later call replaces the entry of an earlier one.
    name = f"readings_{uuid.uuid5(uuid.NAMESPACE_URL, sf).hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sources.register_table(spark, name, path, TRANSFORMED_SCHEMA)
    sources.discover_partitions(spark, name)
    return sources.recent_readings(spark, name, "2024-01-20")


@query
def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files merged batch by batch into the stored table."""
    root = scratch_path(spark, "stream")
    ad.observations(spark, sf).repartition(4, "event_id").write.parquet(f"{root}/landed")
    extra = T.StructType([T.StructField("event_id", T.LongType())])
    streaming.incremental_stream(
        spark, f"{root}/landed", f"{root}/table", f"{root}/state", extra, TIE, files_per_batch=2
    ).awaitTermination()
    schema = T.StructType([*TRANSFORMED_SCHEMA.fields, *extra.fields])
    return sources.read_table(spark, f"{root}/table", schema).drop("processed_at", "event_id")


@query
def daily_load(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job run twice; the second run resumes after the first."""
    root = scratch_path(spark, "daily")
    observed = ad.observations(spark, sf)
    for end, stamp in ((date(2024, 1, 15), "2024-01-16T03:00:00"), (LAST, "2024-01-31T03:00:00")):
        plans.run_daily(
            observed,
            ad.sensors(observed),
            root,
            "extract_observations",
            end=end,
            as_of=end,
            updated_at=stamp,
            start=FIRST,
            tie_break=TIE,
        )
    return sources.read_table(spark, f"{root}/table").drop("processed_at")


@query
def late_load(spark: SparkSession, sf: str) -> DataFrame:
    """A history in steps of ten days; the middle ten days and a few other rows arrive before the last step only."""
    root = scratch_path(spark, "late")
    observed = ad.observations(spark, sf)
    late = F.col("dt").between("2024-01-11", "2024-01-20") | (F.col("event_id") % 50 == 7)
    for step, landed in enumerate((observed.where(~late), observed.where(~late), observed)):
        plans.run_daily(
            landed,
            ad.sensors(observed),
            root,
            "extract_observations",
            end=LAST,
            as_of=LAST,
            updated_at=f"2024-01-31T0{step}:00:00",
            start=FIRST,
            tie_break=TIE,
            max_days=10,
            late_days=30,
        )
    return sources.read_table(spark, f"{root}/table").drop("processed_at")


# Logs.


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runs") + "/log"
    latest = _labelled(spark, sf)
    silent = spark.range(1).select(F.lit("SENSOR_SILENT").alias("sensor_id"), F.lit("ZONE_0_0").alias("region"))
    sensors = ad.sensors(ad.observations(spark, sf)).unionByName(silent)
    plan = plans.collection_plan(sensors, FIRST, LAST)
    summary = op.run_summary(
        latest,
        op.missing_observations(plan, latest),
        ad.FIRST_DAY,
        ad.LAST_DAY,
        "extract_observations",
        updated_at=F.lit("2024-01-31T03:00:00"),
        planned=sensors,
        received=ad.observations(spark, sf),
    )
    sinks.append_run_summary(summary, path)
    return sources.read_run_summaries(spark, path)


@query
def health_classify(spark: SparkSession, sf: str) -> DataFrame:
    probes = ad.probe_log(spark, sf)
    return op.health_results(probes, "check_service", F.col("event_id").cast("string")).select(
        "*", fx.is_high_latency("latency_ms", 2000).alias("is_high_latency")
    )


@query
def health_summary(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "health") + "/health-checks"
    probes = ad.probe_log(spark, sf)
    sinks.append_health_results(op.health_results(probes, "check_service", F.col("event_id").cast("string")), root)
    return op.health_daily_summary(sources.read_health_history(spark, root))


@query
def failure_alerts(spark: SparkSession, sf: str) -> DataFrame:
    probes = ad.probe_log(spark, sf)
    history = op.health_results(probes, "check_service").withColumn("day", F.substring("timestamp", 1, 10))
    return op.failure_alerts(history, alert_share=0.4).select("day", "checks", "success_rate")


@query
def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    found = op.latency_percentiles(ad.request_log(spark, sf))
    return found.select("day", "checks", *[F.round(f"p{p}", 6).alias(f"p{p}") for p in (50, 95, 99)])


@query
def request_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return op.with_request_flags(ad.request_log(spark, sf))


@query
def request_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return op.request_metrics(ad.request_log(spark, sf), by=["day"])


@query
def rate_limit_low(spark: SparkSession, sf: str) -> DataFrame:
    probes = ad.probe_log(spark, sf).withColumn(
        "rate_limit_limit", F.when(F.col("cause").isNotNull(), "n/a").otherwise(F.col("rate_limit_limit"))
    )
    return probes.select(
        "event_id", fx.is_rate_limit_low("rate_limit_remaining", "rate_limit_limit").alias("is_rate_limit_low")
    )


@query
def page_chain(spark: SparkSession, sf: str) -> DataFrame:
    return op.page_chain_audit(ad.result_pages(spark, sf), max_pages=4)


# Maintenance.


@query
def retention_tier(spark: SparkSession, sf: str) -> DataFrame:
    orders = ad.table(spark, sf, "orders").select("o_orderkey", fx.iso_day("o_orderdate").alias("dt"))
    return op.retention_tier(orders, date(2001, 8, 1))


@query
def live_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = ad.table(spark, sf, "orders").select("o_orderkey", fx.iso_day("o_orderdate").alias("dt"))
    return op.live_rows(orders, date(2001, 8, 1))


@query
def skew_report(spark: SparkSession, sf: str) -> DataFrame:
    return op.partition_skew(ad.observations(spark, sf), factor=1.1)


@query
def value_range(spark: SparkSession, sf: str) -> DataFrame:
    ranges = {"temperature_max": (-5.0, 35.0), "temperature_min": (-10.0, 30.0), "precipitation": (0.5, 8.0)}
    return op.value_range_report(ad.observations(spark, sf), ranges)


@query
def stale_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    latest = sources.latest_checkpoints(ad.checkpoint_log(spark, sf))
    return op.stale_checkpoints(latest, F.to_timestamp(F.lit("2001-08-01T06:00:00")))


@query
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    return op.schema_drift(ad.drifted_observations(spark, sf))


@query
def stored_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Columns day by day of a table whose writer renamed one in the middle of the month."""
    path = scratch_path(spark, "table") + "/table"
    observed = ad.observations(spark, sf)
    renamed = observed.withColumnRenamed("temperature_max", "temperature_2m_max")
    sinks.write_observations(observed.where(F.col("dt") <= "2024-01-15"), path)
    sinks.write_observations(renamed.where(F.col("dt") > "2024-01-15"), path)
    return op.schema_drift(sources.read_merged(spark, path).withColumn("dt", fx.iso_day("dt")), by=["dt"])


# Versions of a table, footers, streams with rejects.


@query
def versioned_read(spark: SparkSession, sf: str) -> DataFrame:
    """Two commits; the first version reads as it was after the second and a compaction."""
    path = scratch_path(spark, "table") + "/table"
    observed = ad.observations(spark, sf)
    first = sinks.upsert_days(observed.where(F.col("event_id") % 2 == 0), path, TIE)
    sinks.upsert_days(observed.where(F.col("event_id") % 2 == 1), path, TIE)
    last = sinks.compact_days(spark, path, ["2024-01-02", "2024-01-03"])
    kept = ["dt", "sensor_id", "ingestion_timestamp", "region_total_precipitation"]
    versions = [sources.read_version(spark, path, v).select(F.lit(v.number).alias("version"), *kept) for v in (first, last)]
    return versions[0].unionByName(versions[1])


def _drifting_table(spark: SparkSession, sf: str) -> str:
    """A week as declared, one with a renamed column, one with a retyped and one with an empty."""
    path = scratch_path(spark, "table") + "/table"
    observed = ad.observations(spark, sf)
    weeks = (
        observed.where(F.col("dt") <= "2024-01-08"),
        observed.where(F.col("dt").between("2024-01-09", "2024-01-15")).withColumnRenamed("temperature_max", "temperature_2m_max"),
        observed.where(F.col("dt").between("2024-01-16", "2024-01-22")).withColumn("latitude", F.col("latitude").cast("float")),
        observed.where(F.col("dt") > "2024-01-22").withColumn("precipitation", F.lit(None).cast("double")),
    )
    for week in weeks:
        sinks.write_observations(week, path)
    return path


@query
def footer_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Which days lack a column, hold it with another type, or hold no value in it, from footers alone."""
    found = op.footer_drift(sources.table_footers(spark, _drifting_table(spark, sf)))
    return found.select("dt", "column_name", "expected_type", "types", "rows_with_value", "status")


@query
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Landed responses, a tenth of them unreadable and a tenth of no day, as stored sensor-days and rejects."""
    root = scratch_path(spark, "stream")
    kind = F.col("event_id") % 10
    day = F.when(kind == 1, "2024-02-30").otherwise(F.col("dt"))
    daily = F.struct(
        F.array(day).alias("time"),
        F.array("temperature_max").alias("temperature_2m_max"),
        F.array("temperature_min").alias("temperature_2m_min"),
        F.array("precipitation").alias("precipitation_sum"),
    )
    payload = F.when(kind == 0, "<html>busy</html>").otherwise(F.to_json(F.struct(daily.alias("daily"))))
    landed = ad.observations(spark, sf).withColumn("payload", payload)
    landed.select(*PAYLOAD_REQUEST_SCHEMA.names).repartition(4, "sensor_id").write.json(f"{root}/landed")
    streaming.payload_stream(
        spark, f"{root}/landed", f"{root}/table", f"{root}/state", files_per_batch=2, payload_source="events"
    ).awaitTermination()
    stored = sources.read_table(spark, f"{root}/table")
    rejects = sinks.read_rejects(spark, f"{root}/table", OBSERVATION_SCHEMA)
    kept = ["dt", "sensor_id", "ingestion_timestamp"]
    return stored.select(F.lit("stored").alias("outcome"), *kept).unionByName(rejects.select(F.col("reason").alias("outcome"), *kept))


@query
def expired_table(spark: SparkSession, sf: str) -> DataFrame:
    """A dry run of expiry, then what table and catalog hold after it, by day."""
    path = scratch_path(spark, "table") + "/table"
    name = f"expiring_{uuid.uuid5(uuid.NAMESPACE_URL, sf).hex}"
    sinks.upsert_days(ad.observations(spark, sf).drop("event_id"), path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sources.register_table(spark, name, path, TRANSFORMED_SCHEMA)
    sources.sync_partitions(spark, name, path)
    dry = sinks.expired_days(spark, path, LAST, expire_after=15)
    found = dry.select(F.lit("dry run").alias("source"), "dt", F.col("age_days").cast("long").alias("n"))
    sinks.expire_days(spark, path, LAST, expire_after=15, name=name)
    for source, table in (("table", sources.read_table(spark, path)), ("catalog", spark.table(name))):
        found = found.unionByName(table.groupBy(F.lit(source).alias("source"), "dt").agg(F.count("*").alias("n")))
    return found


@query
def synced_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog entry brought up to date commit by commit, and the log of layout changes."""
    root = scratch_path(spark, "table")
    path, log = f"{root}/table", f"{root}/layout"
    name = f"synced_{uuid.uuid5(uuid.NAMESPACE_URL, sf).hex}"
    observed = ad.observations(spark, sf)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sources.register_table(spark, name, path, TRANSFORMED_SCHEMA)
    # The second batch brings a column that the layout does not declare, and replaces the tenth of January.
    for batch in (observed.where(F.col("dt") <= "2024-01-10").drop("event_id"), observed.where(F.col("dt") >= "2024-01-10")):
        sinks.upsert_days(batch, path)
        days = sources.sync_partitions(spark, name, path)
        sinks.append_layout_changes(spark, path, days, log, "2024-01-31T03:00:00")
    held = spark.table(name).groupBy(F.lit("catalog").alias("source"), "dt").agg(F.count("*").alias("n"))
    logged = spark.read.json(log).where("status <> 'all_null'")
    return held.unionByName(logged.select(F.concat_ws(" ", "status", "column_name").alias("source"), "dt", F.col("rows_with_value").alias("n")))


@query
def request_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as sensors and order days as readings: what to ask again for two years."""
    sensors = ad.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("sensor_id"))
    observed = ad.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("sensor_id"), fx.iso_day("o_orderdate").alias("dt"))
    return plans.request_ranges(sensors, observed, date(1995, 1, 1), date(1996, 12, 31))


@query
def sketched_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Stored daily sketches merged over three ranges, and whether each percentile's rank is within the stated error."""
    path = scratch_path(spark, "sketches") + "/days"
    log = ad.request_log(spark, sf)
    op.latency_sketches(log).write.parquet(path)
    stored = spark.read.parquet(path)
    ends = F.explode(F.array(*[F.lit(d) for d in ("2024-01-05", "2024-01-20", "2024-01-31")])).alias("until")
    merged = op.merged_percentiles(stored.select("*", ends).where(F.col("day") <= F.col("until")), by=["until"])
    ranked = log.select("day", "latency_ms").join(merged, F.col("day") <= F.col("until")).groupBy("until", "checks")

    def within(percent: int):
        below, upto = F.count_if(F.col("latency_ms") < F.col(f"p{percent}")), F.count_if(F.col("latency_ms") <= F.col(f"p{percent}"))
        wanted, slack = F.count("*") * (percent / 100), F.count("*") * op.RANK_ERROR
        return ((below <= wanted + slack) & (upto >= wanted - slack)).alias(f"p{percent}_within")

    return ranked.agg(F.count("*").alias("rows"), *[within(p) for p in (50, 95, 99)])


@query
def cursor_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as pages known by cursors: chains that are whole, lack a page, go round, or are not ended."""
    turns = ad.table(spark, sf, "conversations").selectExpr(
        "conv_id as chain_id", "conv_id % 4 as kind", "turn", "max(turn) over (partition by conv_id) = turn as is_last"
    )
    pages = turns.where("not (kind = 0 and turn = 1) and not (kind = 1 and turn = 0)").selectExpr(
        "chain_id",
        "case when turn > 0 then concat('c', turn) end as cursor",
        "case when not is_last then concat('c', turn + 1) when kind = 1 then 'c1' when kind = 2 then 'later' end as next_cursor",
        "if(kind = 3 and turn = 1, 2, 1) as copies",
    )
    return op.cursor_chain_audit(pages.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))))


@query
def checkpoint_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A log appended to in three parts with a snapshot after the first two."""
    log = scratch_path(spark, "checkpoints") + "/log"
    records = ad.checkpoint_log(spark, sf)
    for part in range(3):
        sinks.append_checkpoint(records.where(F.pmod(F.xxhash64("execution_id"), F.lit(3)) == part), log)
        if part < 2:
            sinks.compact_checkpoints(spark, log)
    return sources.read_checkpoint(spark, log)


def _stored_bitmaps(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "presence") + "/days"
    observed = ad.observations(spark, sf).withColumn("ordinal", op.sensor_ordinal())
    op.presence_bitmaps(observed).write.partitionBy("dt").parquet(path)
    layout = "bucket long, present binary, dt string"
    return spark.read.schema(layout).parquet(path), observed.select("sensor_id", "ordinal").distinct()


@query
def presence_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sensors of three ranges of days and missing sensors of each day, from stored bitmaps."""
    bitmaps, sensors = _stored_bitmaps(spark, sf)
    ends = F.explode(F.array(*[F.lit(d) for d in ("2024-01-01", "2024-01-07", "2024-01-30")])).alias("until")
    ranges = op.distinct_present(bitmaps.select("*", ends).where(F.col("dt") <= F.col("until")), by=["until"])
    days = plans.date_spine(spark, date(2023, 12, 31), LAST)
    planned = op.presence_bitmaps(sensors, by=())
    missing = op.missing_counts(bitmaps, planned, days)
    return ranges.select(F.lit("present until").alias("what"), F.col("until").alias("dt"), F.col("sensors").alias("n")).unionByName(
        missing.select(F.lit("missing on").alias("what"), "dt", F.col("missing").alias("n"))
    )


@query
def absent_sensors(spark: SparkSession, sf: str) -> DataFrame:
    bitmaps, sensors = _stored_bitmaps(spark, sf)
    return op.absent_sensors(bitmaps, sensors, FIRST, LAST)
