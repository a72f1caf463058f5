"""Sensor data derived from the shared test tables.

The tables hold no sensor readings, so events stand in for them: a user is a
sensor, an event is a reading. Measures are multiples of 1/16, so double sums are
exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import OBSERVATION_SCHEMA

FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"
CENTRE_LATITUDE, CENTRE_LONGITUDE = 52.52, 13.405


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DAY = "cast(cast(ts as date) as string)"
TIME = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
HIGH = "cast(event_id % 400 as double) / 8D - 10D"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations with ``event_id`` to break ties."""
    return table(spark, sf_dir, "events").select(
        F.expr(DAY).alias("dt"),
        fx.sensor_label("user_id").alias("sensor_id"),
        F.expr("concat('ZONE_', user_id % 4, '_', user_id % 3)").alias("region"),
        F.expr("52.27D + cast(user_id % 4 as double) * 0.125D").alias("latitude"),
        F.expr("13.155D + cast(user_id % 3 as double) * 0.125D").alias("longitude"),
        F.expr(f"case when event_type <> 'error' then {HIGH} end").alias("temperature_max"),
        F.expr(f"case when event_type <> 'error' or user_id % 2 <> 0 then {HIGH} - (user_id % 15) end").alias(
            "temperature_min"
        ),
        F.expr(
            "case event_type when 'view' then 0D when 'signup' then null "
            "else cast(floor(value * 4D) as double) / 16D end"
        ).alias("precipitation"),
        F.lit("events").alias("source"),
        F.expr(TIME).alias("ingestion_timestamp"),
        "event_id",
    )


def sensors(observed: DataFrame) -> DataFrame:
    return observed.select("sensor_id", "region").distinct()


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as request_id",
        f"{DAY} as day",
        "case event_type when 'error' then if(event_id % 2 = 0, 500, 404) when 'signup' then 429 when 'view' then 401 "
        "else element_at(array(200, 201, 204, 302), cast(event_id % 4 + 1 as int)) end as http_status",
        "value * 20D / 3D as latency_ms",
        "user_id % 100 as rate_limit_remaining",
        "100L as rate_limit_limit",
    )


def probe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health probes: an error event got no response, a signup was turned away."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_type when 'error' then null when 'signup' then 503 else 200 end as http_status",
        "value * 50D as latency_ms",
        f"{TIME} as timestamp",
        "case when event_type <> 'click' then cast(user_id % 100 as string) end as rate_limit_remaining",
        "case when event_type <> 'click' then '100' end as rate_limit_limit",
        "case when event_type = 'error' then "
        "case user_id % 3 when 0 then 'Timeout' when 1 then 'ConnectionError' else 'ValueError' end end as cause",
    )


def checkpoint_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as checkpoint records: a customer is a job, an order day a processed day."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('CUSTOMER_', o_custkey) as job_name",
        "cast(cast(o_orderdate as date) as string) as last_processed_date",
        "case when o_orderstatus = 'F' then 'failed' else 'success' end as status",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") as updated_at",
        "cast(o_orderkey as string) as execution_id",
    )


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as result pages, with a page skipped in every fourth chain."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id as chain_id",
        "case when conv_id % 4 = 0 and turn >= 1 then turn + 1 else turn end as page",
        "case when length(text) % 3 <> 0 then cast(turn + 1 as string) end as next_cursor",
        "role = 'user' as has_more",
    )


def drifted_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with a renamed, a retyped and an added column."""
    return (
        observations(spark, sf_dir)
        .withColumnRenamed("temperature_max", "temperature_2m_max")
        .withColumn("latitude", F.col("latitude").cast("float"))
        .select(
            *[c if c != "temperature_max" else "temperature_2m_max" for c in OBSERVATION_SCHEMA.names], "event_id"
        )
    )
