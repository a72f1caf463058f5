"""Landed API responses to observation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from .. import schemas as S

# Measures arrive as numbers or numeric text; reading them as text keeps a bad
# value from spoiling the rest of the response.
PAYLOAD_DDL = """
    daily struct<
        time: array<string>,
        temperature_2m_max: array<string>,
        temperature_2m_min: array<string>,
        precipitation_sum: array<string>>,
    _malformed string
"""


def _body(json_col: str) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    return F.from_json(json_col, PAYLOAD_DDL, options)


def _is_readable() -> Column:
    body = F.col("_body")
    return body.isNotNull() & (body["_malformed"].isNull() | body["daily"].isNotNull())


def unreadable_payloads(df: DataFrame, json_col: str = "payload", source: str = S.PAYLOAD_SOURCE) -> DataFrame:
    """The responses that :func:`parse_daily_payload` makes no row of, laid out as observations.

    They keep what the request says and the body, next to the ``reason``.
    """
    left_out = df.withColumn("_body", _body(json_col)).where(~F.coalesce(_is_readable(), F.lit(False)))
    given = {"dt": "string", "latitude": "double", "longitude": "double"}

    def column(name: str, kind: str) -> Column:
        if name == "source":
            return F.lit(source)
        return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)

    columns = [column(f.name, given.get(f.name, f.dataType.simpleString())).alias(f.name) for f in S.OBSERVATION_SCHEMA.fields]
    return left_out.select(*columns, F.col(json_col).alias("payload"), F.lit("unreadable payload").alias("reason"))


def parse_daily_payload(df: DataFrame, json_col: str = "payload", source: str = S.PAYLOAD_SOURCE) -> DataFrame:
    """Observation rows from responses whose ``daily`` part holds one array per measure.

    Needs the request columns ``sensor_id, region, latitude, longitude,
    ingestion_timestamp`` and, for responses without ``time``, the requested ``dt``.
    A response with ``time`` gives a row per listed day; one without gives a row
    for the requested day from the first element of each array. Absent, empty,
    short or null-holding arrays give null measures. A response that is not JSON
    gives no row, like a failed request.

    Narrow: no shuffle, each response is expanded where it was read.
    """
    parsed = df.withColumn("_body", _body(json_col)).where(_is_readable())
    daily = F.col("_body.daily")
    time = F.coalesce(daily["time"], F.array().cast("array<string>"))
    requested = F.col("dt") if "dt" in df.columns else F.lit(None).cast("string")
    days = F.when(F.size(time) > 0, time).otherwise(F.array(requested))
    rows = parsed.select("*", F.posexplode(days).alias("_at", "_day"))

    def measure(name: str) -> Column:
        return F.get(daily[name], F.col("_at")).try_cast("double")

    return rows.select(
        F.col("_day").alias("dt"),
        fx.default_fill("sensor_id", S.UNKNOWN_SENSOR).alias("sensor_id"),
        fx.default_fill("region", S.UNASSIGNED_REGION).alias("region"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        measure("temperature_2m_max").alias("temperature_max"),
        measure("temperature_2m_min").alias("temperature_min"),
        measure("precipitation_sum").alias("precipitation"),
        F.lit(source).alias("source"),
        "ingestion_timestamp",
    )
