"""Weather payloads: flatten, convert, categorise, flag and publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as col
from millrace.plans.registry import query, table
from millrace.session import scratch
from millrace.sources.files import publish, write_csv, read_csv
from millrace.sources.payloads import flatten_weather, require_rows


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as weather responses; an error event is a failed request."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(F.struct(
        F.struct((col.money("value") - 20).alias("temp"), (k + 10).alias("humidity"),
                 (k + 860).alias("pressure")).alias("main"),
        F.array(F.struct(F.concat_ws(" ", "event_type", F.lit("o'er scattered-clouds")).alias(
            "description"))).alias("weather"),
        F.struct((k / 4).alias("speed")).alias("wind"),
    ))
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("city-"), "user_id").alias("city"), F.col("ts").alias(
            "timestamp"),
        F.when(F.col("event_type") == "error", "503 unavailable").otherwise(body).alias("payload"))


WEATHER = r"""(SELECT 'city-' || user_id AS city, (value::DECIMAL(18,2) - 20)::DOUBLE AS temperature,
    (k + 10)::INT AS humidity, (k + 860)::INT AS pressure,
    event_type || ' o''er scattered-clouds' AS weather_desc, k / 4::DOUBLE AS wind_speed,
    ts AS timestamp, event_type
    FROM (SELECT *, regexp_extract(props, '(\d+)', 1)::INT AS k FROM events)
    WHERE event_type <> 'error')"""
TRANSFORMED = f"""(SELECT city, temperature, humidity, pressure,
    upper(event_type[1]) || event_type[2:] || ' O''Er Scattered-Clouds' AS weather_desc, wind_speed,
    timestamp, temperature * 9 / 5 + 32 AS temperature_f,
    CASE WHEN temperature <= 0 THEN 'Cold' WHEN temperature <= 15 THEN 'Mild'
         WHEN temperature <= 25 THEN 'Warm' ELSE 'Hot' END AS temp_category,
    wind_speed * 2.237::DOUBLE AS wind_speed_mph,
    CASE WHEN pressure < 870 THEN 'Check pressure' WHEN humidity > 100 THEN 'Check humidity'
         ELSE 'Good' END AS data_quality FROM {WEATHER} w)"""


@query("weather_payload_flatten", f"SELECT * EXCLUDE (event_type) FROM {WEATHER} w")
def weather_payload_flatten(spark, sf_dir):
    return flatten_weather(payloads(spark, sf_dir))


def transform(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "temperature_f": col.celsius_to_fahrenheit("temperature"),
        "temp_category": col.cut("temperature", [0, 15, 25], ["Cold", "Mild", "Warm", "Hot"]),
        "weather_desc": col.title_case("weather_desc"),
        "wind_speed_mph": col.mps_to_mph("wind_speed"),
        "data_quality": col.quality_flag(),
    })


@query("weather_transform", f"SELECT * FROM {TRANSFORMED} t")
def weather_transform(spark, sf_dir):
    return transform(weather_payload_flatten(spark, sf_dir))


@query("publish_final", f"SELECT * FROM {TRANSFORMED} t")
def publish_final(spark, sf_dir):
    """Collect, hand over as CSV, transform, publish."""
    raw, final = scratch(spark, "weather_raw"), scratch(spark, "weather_final")
    rows = require_rows(weather_payload_flatten(spark, sf_dir), "no weather data was collected")
    write_csv(rows, raw)
    publish(transform(read_csv(spark, raw, rows.schema)), final)
    return spark.read.parquet(final)


@query("title_case", """
    SELECT p_partkey, upper(a[1]) || lower(a[2:]) || ' ' || upper(b[1]) || lower(b[2:]) AS p_name
    FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b
          FROM part)
""")
def title_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", col.title_case("p_name").alias(
        "p_name"))
