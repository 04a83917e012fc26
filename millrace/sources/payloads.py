"""Landed JSON payloads as flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEATHER = ("main struct<temp double, humidity int, pressure int>, "
           "weather array<struct<description string>>, wind struct<speed double>")
TRADE = "e string, s string, p string, q string, T bigint"


def flatten_weather(df: DataFrame, json_col: str = "payload", *, city: str = "city",
                    timestamp: str = "timestamp") -> DataFrame:
    """One row per readable payload; a city whose payload failed is left out."""
    payload = F.from_json(json_col, WEATHER)
    # A condition on the parsed value alone would be pushed below it and parse a second time; a
    # generator is computed once, and here it drops what the condition rejects.
    parsed = df.select(city, timestamp, F.explode(F.filter(
        F.array(payload), lambda p: p["main"].isNotNull())).alias("_p"))
    return parsed.select(
        city, F.col("_p.main.temp").alias("temperature"),
        F.col("_p.main.humidity").alias("humidity"), F.col("_p.main.pressure").alias("pressure"),
        F.get("_p.weather", F.lit(0))["description"].alias("weather_desc"),
        F.col("_p.wind.speed").alias("wind_speed"), timestamp,
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def parse_trades(df: DataFrame, json_col: str = "value",
                 symbols: list[str] | None = None) -> DataFrame:
    """Trade messages of the wanted symbols; numbers that cannot be read drop the message."""
    trade = F.from_json(json_col, TRADE)
    others = [c for c in df.columns if c != json_col]

    def usable(t):
        wanted = (t["e"] == "trade") & t["p"].try_cast("double").isNotNull() & t["q"].try_cast(
            "double").isNotNull()
        return wanted & F.lower(t["s"]).isin([s.lower() for s in symbols]) if symbols else wanted

    # A generator parses once; a filter on the parsed value would be pushed below and parse again.
    ticks = df.select(F.explode(F.filter(F.array(trade), usable)).alias("_t"), *others)
    return ticks.select(
        F.lower("_t.s").alias("symbol"), F.col("_t.p").try_cast("double").alias("price"),
        F.col("_t.q").try_cast("double").alias("volume"),
        F.timestamp_millis("_t.T").alias("timestamp"), *others)
