"""Window queries over the events table; the same functions run on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.plans.runtime import read_table
from lamella.streaming import series


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    t = series.windowed_totals(read_table(spark, d, "events"), at="ts", by="event_type", value="value", length="1 hour")
    return t.select("start", "end", "event_type", "n", F.round("total", 4).alias("total"))


def event_candles(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "events").groupBy("ts", "event_type").agg(F.max("value").alias("value"))
    return series.candles(t, at="ts", by="event_type", value="value", length="1 day")


def latest_slots(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("slot"), F.col("event_id").alias("seq"), "value")
    return series.replace_then_append(t)


QUERIES = {f.__name__: f for f in (event_windows, event_candles, latest_slots)}
SQL = {
    "event_windows": """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    "event_candles": """WITH t AS (SELECT ts, event_type, max(value) AS value FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close FROM t GROUP BY ALL""",
    "latest_slots": "SELECT user_id::VARCHAR AS key, event_type AS slot, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events GROUP BY ALL",
}
