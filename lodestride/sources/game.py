"""Domain view of the event stream: game events with typed columns.

The SQL expressions run unchanged on Spark and DuckDB, but for the JSON accessor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEVEL_EVENTS = "event_name IN ('levelStarted', 'levelEnded', 'levelOutOfSpace', 'levelOutOfTime')"

COLUMNS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "session_date": "CAST(ts AS DATE)",
    "event_name": "CASE event_type WHEN 'view' THEN 'levelStarted' WHEN 'click' THEN 'levelEnded' WHEN 'error' THEN 'levelOutOfSpace' ELSE 'exchangeSpent' END",
    "level_result": "CASE event_type WHEN 'click' THEN 'Victory' WHEN 'error' THEN 'Defeat' END",
    "spend_type": "CASE event_type WHEN 'purchase' THEN 'VirtualCurrency' WHEN 'signup' THEN 'RealCurrency' END",
    "spend_amount": "CASE WHEN event_type IN ('purchase', 'signup') THEN value END",
    "multiplier": "CASE WHEN event_type = 'view' THEN round(CAST(0.5 AS DOUBLE) + CAST(0.06 AS DOUBLE) * (k % 13), 2) END",
    "assist": "0",
    "level_index": "k",
    "attempts": "1 + k % 5",
    "duration": "CASE WHEN k % 10 <> 0 THEN value END",
    "time_remaining": "CASE WHEN k % 7 <> 0 THEN value / 2 END",
    "rank_easing": "CAST(k % 4 AS DOUBLE) / 4",
    "fps": "CAST(30 + k % 31 AS DOUBLE)",
    "resurrections_space": "CASE WHEN event_type = 'error' THEN k % 2 END",
    "resurrections_time": "CASE WHEN event_type = 'error' THEN k % 3 END",
    "undo_booster": "k % 2",
    "extrabox_booster": "k % 3",
    "hammer_booster": "k % 4",
    "joker_booster": "k % 5",
    "prejoker_booster": "k % 6",
    "supersuit_booster": "CASE WHEN k % 9 <> 0 THEN k % 7 END",
    "coin_balance": "CAST(k AS DOUBLE) * 10",
    "life_balance": "CASE WHEN k % 3 <> 0 THEN CAST(k % 6 AS DOUBLE) END",
    "crown_count": "CAST(k % 8 AS DOUBLE)",
    "undo_balance": "CAST(k % 11 AS DOUBLE)",
    "hammer_balance": "CAST(k % 12 AS DOUBLE)",
    "extrabox_balance": "CAST(k % 14 AS DOUBLE)",
    "user_level": "1 + CAST(floor(k / 10.0) AS INT)",
    "user_segment": "CASE k % 3 WHEN 0 THEN 'casual' WHEN 1 THEN 'core' END",
    "platform": "CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END",
    "ad_revenue_usd": "CASE WHEN k % 4 = 0 THEN value / 1000 END",
    "session_id": "concat(CAST(user_id AS VARCHAR(20)), '_', CAST(hour(ts) AS VARCHAR(2)))",
}


def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return keyed.select(*[F.expr(sql).alias(name) for name, sql in COLUMNS.items()])


ORACLE = f"""game AS (
  SELECT {", ".join(f"{sql} AS {name}" for name, sql in COLUMNS.items())}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""
