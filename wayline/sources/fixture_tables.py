"""The supplied star-schema tables seen as telematics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The same view in SQL, for the oracles: one leg for each user, whole numbers where sums are taken.
TELEMATICS_SQL = """
    t AS (
        SELECT user_id AS vehicle_id, CAST(0 AS BIGINT) AS leg_id, event_id AS row_no, epoch_us(ts) AS us, floor(value) AS speed,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN nullif(floor(value / 5), 0) END AS soc,
               CASE WHEN event_type = 'view' THEN 'TIMER' ELSE upper(event_type) END AS trigger_type,
               CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS odo,
               CASE WHEN event_type IN ('view', 'click') THEN CAST(sum(CAST(floor(value) AS BIGINT) * 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) END AS wh,
               CASE WHEN event_type <> 'error' THEN floor(value * 200) END AS mass
        FROM events
    )"""


def telematics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    so_far = Window.partitionBy("vehicle_id", "leg_id").orderBy("ts", "row_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = events.select(
        F.col("user_id").alias("vehicle_id"), F.lit(0).cast("long").alias("leg_id"), F.col("event_id").alias("row_no"), "ts", F.unix_micros("ts").alias("us"),
        F.floor("value").cast("double").alias("speed_kmh"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), F.nullif(F.floor(F.col("value") / 5).cast("double"), F.lit(0.0))).alias("soc"),
        F.when(F.col("event_type") == "view", "TIMER").otherwise(F.upper("event_type")).alias("trigger_type"),
        F.floor("value").alias("km"),
        F.col("event_type").isin("view", "click").alias("counted"),
        F.when(F.col("event_type") != "error", F.floor(F.col("value") * 200).cast("double")).alias("mass_kg"),
    )
    rows = rows.withColumn("odometer_km", F.sum("km").over(so_far))
    return rows.withColumn("total_wh", F.when(F.col("counted"), F.col("odometer_km") * 1000)).drop("km", "counted")
