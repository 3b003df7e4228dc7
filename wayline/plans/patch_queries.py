"""Patches of a written report table, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import point_text
from ..operators import patch
from ..sources.fixture_tables import telematics
from .queries import TRIPS_SQL, _sessions, query, shown, trips_of
from .source_queries import fresh_folder

#: A report of trips: every third row is a charge, every fourth trip has a link, every fifth its weather, every second a mass.
REPORT_SQL = """rp AS (SELECT vehicle_id, seg AS leg_number, start_us, end_us, CASE WHEN seg % 3 = 0 THEN 'AC Home' WHEN seg % 3 = 1 THEN 'In Transit' ELSE 'Stop' END AS leg_type, CASE WHEN seg % 4 = 0 THEN 'old' END AS link, CASE WHEN seg % 5 = 0 THEN 1.0 END AS weather, CASE WHEN seg % 2 = 0 THEN 2.0 END AS mass FROM trips)"""


def _table(spark, d):
    rows = telematics(spark, d)
    seg, empty = F.col("seg"), lambda t: F.lit(None).cast(t)
    old = F.when(seg % 4 == 0, "old")
    report = trips_of(rows).select(
        "vehicle_id", seg.alias("leg_number"), "start_ts", "end_ts", F.when(seg % 3 == 0, "AC Home").when(seg % 3 == 1, "In Transit").otherwise("Stop").alias("leg_type"), old.alias("charger_link"), old.alias("logger_link"), empty("double").alias("charger_kwh"),
        *(F.when(seg % 5 == 0, 1.0).alias(c) for c in patch.MEANS), F.when(seg % 5 == 0, "N").alias("wind_direction"), F.when(seg % 5 == 0, "Clear").alias("weather_kind"), F.when(seg % 2 == 0, 2.0).alias("mass_kg"), empty("double").alias("mass_cv"),
        point_text(F.lit(50.0), (seg % 10).cast("double")).alias("origin"), F.when(seg % 7 > 0, point_text(F.lit(51.0), (seg % 10).cast("double"))).alias("destination"), (F.col("vehicle_id") % 8).alias("part"))
    folder = fresh_folder(spark, "report")
    report.write.partitionBy("part").parquet(folder)
    return rows, folder


@query("snk9_charger_patch", TRIPS_SQL, REPORT_SQL, "o AS (SELECT vehicle_id, row_no AS uri, us - 3600000000 AS o_start, us + 3600000000 AS o_end, CAST(speed AS DECIMAL(18,2)) AS energy FROM t WHERE trigger_type = 'PURCHASE')",
    "h AS (SELECT rp.vehicle_id, leg_number, arg_min(uri, [o_start, uri]) AS uri, CAST(sum(energy) AS DOUBLE) AS kwh FROM rp JOIN o ON o.vehicle_id = rp.vehicle_id AND o_start <= end_us + 240000000 AND o_end >= start_us - 240000000 WHERE link IS NULL AND leg_type = 'AC Home' GROUP BY ALL)",
    "SELECT rp.vehicle_id, leg_number, coalesce(uri::VARCHAR, link) AS charger, kwh AS charger_kwh FROM rp LEFT JOIN h USING (vehicle_id, leg_number)")
def _(spark, d):
    rows, folder = _table(spark, d)
    sessions = _sessions(rows).withColumn("uri", F.concat(F.lit("https://fleet.example/charger/"), F.lpad(F.col("uri").cast("string"), 12, "0")))
    patch.patch_table(spark, folder, lambda report: patch.charger_cells(report, sessions), ["part"])
    charger = F.coalesce(F.regexp_extract("charger_link", "charger%2F0*([0-9]+)$", 1), F.lit(""))
    return spark.read.parquet(folder).select("vehicle_id", "leg_number", F.when(charger != "", charger).otherwise(F.col("charger_link")).alias("charger"), "charger_kwh")


@query("snk9_logger_patch", TRIPS_SQL, REPORT_SQL, "x AS (SELECT rp.*, row_no, t.mass AS lm FROM rp JOIN t ON t.vehicle_id = rp.vehicle_id AND us BETWEEN start_us AND end_us WHERE leg_type <> 'AC Home')",
    "n AS (SELECT vehicle_id, leg_number, avg(row_no % 30) AS temperature, avg(row_no % 100) AS humidity, avg(row_no % 360) AS deg, CASE WHEN count(*) FILTER (lm > 0) >= 5 THEN median(lm) FILTER (lm > 0) END AS kg FROM x GROUP BY ALL)",
    "SELECT rp.vehicle_id, leg_number, CASE WHEN weather IS NULL THEN temperature ELSE weather END AS temperature, weather AS pressure, CASE WHEN weather IS NULL THEN humidity ELSE weather END AS humidity, CASE WHEN weather IS NOT NULL THEN 'N' WHEN deg IS NOT NULL THEN ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(round_even(deg / 45, 0) AS BIGINT) % 8 + 1] END AS wind_direction, coalesce(mass, kg) AS mass_kg FROM rp LEFT JOIN n USING (vehicle_id, leg_number)")
def _(spark, d):
    rows, folder = _table(spark, d)
    n = F.col("row_no")
    samples = rows.select("vehicle_id", "ts", "row_no", (n % 30).alias("temperature"), (n % 100).alias("humidity"), (n % 360).alias("wind_deg"), "mass_kg")
    patch.patch_weather(spark, folder, ["part"], "fine", samples=samples)
    return spark.read.parquet(folder).select("vehicle_id", "leg_number", "temperature", "pressure", "humidity", "wind_direction", "mass_kg")


@query("snk10_weather_patch", TRIPS_SQL, REPORT_SQL, "k AS (SELECT vehicle_id, leg_number, weather, CAST(leg_number % 10 AS BIGINT) AS lon, start_us // 3600000000 AS h0, end_us // 3600000000 AS h1 FROM rp WHERE leg_type = 'In Transit' AND weather IS NULL AND leg_number % 7 > 0)",
    "g AS (SELECT *, (h0 % 4 > 0 AND h1 % 4 > 0) AS known, (h0 % 30 + h1 % 30) / 2 AS temperature, ((h0 * 40) % 360 + (h1 * 40) % 360) / 2 AS deg, 'kind' || (h0 % 3) AS kind FROM k)",
    "SELECT rp.vehicle_id, leg_number, CASE WHEN known THEN temperature ELSE rp.weather END AS temperature, CASE WHEN known THEN ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(round_even(deg / 45, 0) AS BIGINT) % 8 + 1] WHEN rp.weather IS NOT NULL THEN 'N' END AS wind_direction, CASE WHEN known THEN kind WHEN rp.weather IS NOT NULL THEN 'Clear' END AS weather_kind FROM rp LEFT JOIN g USING (vehicle_id, leg_number)")
def _(spark, d):
    from ..functions.scalars import weather_key

    rows, folder = _table(spark, d)
    # The cache knows three hours of four, at every place that the report has.
    times = trips_of(rows).select(F.explode(F.array("start_ts", "end_ts")).alias("ts")).distinct()
    places = times.withColumn("lat", F.explode(F.array(F.lit(50.0), F.lit(51.0)))).withColumn("lon", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("lon", F.col("lon").cast("double"))
    hour = F.floor(F.unix_micros("ts") / 3_600_000_000)
    cache = places.where(hour % 4 > 0).select(weather_key("lat", "lon", "ts").alias("key"), *((hour % 30).cast("double").alias(c) for c in patch.MEANS), ((hour * 40) % 360).cast("double").alias("wind_deg"), F.concat(F.lit("kind"), (hour % 3).cast("string")).alias("kind")).distinct()
    patch.patch_weather(spark, folder, ["part"], cache=cache)
    patch.patch_weather(spark, folder, ["part"], cache=cache)
    return spark.read.parquet(folder).select("vehicle_id", "leg_number", "temperature", "wind_direction", "weather_kind")
