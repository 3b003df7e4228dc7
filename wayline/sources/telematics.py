"""Raw telematics to canonical columns, and the other inputs of the engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEG = ["vehicle_id", "leg_id"]
#: Source column names of the raw signals, best first, by canonical name.
SIGNALS: dict[str, tuple[str, ...]] = {
    "soc": ("electricBatteryLevelPercent",),
    "odometer_km": ("odometer",),
    "speed_kmh": ("wheel_based_speed", "speed"),
    "mass_kg": ("gross_combination_vehicle_weight",),
    "total_wh": ("total_electric_energy_used_plugged_in_included", "total_electric_energy_used"),
    "moving_wh": ("electric_energy_wheelbased_speed_over_zero",),
    "ac_wh": ("battery_pack_ac_watthours",),
    "dc_wh": ("battery_pack_dc_watthours",),
    "recup_wh": ("electric_energy_recuperation_watthours",),
    "propulsion_wh": ("electric_energy_propulsion",),
    "lat": ("gnss_latitude", "latitude"),
    "lon": ("gnss_longitude", "longitude"),
    "altitude_m": ("gnss_altitude",),
}
ZERO_IS_MISSING = {"soc", "lat", "lon"}
TASKS_A_CORE = 8  # at least, where channels are put side by side


def number(column: Column) -> Column:
    """A double, or null where the text isn't one or is NaN."""
    value = column.try_cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def detect_columns(columns: Sequence[str], overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """The source column of each canonical one that is there; an override goes first."""
    found = {}
    for name, candidates in SIGNALS.items():
        for candidate in ((overrides or {}).get(name), *candidates):
            if candidate in columns:
                found[name] = candidate
                break
    return found


def canonical(raw: DataFrame, overrides: Mapping[str, str] | None = None, time_column: str = "eventDatetime") -> DataFrame:
    """``raw`` (vehicle_id, leg_id, row_no, text signals) with canonical names and types.

    Rows without a readable time go. A signal that isn't there is null, so that it only
    makes later stages do less. ``has_speed`` and ``has_mass`` tell absent from empty.
    """
    source = detect_columns(raw.columns, overrides)
    signals = []
    for name in SIGNALS:
        value = number(F.col(source[name])) if name in source else F.lit(None).cast("double")
        signals.append((F.nullif(value, F.lit(0.0)) if name in ZERO_IS_MISSING else value).alias(name))
    trigger = F.col("trigger_type") if "trigger_type" in raw.columns else F.lit(None).cast("string")
    flags = [F.lit(name in source).alias(flag) for name, flag in (("speed_kmh", "has_speed"), ("mass_kg", "has_mass"))]
    rows = raw.select(*LEG, "row_no", F.try_to_timestamp(F.col(time_column).cast("string")).alias("ts"), *signals, trigger.alias("trigger_type"), *flags)
    return rows.where(F.col("ts").isNotNull())


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw leg files, all columns as text, with the file and the row's place in it."""
    return spark.read.csv(path, header=True, inferSchema=False).withColumn("source_file", F.input_file_name())


def leg_date(telematics: DataFrame) -> DataFrame:
    """The UTC date of each leg's first row in frame order."""
    return telematics.groupBy(*LEG).agg(F.min_by(F.to_date("ts"), "row_no").alias("leg_date"))


def legs_between(legs: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Legs that start on the days from first to last, both included."""
    start = F.col("start_ts")
    return legs.where((start >= F.to_timestamp(F.lit(first_day))) & (start < F.to_timestamp(F.lit(last_day)) + F.expr("interval 1 day")))


def route_legs(legs: DataFrame) -> DataFrame:
    return legs.withColumn("route", F.when(F.col("source").startswith("SRFLOGGER"), "logger").when(F.col("source") == "FPS", "telematics"))


def first_channel(channels: DataFrame, priority: Sequence[str]) -> DataFrame:
    """Of ``vehicle_id, leg_id, ts, channel, value`` the rows of each leg's best channel."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("channel"))
    ranked = channels.withColumn("rank", rank).where("rank > 0")
    return ranked.withColumn("best", F.min("rank").over(Window.partitionBy(*LEG))).where("rank = best").drop("rank", "best")


def wide_logger(channels: DataFrame, names: Sequence[str]) -> DataFrame:
    """Channels side by side, one row for each leg and time; the first of repeated readings.

    A row being put together takes many times the bytes of the readings that Spark sizes its partitions by, so
    legs are dealt to a number of tasks that isn't lowered to those bytes.
    """
    spark = channels.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    place = F.array_position(F.array(*map(F.lit, names)), F.col("channel"))
    slim = channels.select(*LEG, "ts", "row_no", place.cast("int").alias("place"), "value").where("place > 0").repartition(tasks, *LEG)
    picks = [F.min_by("value", F.when(F.col("place") == i, F.col("row_no"))).alias(name) for i, name in enumerate(names, 1)]
    return slim.groupBy(*LEG, "ts").agg(*picks)


def gps_speed_fallback(logger: DataFrame, primary: str = "speed_kmh", gps: str = "gps_speed_ms") -> DataFrame:
    """The GPS speed (m/s) in km/h for legs whose own speed is null throughout."""
    known = F.count(primary).over(Window.partitionBy(*LEG))
    return logger.withColumn(primary, F.when(known == 0, F.col(gps) * 3.6).otherwise(F.col(primary)))


def charger_meter(transactions: DataFrame) -> DataFrame:
    """Two points for each charger transaction: its meter at start and at end."""
    points = F.array(F.struct(F.col("start_ts").alias("ts"), F.col("start_meter_kwh").alias("meter_kwh")), F.struct(F.col("end_ts").alias("ts"), F.col("end_meter_kwh").alias("meter_kwh")))
    return transactions.select("vehicle_id", "uri", F.inline(points))


def upsert_transactions(old: DataFrame, new: DataFrame) -> DataFrame:
    """All transactions once by ``uri``; those of ``new`` win."""
    both = old.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)), allowMissingColumns=True)
    latest = Window.partitionBy("uri").orderBy(F.desc("batch"), F.desc("start_ts"))
    return both.withColumn("place", F.row_number().over(latest)).where("place = 1").drop("place", "batch")
