"""The diesel report: logger channels that differ by leg, put side by side, cut into trips and measured in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import cardinal, fractional_days, point_text
from ..sources.store import written
from ..sources.telematics import LEG, gps_speed_fallback, wide_logger
from .islands import MINUTE, speed_trips, us
from .joins import in_interval
from .measure import average_speed, counter_change, rising

#: The channels of a diesel logger by canonical name; a leg has some of them.
CHANNELS = ("speed_kmh", "fuel_l", "odometer_km", "mass_kg", "ambient_c", "temperature", "pressure", "humidity", "wind_speed", "wind_deg", "lat", "lon", "altitude_m", "gps_speed_ms")
WEATHER = ("temperature", "pressure", "humidity", "wind_speed")
MOVING_KMH = 1.0
#: The report's columns in order, after vehicle and leg.
REPORT = (
    "leg_number", "leg_type", "logger_link", "start_ts", "origin", "origin_place", "end_ts", "destination", "destination_place", "duration_days", "distance_km", "avg_speed_kmh", "height_m", "mass_kg", "mass_cv", "cumulative_km",
    "fuel_l", "l_per_100km", "temperature", "pressure", "humidity", "wind_speed", "wind_direction", "weather_kind", "energy_source", "operator",
)


def diesel_frame(channels: DataFrame) -> DataFrame:
    """One row for each leg and time from ``vehicle_id, leg_id, ts, row_no, channel, value``: a column for each of ``CHANNELS``, null
    where a leg hasn't the channel; the first of repeated readings. Legs without any speed take the GPS one (m/s)."""
    known = channels.where(F.col("ts").isNotNull()).withColumn("value", F.col("value").cast("double")).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    frame = gps_speed_fallback(wide_logger(known, CHANNELS))
    return frame.withColumn("row_no", F.unix_micros("ts"))


def measure_diesel(trips: DataFrame, frame: DataFrame, over_kmh: float = MOVING_KMH) -> DataFrame:
    """``trips`` (vehicle, leg, seg, start_ts, end_ts) with what their samples say: fuel and distance by counter, distance by
    speed where the counter doesn't move, the median mass of moving samples (of all, if none moves), height, weather, ends."""
    keys = [*LEG, "seg"]
    samples = in_interval(frame, trips, keys)
    step = (us(F.lead("ts").over(Window.partitionBy(*keys).orderBy("ts"))) - us("ts")) / (60.0 * MINUTE)
    samples = samples.withColumn("driven", F.coalesce("speed_kmh", F.lit(0.0)) * step)
    known, moves = F.col("mass_kg") > 0, F.coalesce(F.col("speed_kmh") > over_kmh, F.lit(False))
    masses = [F.when(known & moves, F.col("mass_kg")), F.when(known, F.col("mass_kg"))]
    of_mass = lambda f: F.when(F.count(masses[0]) >= 1, f(masses[0])).otherwise(f(masses[1]))
    variation = lambda m: F.when((F.count(m) > 2) & (F.avg(m) > 0), F.stddev_samp(m) / F.avg(m))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts")))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts")))
    both = (F.count("lat") > 0) & (F.count("lon") > 0)
    found = samples.groupBy(*keys).agg(
        rising(counter_change("fuel_l")).alias("fuel_l"), rising(counter_change("odometer_km"), strict=False).alias("by_counter"), F.when(F.count("*") >= 2, F.sum("driven")).alias("by_speed"),
        of_mass(F.median).alias("own_mass_kg"), of_mass(variation).alias("mass_cv"), counter_change("altitude_m").alias("height_m"),
        *(F.avg(c).alias(c) for c in WEATHER), F.avg("ambient_c").alias("ambient_c"), F.avg("wind_deg").alias("wind_deg"),
        *(F.when(both, f(c)).alias(f"{c}_{side}") for side, f in (("start", first), ("end", last)) for c in ("lat", "lon")))
    found = found.withColumns({"distance_km": F.when(F.col("by_counter") > 0, F.col("by_counter")).otherwise(F.coalesce("by_speed", "by_counter")), "temperature": F.coalesce("temperature", "ambient_c"), "wind_direction": cardinal(F.col("wind_deg"))})
    return trips.join(found.drop("by_counter", "by_speed", "ambient_c", "wind_deg"), keys)


def kept_trips(measured: DataFrame, min_km: float = 1.0, weight_class_t: float | Column | None = None) -> DataFrame:
    """Trips of ``min_km`` or more that have fuel, mass or temperature. A trip without a mass of its own has that of the
    leg's last trip before it that had one and was far enough, else the vehicle's weight class."""
    far = measured.where((F.col("distance_km") > 0) & (F.col("distance_km") >= min_km))
    before = Window.partitionBy(*LEG).orderBy("start_ts").rowsBetween(Window.unboundedPreceding, -1)
    weight = weight_class_t if isinstance(weight_class_t, Column) else F.lit(weight_class_t)
    carried = F.last("own_mass_kg", True).over(before)
    found = far.withColumn("mass_kg", F.coalesce("own_mass_kg", F.when(carried > 0, carried), weight.cast("double") * 1000))
    return found.where(F.coalesce("fuel_l", "mass_kg", "temperature").isNotNull()).drop("own_mass_kg")


def diesel_report(channels: DataFrame, trip_options: dict | None = None, min_km: float = 1.0, weight_class_t: float | Column | None = None, legs: DataFrame | None = None, stop_seconds: float = 60.0) -> DataFrame:
    """``vehicle_id, leg_id`` and ``REPORT`` for every trip and every stop between two rows of a vehicle.

    ``channels`` as in ``diesel_frame``; ``legs`` (vehicle_id, leg_id, logger_link, operator) may name a leg's link and operator.
    """
    frame = written(diesel_frame(channels))
    trips = speed_trips(frame, **(trip_options or {})).select(*LEG, us("motion_start_ts").alias("seg"), "start_ts", "end_ts")
    rows = kept_trips(measure_diesel(trips, frame), min_km, weight_class_t)
    if legs is None:
        rows = rows.withColumns({"logger_link": F.lit(None).cast("string"), "operator": F.lit(None).cast("string")})
    else:
        rows = rows.join(legs.select(*LEG, "logger_link", "operator"), LEG, "left")
    by_start = Window.partitionBy("vehicle_id").orderBy("start_ts", "leg_id", "seg")
    place = lambda side: point_text(F.col(f"lat_{side}"), F.col(f"lon_{side}"))
    rows = rows.withColumns({
        "leg_type": F.lit("In Transit"), "origin": place("start"), "destination": place("end"), "duration_days": fractional_days(F.col("start_ts"), F.col("end_ts")), "avg_speed_kmh": average_speed(F.col("distance_km"), F.col("start_ts"), F.col("end_ts")),
        "cumulative_km": F.sum("distance_km").over(by_start.rowsBetween(Window.unboundedPreceding, 0)), "l_per_100km": F.col("fuel_l") / F.col("distance_km") * 100, "energy_source": F.lit("lfc_fuel"),
        **{c: F.lit(None).cast("string") for c in ("origin_place", "destination_place", "weather_kind")},
    })
    # A stop repeats what the row before leaves; a row and the stop after it come from one row here.
    follow = F.lead(F.struct("start_ts", "origin", "operator")).over(by_start)
    gap = us("follow.start_ts") - us("end_ts") > int(stop_seconds * 1_000_000)
    shown = [c for c in REPORT if c != "leg_number"]
    trip = F.struct(*shown)
    stands = {"leg_type": F.lit("Stop"), "start_ts": F.col("end_ts"), "end_ts": F.col("follow.start_ts"), "origin": F.coalesce("destination", "follow.origin"), "destination": F.coalesce("destination", "follow.origin"), "duration_days": fractional_days(F.col("end_ts"), F.col("follow.start_ts")), "operator": F.coalesce("operator", "follow.operator"),
              **{c: F.lit(0.0) for c in ("distance_km", "avg_speed_kmh", "height_m")}, **{c: F.col(c) for c in ("mass_kg", "mass_cv", "cumulative_km")}}
    typed = rows.select(trip.alias("t")).schema["t"].dataType
    stop = F.struct(*(stands.get(c, F.lit(None)).cast(typed[c].dataType).alias(c) for c in shown))
    both = rows.withColumn("follow", follow).select(*LEG, F.inline(F.when(gap, F.array(trip, stop)).otherwise(F.array(trip))))
    number = F.row_number().over(Window.partitionBy("vehicle_id").orderBy("start_ts", "end_ts")).cast("long")
    return both.withColumn("leg_number", number).select(*LEG, *REPORT)
