"""What a segment's samples say: energy, distance, propulsion, kinetics, fuel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.telematics import LEG
from .joins import as_of, in_interval

G, ETA = 9.81, 0.90


def in_band(capacity: Column, nominal_kwh: float | None, low: float = 0.5, high: float = 2.0) -> Column:
    return F.lit(True) if nominal_kwh is None else capacity.between(nominal_kwh * low, nominal_kwh * high)


def counter_change(value: str) -> Column:
    """Aggregate: last less first known reading in time order, from two readings on."""
    known = F.when(F.col(value).isNotNull(), F.struct("ts", "row_no"))
    return F.when(F.count(value) >= 2, F.max_by(value, known) - F.min_by(value, known))


def spread(value: str) -> Column:
    """Aggregate: largest less smallest reading of a cumulative counter, in thousands."""
    return F.when(F.count(value) >= 2, (F.max(value) - F.min(value)) / 1000)


def interpolated_at(instants: DataFrame, samples: DataFrame, value: str, keep: list[str], at: str) -> DataFrame:
    """``value`` at each instant on the line between the readings on either side; null outside them."""
    back = as_of(instants, samples, value, keep, "backward", at).withColumnsRenamed({value: "v0", f"{value}_ts": "t0"})
    both = as_of(back, samples, value, [*keep, "v0", "t0"], "forward", at)
    t0, t1, t = F.unix_micros("t0"), F.unix_micros(f"{value}_ts"), F.unix_micros(at)
    v0, v1 = F.col("v0").cast("double"), F.col(value).cast("double")
    line = F.when(t1 == t0, v0).otherwise(v0 + (v1 - v0) * (t - t0).cast("double") / F.nullif(t1 - t0, F.lit(0).cast("long")).cast("double"))
    return both.withColumn(value, line).drop("v0", "t0", f"{value}_ts")


def elevation_kwh(mass_kg: Column, height_m: Column, eta: float = ETA) -> Column:
    """Battery energy of a height difference: more uphill, less comes back downhill."""
    if not 0 < eta <= 1:
        raise ValueError("the efficiency must be in (0, 1]")
    potential = mass_kg * G * height_m / 3.6e6
    return F.when(height_m >= 0, potential / eta).otherwise(potential * eta)


def energy_performance(kwh: Column, km: Column, correction: Column | None = None) -> Column:
    used = F.abs(kwh) if correction is None else F.abs(kwh) - correction
    return F.when(km > 0, used / F.nullif(km, F.lit(0.0)))


def average_speed(km: Column, start: Column, end: Column) -> Column:
    hours = (F.unix_micros(end) - F.unix_micros(start)) / 3.6e9
    return F.when((km > 0) & (hours > 0), km / F.nullif(hours, F.lit(0.0)))


def kinetic_kwh(samples: DataFrame, keys: list[str], mass_kg: float | str, eta: float = ETA, least: int = 1) -> DataFrame:
    """``keys, kinetic_kwh``: gains of kinetic energy over the efficiency less losses times it, of
    speeds cut to 0 to 100 km/h and smoothed by a running median of three; null with fewer than ``least`` speeds."""
    w = Window.partitionBy(*keys).orderBy("ts", "row_no")
    speed = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("speed_kmh")))
    rows = samples.where(F.col("speed_kmh").isNotNull()).withColumn("v", speed)
    rows = rows.withColumns({"v0": F.lag("v").over(w), "v1": F.lead("v").over(w)})
    # At an end the mean of two, alone the speed itself.
    middle = F.when(F.col("v0").isNotNull() & F.col("v1").isNotNull(), F.greatest(F.least("v0", "v"), F.least(F.greatest("v0", "v"), F.col("v1")))).otherwise((F.coalesce("v0", "v1", "v") + F.col("v")) / 2)
    rows = rows.withColumn("smooth", middle / 3.6)
    change = (F.pow(F.lead("smooth").over(w), 2) - F.pow(F.col("smooth"), 2)) * 0.5
    rows = rows.withColumn("change", change)
    mass = F.col(mass_kg) if isinstance(mass_kg, str) else F.lit(mass_kg)
    joules = F.sum(mass * F.when(F.col("change") >= 0, F.col("change") / eta).otherwise(F.col("change") * eta))
    return rows.groupBy(*keys).agg(F.when(F.count("*") >= least, joules / 3.6e6).alias("kinetic_kwh"))


def speed_distance(samples: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, distance_km``: the sum of each speed over the time to the next sample."""
    w = Window.partitionBy(*keys).orderBy("ts", "row_no")
    hours = (F.unix_micros(F.lead("ts").over(w)) - F.unix_micros("ts")) / 3.6e9
    return samples.withColumn("km", F.col("speed_kmh") * hours).groupBy(*keys).agg(F.sum("km").alias("distance_km"))


def running_distance(rows: DataFrame) -> DataFrame:
    """Distance of the trips so far, in the order of legs and segments; null on charges, on stops what the row before has."""
    w = Window.partitionBy("vehicle_id").orderBy("leg_id", "start_ts", "seg_no").rowsBetween(Window.unboundedPreceding, 0)
    is_trip = F.col("kind") == "discharge"
    so_far = F.coalesce(F.sum(F.when(is_trip, F.col("distance_km"))).over(w), F.lit(0.0))
    own = rows.withColumn("__km", F.when(F.col("kind") != "stop", F.struct(F.when(is_trip, so_far).alias("km"))))
    return own.withColumn("cumulative_km", F.last("__km", True).over(w)["km"]).drop("__km")


def height_difference(samples: DataFrame, keys: list[str], altitude: str = "altitude_m") -> DataFrame:
    """``keys, height_m``: last less first known altitude in time order, from two on, to one decimal."""
    return samples.groupBy(*keys).agg(F.round(counter_change(altitude), 1).alias("height_m"))


def propulsion_change(windows: DataFrame, rows: DataFrame, ident: list[str], value: str = "propulsion_wh") -> DataFrame:
    """``windows`` with ``propulsion_kwh``: the counter's change between its values at both ends, on the lines between
    readings; where the window reaches beyond them, last less first reading inside, from two on. Never negative."""
    from .segments import around, propelled

    found = around(windows, rows, [value], ident)
    return found.withColumn("propulsion_kwh", propelled(value)).drop(*(f"{value}_{x}" for x in ("b0", "a0", "b1", "a1", "n")))


def battery_power(kwh: Column, start: Column, end: Column) -> Column:
    hours = (F.unix_micros(end) - F.unix_micros(start)) / 3.6e9
    return F.when(hours > 0, kwh / F.nullif(hours, F.lit(0.0)))


def performance_without_aux(propulsion_kwh: Column, recuperation_kwh: Column, km: Column) -> Column:
    return F.when(km > 0, (propulsion_kwh - recuperation_kwh) / F.nullif(km, F.lit(0.0)))


def rising(change: Column, strict: bool = True) -> Column:
    """A counter's change if it is positive (not strict: or zero), else null."""
    return F.when(change > 0 if strict else change >= 0, change)


def diesel_trips(trips: DataFrame, lhv_kwh_per_l: float = 10.0, min_km: float = 1.0) -> DataFrame:
    """Diesel trips worth a row, energy from fuel, and mass carried over from the trip before.

    Needs fuel_l, distance_km, own_mass_kg, temperature_c. Trips without distance, under
    ``min_km``, or without fuel, mass and temperature go.
    """
    known = F.coalesce(F.col("fuel_l"), F.col("own_mass_kg"), F.col("temperature_c")).isNotNull()
    kept = trips.where((F.col("distance_km") > 0) & (F.col("distance_km") >= min_km) & known)
    w = Window.partitionBy(*LEG).orderBy("start_ts").rowsBetween(Window.unboundedPreceding, -1)
    return kept.withColumns({"mass_kg": F.coalesce("own_mass_kg", F.last("own_mass_kg", True).over(w)), "fuel_kwh": F.when(F.col("fuel_l") > 0, F.col("fuel_l") * lhv_kwh_per_l), "l_per_100km": F.when(F.col("fuel_l") > 0, F.col("fuel_l") / F.col("distance_km") * 100)})
