"""The rows of the electric report: what samples, links and neighbours add to measured segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import fractional_days, leg_type, point_text, resource_url
from ..sources.telematics import LEG
from .islands import us
from .joins import first_overlap, in_interval
from .mass import mass_estimate, moving_samples
from .measure import average_speed, battery_power, counter_change, elevation_kwh, energy_performance, kinetic_kwh, performance_without_aux, spread

#: The report's columns in order, after vehicle and leg.
REPORT = (
    "leg_number", "leg_type", "telematics_link", "charger_link", "logger_link", "start_ts", "origin", "origin_place", "end_ts", "destination", "destination_place", "duration_days", "distance_km", "avg_speed_kmh", "height_m", "mass_kg", "mass_cv", "recuperation_kwh",
    "start_soc", "end_soc", "delta_soc", "delta_kwh", "ac_kwh", "dc_kwh", "co2_g_kwh", "cumulative_km", "co2_g", "cumulative_co2_g", "battery_power_kw", "ep", "ep_corrected", "capacity_kwh", "charger_kwh", "wire_efficiency", "peak_charging_kw", "average_charging_kw", "motor_kwh",
    "temperature", "pressure", "humidity", "wind_speed", "wind_direction", "weather_kind", "accelerator_histogram", "decelerator_histogram", "energy_source", "ep_kinetic", "propulsion_kwh", "ep_without_aux", "operator", "grade", "reason",
)
TEXTS = {"leg_type", "telematics_link", "charger_link", "logger_link", "origin", "origin_place", "destination", "destination_place", "wind_direction", "weather_kind", "accelerator_histogram", "decelerator_histogram", "energy_source", "operator", "grade", "reason"}
ESTIMATED = ("soc_estimate", "soc_fallback")
PEDAL_KM = 10.0  # pedal histograms only of longer trips


def sample_figures(segments: DataFrame, rows: DataFrame, ident: list[str], mass_method: str = "mean") -> DataFrame:
    """``segments`` with mass_kg, mass_cv, recuperation_kwh and height_m of the samples between their ends."""
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    inside = in_interval(rows, segments, keys)
    if mass_method == "mean":
        known = F.col("mass_kg") > 0
        moves = known & F.coalesce(F.col("speed_kmh") > 1, F.lit(False))
        pick = lambda f: F.when(F.count(F.when(moves, 1)) >= 2, f(F.when(moves, F.col("mass_kg")))).when(F.count(F.when(known, 1)) >= 2, f(F.when(known, F.col("mass_kg"))))
        cv = lambda m: F.when(F.avg(m) > 0, F.stddev_samp(m) / F.avg(m))
        found = inside.groupBy(*keys).agg(spread("recup_wh").alias("recuperation_kwh"), counter_change("altitude_m").alias("height_m"), pick(F.avg).alias("mass_kg"), pick(cv).alias("mass_cv"))
        return segments.join(found, keys, "left")
    figures = inside.groupBy(*keys).agg(spread("recup_wh").alias("recuperation_kwh"), counter_change("altitude_m").alias("height_m"))
    weighed = mass_estimate(moving_samples(inside, keys), keys, mass_method).select(*keys, "mass_kg", "mass_cv")
    return segments.join(figures, keys, "left").join(weighed, keys, "left")


def with_performance(rows: DataFrame) -> DataFrame:
    """Energy performance of trips and power of charges, from energy, distance, height, mass and ``kinetic_kwh``.

    Trips whose energy comes from the charge have a power as well. Without a height the
    plain correction is unknown, the kinetic one takes it as level ground.
    """
    trip, km, kwh = F.col("kind") == "discharge", F.col("distance_km"), F.col("delta_kwh")
    climb = elevation_kwh(F.col("mass_kg"), F.col("height_m"))
    kinetic = F.when(F.abs("kinetic_kwh") <= 0.8 * F.abs(kwh), energy_performance(kwh, km, F.coalesce(climb, F.lit(0.0)) + F.col("kinetic_kwh")))
    counted = F.coalesce(F.col("energy_source") != "distance_only", F.lit(True))
    return rows.withColumns({
        "ep": F.when(trip, energy_performance(kwh, km)), "ep_corrected": F.when(trip, energy_performance(kwh, km, climb)), "ep_kinetic": F.when(trip, kinetic),
        "ep_without_aux": F.when(trip & counted, performance_without_aux(F.col("propulsion_kwh"), F.col("recuperation_kwh"), km)), "avg_speed_kmh": average_speed(km, F.col("start_ts"), F.col("end_ts")),
        "battery_power_kw": F.when(~trip | F.col("energy_source").isin(*ESTIMATED), battery_power(kwh, F.col("start_ts"), F.col("end_ts"))),
    })


def trip_kinetics(trips: DataFrame, speeds: DataFrame, ident: list[str]) -> DataFrame:
    """``trips`` (with mass_kg) and ``kinetic_kwh`` from logger speeds (vehicle, leg, ts, row_no, speed_kmh) between their
    ends: null without a mass or with fewer than two speeds."""
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    inside = in_interval(speeds.where(F.col("speed_kmh").isNotNull()).select(*LEG, "ts", "row_no", "speed_kmh"), trips, keys)
    inside = inside.join(trips.select(*keys, "mass_kg"), keys)
    return trips.join(kinetic_kwh(inside, keys, "mass_kg", least=2), keys, "left")


def with_links(rows: DataFrame, legs: DataFrame | None = None, chargers: DataFrame | None = None, loggers: DataFrame | None = None) -> DataFrame:
    """``rows`` with links and operator: of their leg (vehicle, leg, leg_uri, operator), of the first charger session (vehicle_id,
    uri, o_start, o_end, energy_kwh, list_order) that a charge overlaps within four minutes, whose energy counts, and of
    the first logger window that a trip overlaps within five. What isn't given is null."""
    ident = [*LEG, "kind", "seg"]
    out = rows
    if legs is not None:
        out = out.join(legs.select(*LEG, "leg_uri", "operator"), LEG, "left")
    link = lambda uri, path, types=(): resource_url(F.col(uri), path, F.col("start_ts"), F.col("end_ts"), F.col(uri), list(types))
    made = {"telematics_link": link("leg_uri", "explore/graphics/plots", ("96", "HSS2")) if legs is not None else None, "operator": None if legs is None else F.col("operator")}
    for name, windows, kind, minutes, path in (("charger", chargers, "charge", 4.0, "explore/graphics/usage"), ("logger", loggers, "discharge", 5.0, "explore/graphics/plots")):
        made[f"{name}_link"] = None
        if windows is not None:
            hit = first_overlap(rows.where(F.col("kind") == kind).select(*ident, "start_ts", "end_ts"), windows, ["vehicle_id"], ident, minutes)
            out = out.join(hit.select(*ident, F.col("uri").alias(f"{name}_uri")), ident, "left")
            made[f"{name}_link"] = link(f"{name}_uri", path)
    out = out.withColumns({c: F.lit(None).cast("string") if v is None else v for c, v in made.items()})
    if chargers is None:
        return out.withColumn("charger_kwh", F.lit(None).cast("double"))
    energy = chargers.groupBy("vehicle_id", F.col("uri").alias("charger_uri")).agg(F.min_by("energy_kwh", "list_order").cast("double").alias("charger_kwh"))
    return out.join(energy, ["vehicle_id", "charger_uri"], "left")


def stops_between(rows: DataFrame, least_seconds: float = 60.0) -> DataFrame:
    """``vehicle_id, leg_id`` and ``REPORT``: the rows in order, numbered, and between two that are more than ``least_seconds``
    apart a stop: where the row before ended or else the next starts, with its mass and distance so far, the charge at both
    ends and the operator; no distance, speed or height."""
    kinds = F.when(F.col("kind") == "charge", 0).otherwise(1)
    order = [F.asc("start_ts"), F.asc("leg_id"), kinds, F.asc("seg")]
    shown = [c for c in REPORT if c != "leg_number"]
    typed = {c: "string" if c in TEXTS else "timestamp" if c in ("start_ts", "end_ts") else "double" for c in shown}
    full = rows.withColumns({c: (F.col(c) if c in rows.columns else F.lit(None)).cast(t) for c, t in typed.items()})
    by_vehicle = Window.partitionBy("vehicle_id").orderBy(*order)
    follow = F.lead(F.struct("start_ts", "origin", "origin_place", "start_soc", "operator")).over(by_vehicle)
    where = F.when(F.col("destination").isNotNull(), F.struct(F.col("destination").alias("point"), F.col("destination_place").alias("place"))).otherwise(F.struct(F.col("follow.origin").alias("point"), F.col("follow.origin_place").alias("place")))
    stands: dict[str, Column] = {
        "leg_type": F.lit("Stop"), "start_ts": F.col("end_ts"), "end_ts": F.col("follow.start_ts"), "origin": where["point"], "destination": where["point"], "origin_place": where["place"], "destination_place": where["place"], "duration_days": fractional_days(F.col("end_ts"), F.col("follow.start_ts")),
        **{c: F.lit(0.0) for c in ("distance_km", "avg_speed_kmh", "height_m")}, **{c: F.col(c) for c in ("mass_kg", "mass_cv", "cumulative_km")},
        "start_soc": F.col("end_soc"), "end_soc": F.col("follow.start_soc"), "delta_soc": F.col("follow.start_soc") - F.col("end_soc"), "operator": F.coalesce("operator", "follow.operator"),
    }
    row = lambda values: F.struct(*(values.get(c, F.lit(None)).cast(t).alias(c) for c, t in typed.items()))
    own, stop = row({c: F.col(c) for c in shown}), row(stands)
    gap = us("follow.start_ts") - us("end_ts") > int(least_seconds * 1_000_000)
    placed = full.withColumns({"follow": follow, "place": F.row_number().over(by_vehicle)})
    both = placed.select(*LEG, "place", F.posexplode(F.when(gap, F.array(own, stop)).otherwise(F.array(own))).alias("after", "row"))
    number = F.row_number().over(Window.partitionBy("vehicle_id").orderBy("place", "after")).cast("long")
    return both.withColumn("leg_number", number).select(*LEG, "leg_number", "row.*")


def named_rows(homed: DataFrame) -> DataFrame:
    """Leg type, ends and duration of rows with at_home, start_home and end_home (see ``relabel_home``)."""
    charge = F.col("kind") == "charge"
    place = lambda side: F.when(charge, point_text(F.col("lat"), F.col("lon"))).otherwise(point_text(F.col(f"lat_{side}"), F.col(f"lon_{side}")))
    kind = leg_type(F.col("kind"), F.col("ac_kwh"), F.col("dc_kwh"), F.coalesce("at_home", "start_home"), F.col("end_home"), F.coalesce("distance_km", F.lit(0.0)))
    return homed.withColumns({"leg_type": kind, "origin": place("start"), "destination": place("end"), "duration_days": fractional_days(F.col("start_ts"), F.col("end_ts"))})
