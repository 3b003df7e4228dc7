"""The electric-vehicle report: trips and charges of a fleet as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.capacity import correct_estimates, replace_outliers
from ..operators.clean import blank_soc_spikes, clean_odometer
from ..operators.enrich import relabel_home
from ..operators.grade import grade
from ..operators.islands import charge_blocks, clamp_anchors, merge_adjacent
from ..operators.joins import as_of, charge_between, in_interval, reconcile_charges
from ..operators.mass import class_changes, dominant_class, mass_classes, standing_near
from ..operators.measure import average_speed, energy_performance, running_distance
from ..operators.report import scrub
from ..operators.rows import named_rows, sample_figures, stops_between, trip_kinetics, with_links, with_performance
from ..operators.segments import anchors_again, audit, charge_energy, charge_places, discharge_segments, split_at, with_logger_mass
from ..operators.sequence import soc_quantum
from ..sources.store import stored, written
from ..sources.telematics import LEG


def trip_rows(rows: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips with odometer and counter readings at or before the start and at or after the end."""
    found = trips.select(*LEG, "start_ts", "end_ts")
    for value in ("odometer_km", "total_wh"):
        for at, direction in (("start_ts", "backward"), ("end_ts", "forward")):
            keep = [c for c in found.columns if c not in LEG and c != at]
            found = as_of(found, rows, value, keep, direction, at).drop(f"{value}_ts").withColumnRenamed(value, f"{at[:-3]}_{value}")
    km = (F.col("end_odometer_km") - F.col("start_odometer_km")).cast("double")
    kwh = (F.col("start_total_wh") - F.col("end_total_wh")).cast("double") / 1000
    found = found.withColumns({"distance_km": F.when(km >= 0, km), "delta_kwh": F.when(kwh < 0, kwh)})
    return found.withColumns({"ep_kwh_km": energy_performance(F.col("delta_kwh"), F.col("distance_km")), "avg_speed_kmh": average_speed(F.col("distance_km"), F.col("start_ts"), F.col("end_ts"))})


def ev_segments(rows: DataFrame, trip_options: dict | None = None, charge_options: dict | None = None, limits: dict | None = None, spike_pct: float | None = None, clean: bool = True, confirmed_km: float | None = None, split_by_mass: bool = False, merge_gap_min: float | None = None, reconcile: bool = False, least_charge_kwh: float = 5.0, block_options: dict | None = None, block_limits: dict | None = None, min_block_km: float = 0.0, logger_speed: DataFrame | None = None, logger_mass: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cleaned rows, the charges and the discharges of every leg, as three written tables.

    In order: odometer cleaning, spike cleaning if a limit is given, mass classes; charges with
    their energy and place; discharges by speed or by the charge (``discharge_segments``);
    trips cut where the mass class changes at a stop, joined over gaps under ``merge_gap_min``;
    energy anchors looked up again and kept apart; charges cut back at trips.
    """
    limits = dict(limits or {})
    nominal, stop_min = limits.pop("nominal_kwh", None), (trip_options or {}).get("min_stop_min", 5.0)
    by_mass = split_by_mass or merge_gap_min is not None
    if clean:
        rows = clean_odometer(rows)
    if spike_pct is not None:
        rows = blank_soc_spikes(rows, spike_pct)
    if logger_mass is not None:
        rows = with_logger_mass(stored(rows), logger_mass)
    # Classes look at all rows twice: cleaning comes before them once.
    rows = stored(standing_near(mass_classes(stored(rows)), 2 * stop_min) if by_mass else rows)
    charges = charge_energy(charge_blocks(rows, **(charge_options or {})), rows, nominal, least_charge_kwh, limits.get("band"))
    charges = written(charge_places(written(charges.withColumn("seg", F.unix_micros("start_ts"))), rows, ["seg"]))
    spans = charges.select(*LEG, F.col("start_ts").alias("c_start"), F.col("end_ts").alias("c_end"))
    trips = discharge_segments(rows, spans, trip_options, block_options, limits, block_limits, nominal, min_block_km, confirmed_km, logger_speed)
    trips = written(trips.withColumn("seg", F.unix_micros("start_ts")))
    if split_by_mass:
        changes = class_changes(in_interval(rows, trips, [*LEG, "seg"]), [*LEG, "seg"])
        trips = written(split_at(trips, written(changes), rows, ["seg"]).withColumn("seg", F.unix_micros("start_ts")))
    if merge_gap_min is not None:
        dominant = dominant_class(in_interval(rows, trips, [*LEG, "seg"]), [*LEG, "seg"])
        between = charge_between(trips.join(dominant, [*LEG, "seg"], "left"), spans.withColumnsRenamed({"c_start": "o_start", "c_end": "o_end"}))
        trips = written(merge_adjacent(between, merge_gap_min))
    trips = written(clamp_anchors(anchors_again(trips, rows)))
    if reconcile:
        charges = reconcile_charges(charges, trips.select(*LEG, F.col("start_ts").alias("o_start"), F.col("end_ts").alias("o_end")), ["seg"])
    return rows, charges, trips


def ev_report(rows: DataFrame, *, legs: DataFrame | None = None, chargers: DataFrame | None = None, loggers: DataFrame | None = None, logger_speed: DataFrame | None = None, fallback: tuple[float, float] | None = None, mass_method: str = "mean", **options) -> DataFrame:
    """Trip, charge and stop rows of every vehicle, with the columns of ``rows.REPORT``.

    ``rows`` are canonical samples, ``options`` those of ``ev_segments``. After the segments: what
    samples say of them, the audit, capacities corrected and outliers replaced over all of a
    vehicle's rows, performance and its grade, home and leg types, distance so far, links and
    operators where ``legs``, ``chargers`` and ``loggers`` are given, and stops in gaps of over a
    minute. Weather is filled in later (``enrich.fill_missing``).
    """
    nominal = (options.get("limits") or {}).get("nominal_kwh")
    rows, charges, trips = ev_segments(rows, logger_speed=logger_speed, **options)
    audited = audit(trips, rows, ["seg"]).join(soc_quantum(rows), LEG, "left")
    both = audited.withColumn("kind", F.lit("discharge")).unionByName(charges.withColumn("kind", F.lit("charge")), allowMissingColumns=True)
    both = both.withColumn("distance_km", F.when(F.col("distance_km") > 0, F.col("distance_km")))
    both = written(sample_figures(both, rows, ["kind", "seg"], mass_method))
    if logger_speed is not None:
        kinetic = trip_kinetics(both.where("kind = 'discharge'"), logger_speed, ["kind", "seg"]).select(*LEG, "kind", "seg", "kinetic_kwh")
        both = both.join(kinetic, [*LEG, "kind", "seg"], "left")
    else:
        both = both.withColumn("kinetic_kwh", F.lit(None).cast("double"))
    fixed = replace_outliers(correct_estimates(both.withColumn("ts", F.col("start_ts")), nominal), fallback=fallback).drop("ts", "outlier")
    fixed = written(fixed)
    referee = fixed.where("capacity_kwh is not null").groupBy("vehicle_id").agg(F.avg("capacity_kwh").alias("referee_kwh"))
    graded = grade(with_performance(fixed.join(referee, "vehicle_id", "left")))
    trip = F.col("kind") == "discharge"
    graded = graded.withColumns({c: F.when(trip, F.col(c)) for c in ("grade", "reason")}).withColumn("seg_no", F.col("seg"))
    report = with_links(running_distance(named_rows(relabel_home(graded))), legs, chargers, loggers)
    return scrub(stops_between(report))
