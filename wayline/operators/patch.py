"""Finished reports filled in place: only cells that are empty, only partitions that change, and nothing the second time.

A patch is a function from report rows to rows with ``vehicle_id, leg_number`` and new cells;
a null new cell changes nothing. ``patch_table`` merges it into a partitioned table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import cardinal, is_charge_label, is_trip_label, point_part, resource_url, weather_key
from ..sources.store import written
from .joins import all_overlaps, first_overlap, in_interval
from .rows import PEDAL_KM, trip_kinetics
from .sequence import pedal_histograms
from .measure import elevation_kwh, energy_performance

KEY = ["vehicle_id", "leg_number"]
MEANS = ("temperature", "pressure", "humidity", "wind_speed")
WEATHER = (*MEANS, "wind_direction")
LEAST_MASSES = 5


def unknown(c: str) -> Column:
    """Whether a cell has no value: null, NaN or a blank text."""
    return F.col(c).isNull() | F.coalesce(F.trim(F.col(c).cast("string")).isin("", "NaN"), F.lit(False))


def charger_cells(report: DataFrame, sessions: DataFrame) -> DataFrame:
    """Link of the earliest charger session (vehicle_id, uri, o_start, o_end, energy_kwh) that a charge overlaps, give or take four
    minutes, and the energy of all of them; for charges without a link."""
    named = F.col("leg_type").contains("AC") | F.col("leg_type").contains("DC") | F.col("leg_type").contains("Charge")
    asked = report.where(unknown("charger_link") & named & F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()).select(*KEY, "start_ts", "end_ts")
    found = all_overlaps(asked, sessions.select("vehicle_id", "uri", "o_start", "o_end", "energy_kwh"), ["vehicle_id"], KEY, 4.0).where("uri is not null")
    link = resource_url(F.col("uri"), "explore/graphics/usage", F.col("start_ts"), F.col("end_ts"), F.col("uri"))
    return found.select(*KEY, link.alias("charger_link"), F.col("energy_kwh").cast("double").alias("charger_kwh"))


def _direction(degrees: Column) -> Column:
    return cardinal(F.avg(degrees))


def logger_cells(report: DataFrame, windows: DataFrame | None = None, samples: DataFrame | None = None) -> DataFrame:
    """What a logger adds to trips and stops: the link of the first window (vehicle_id, uri, o_start, o_end, list_order) within five
    minutes; and from ``samples`` (vehicle_id, ts, row_no and any of ``MEANS``, wind_deg, mass_kg, speed_kmh, accelerator,
    brake) between the row's ends: the weather, whole, if a cell of it is unknown; the median mass and its variation if the
    mass is, from five readings; the kinetic performance; pedal histograms of rows over ten kilometres."""
    rows = report.where(~is_charge_label(F.col("leg_type")) & F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
    rows = rows.withColumns({"leg_id": F.lit(0), "needs_weather": F.array_contains(F.array(*(unknown(c) for c in WEATHER)), True)})
    found = rows.select(*KEY)
    if windows is not None:
        hit = first_overlap(rows.where(unknown("logger_link")).select(*KEY, "start_ts", "end_ts"), windows, ["vehicle_id"], KEY, 5.0)
        link = resource_url(F.col("uri"), "explore/graphics/plots", F.col("start_ts"), F.col("end_ts"), F.col("uri"))
        found = found.join(hit.select(*KEY, link.alias("logger_link")), KEY, "left")
    if samples is None:
        return found
    samples = samples.withColumn("leg_id", F.lit(0))
    inside = in_interval(samples, rows, ["vehicle_id", "leg_id", "leg_number"])
    sums = [F.avg(c).alias(c) for c in MEANS if c in samples.columns]
    if "wind_deg" in samples.columns:
        sums.append(_direction(F.col("wind_deg")).alias("wind_direction"))
    if "mass_kg" in samples.columns:
        mass = F.when(F.col("mass_kg") > 0, F.col("mass_kg"))
        enough = F.count(mass) >= LEAST_MASSES
        sums += [F.when(enough, F.median(mass)).alias("mass_kg"), F.when(enough, F.stddev_samp(mass) / F.avg(mass)).alias("mass_cv")]
    if sums:
        new = inside.groupBy(*KEY).agg(*sums)
        old = rows.select(*KEY, "needs_weather", unknown("mass_kg").alias("needs_mass"))
        gate = lambda c: F.when(F.col("needs_mass" if c.startswith("mass") else "needs_weather"), F.col(c)).alias(c)
        found = found.join(new.join(old, KEY).select(*KEY, *(gate(c) for c in new.columns if c not in KEY)), KEY, "left")
    if "speed_kmh" in samples.columns:
        known = found.select(*KEY, F.col("mass_kg").alias("new_mass")) if "mass_kg" in found.columns else rows.select(*KEY, F.lit(None).cast("double").alias("new_mass"))
        moving = rows.where(unknown("ep_kinetic") & (F.col("distance_km") > 0) & ~unknown("delta_kwh")).join(known, KEY, "left").withColumn("mass_kg", F.coalesce("new_mass", "mass_kg"))
        gone = trip_kinetics(moving.select(*KEY, "leg_id", "start_ts", "end_ts", "mass_kg", "delta_kwh", "distance_km", "height_m"), samples, ["leg_id", "leg_number"])
        climb = F.coalesce(elevation_kwh(F.col("mass_kg"), F.col("height_m")), F.lit(0.0))
        kinetic = F.when(F.abs("kinetic_kwh") <= 0.8 * F.abs("delta_kwh"), energy_performance(F.col("delta_kwh"), F.col("distance_km"), climb + F.col("kinetic_kwh")))
        found = found.join(gone.select(*KEY, kinetic.alias("ep_kinetic")), KEY, "left")
    for c in ("accelerator", "brake"):
        if c in samples.columns:
            cell = "accelerator_histogram" if c == "accelerator" else "decelerator_histogram"
            far = rows.where((F.col("distance_km") > PEDAL_KM) & unknown(cell)).select(*KEY)
            found = found.join(pedal_histograms(inside.join(far, KEY, "left_semi"), c, KEY).withColumnRenamed("histogram", cell), KEY, "left")
    return found


def weather_cells(report: DataFrame, cache: DataFrame) -> DataFrame:
    """The coarse weather of trips that lack a part of it: the mean of what ``cache`` (key, ``MEANS``, wind_deg, kind) has for both ends
    (of the wind's direction the plain one), and the type at the start. A trip of which one end isn't known stays as it is."""
    asked = report.where(is_trip_label(F.col("leg_type")) & F.array_contains(F.array(*(unknown(c) for c in (*WEATHER, "weather_kind"))), True))
    places = {f"{x}_{end}": point_part(F.col(point), i) for point, end in (("origin", "start"), ("destination", "end")) for i, x in ((1, "lat"), (2, "lon"))}
    asked = asked.select(*KEY, "start_ts", "end_ts", *(v.alias(k) for k, v in places.items()))
    ends = asked.select(*KEY, F.explode(F.array(*(F.struct(F.lit(end).alias("end"), weather_key(f"lat_{end}", f"lon_{end}", f"{end}_ts").alias("key")) for end in ("start", "end")))).alias("e")).select(*KEY, "e.*").where("key is not null")
    known = ends.join(cache.dropDuplicates(["key"]), "key")
    sums = [F.avg(c).alias(c) for c in MEANS]
    new = known.groupBy(*KEY).agg(F.count("*").alias("n"), *sums, _direction(F.col("wind_deg")).alias("wind_direction"), F.max(F.when(F.col("end") == "start", F.col("kind"))).alias("weather_kind"))
    return new.where("n = 2").drop("n")


def merged(report: DataFrame, cells: DataFrame) -> DataFrame:
    """``report`` with the known new cells in place of the old ones, and ``changed``, whether any differs."""
    new = [c for c in cells.columns if c not in KEY]
    both = report.join(cells.select(*KEY, *(F.col(c).alias(f"__{c}") for c in new)), KEY, "left")
    differs = F.lit(False)
    for c in new:
        differs |= F.col(f"__{c}").isNotNull() & ~F.col(f"__{c}").cast(report.schema[c].dataType).eqNullSafe(F.col(c))
    filled = {c: F.coalesce(F.col(f"__{c}").cast(report.schema[c].dataType), F.col(c)) for c in new}
    return both.withColumn("changed", differs).withColumns(filled).select(*report.columns, "changed")


def patch_table(spark: SparkSession, path: str, cells: Callable[[DataFrame], DataFrame], partitions: Sequence[str]) -> int:
    """Fill a Parquet table of report rows in place; gives the number of rows that changed.

    Partitions without a change are neither read again nor written; with no change at all
    nothing is. The new rows are complete before a partition is replaced.
    """
    report = spark.read.parquet(path)
    done = written(merged(report, cells(report)))
    n = done.where("changed").count()
    if not n:
        return 0
    touched = done.where("changed").select(*partitions).distinct()
    rows = done.join(touched, [done[c].eqNullSafe(touched[c]) for c in partitions], "left_semi").drop("changed").select(*report.columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    return n


def patch_weather(spark: SparkSession, path: str, partitions: Sequence[str], mode: str = "coarse", cache: DataFrame | None = None, samples: DataFrame | None = None) -> int:
    """Weather by two points of each trip from a cache (``coarse``), or from samples along the way (``fine``)."""
    if mode == "coarse":
        return patch_table(spark, path, lambda report: weather_cells(report, cache), partitions)
    if mode == "fine":
        return patch_table(spark, path, lambda report: logger_cells(report, None, samples), partitions)
    raise ValueError(f"unknown weather mode {mode!r}")
