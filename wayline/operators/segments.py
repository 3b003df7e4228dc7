"""Segments measured, split and audited: every reading around a window in one pass over its leg."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from ..sources.telematics import LEG
from .islands import MINUTE, backwards, discharge_blocks, speed_trips, us
from .joins import as_of_nearest, in_interval, subtract_intervals

COUNTERS = ("total_energy", "moving_energy")
STEP_RATE, STEP_SHARE = 300.0, 0.5  # per cent an hour, and of the change: quicker is no discharge


def around(windows: DataFrame, rows: DataFrame, columns: list[str], ident: list[str], start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """``windows`` with, for each column c, the known readings around its ends: ``c_b0`` at or before the
    start, ``c_a0`` at or after it, ``c_b1`` and ``c_a1`` the same at the end, each a struct of
    ``v`` and ``ts`` (null if none), and ``c_n``, how many lie between the ends, both included.

    ``ident`` with vehicle and leg names a window. One union of both sides is sorted once
    for each direction, whatever the number of columns. Of readings at one instant the last
    row counts going backward, the first going forward.
    """
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    values = F.struct(*(F.col(c) for c in columns))
    ends = windows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*keys, F.inline(F.array(F.struct(F.col(start).alias("ts"), F.lit(0).alias("side")), F.struct(F.col(end).alias("ts"), F.lit(1).alias("side")))))
    both = rows.select(*LEG, "ts", F.col("row_no").cast("long").alias("row_no"), values.alias("v")).unionByName(ends, allowMissingColumns=True)
    asked = F.col("side").isNotNull()
    back = Window.partitionBy(*LEG).orderBy("ts", asked, "row_no", "side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*LEG).orderBy(F.desc("ts"), asked, F.desc("row_no"), "side").rowsBetween(Window.unboundedPreceding, 0)
    leg = Window.partitionBy(*LEG)
    made = {}
    for c in columns:
        known = F.when(F.col(f"v.{c}").isNotNull(), F.struct(F.col(f"v.{c}").alias("v"), "ts"))
        made |= {f"{c}_b": F.last(known, True).over(back), f"{c}_a": F.last(known, True).over(ahead), f"{c}_to": F.count(f"v.{c}").over(back), f"{c}_from": F.count(f"v.{c}").over(ahead), f"{c}_all": F.count(f"v.{c}").over(leg)}
    at = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    sides = [at(f"{c}_{x}", i).alias(f"{c}_{x}{i}") for c in columns for x in "ba" for i in (0, 1)]
    counts = [(at(f"{c}_from", 0) + at(f"{c}_to", 1) - F.max(f"{c}_all")).alias(f"{c}_n") for c in columns]
    found = both.withColumns(made).where(asked).groupBy(*keys).agg(*sides, *counts)
    return windows.join(found, keys, "left")


def line_at(before: str, after: str, at: Column, clamp: bool = False) -> Column:
    """The value at an instant on the line between two readings; ``clamp``: the one that is known, where only one is."""
    t, t0, t1 = us(at), us(f"{before}.ts"), us(f"{after}.ts")
    a, b = F.col(f"{before}.v").cast("double"), F.col(f"{after}.v").cast("double")
    line = F.when(t1 == t0, a).otherwise(a + (b - a) * ((t - t0) / F.nullif(t1 - t0, F.lit(0).cast("long"))))
    return F.coalesce(line, a, b) if clamp else line


def propelled(value: str = "propulsion_wh") -> Column:
    """The counter's change in thousands from what ``around`` found: on the lines at both ends, else between the first and
    last reading inside, from two on; null if it falls."""
    lines = line_at(f"{value}_b1", f"{value}_a1", F.col("end_ts")) - line_at(f"{value}_b0", f"{value}_a0", F.col("start_ts"))
    inside = F.when(F.col(f"{value}_n") >= 2, (F.col(f"{value}_b1.v") - F.col(f"{value}_a0.v")).cast("double"))
    change = F.coalesce(lines, inside) / 1000
    return F.when(change >= 0, change)


def _inside(c: str, first: bool) -> Column:
    """The first or last reading within the window, or null."""
    side, edge = (f"{c}_a0", F.col("end_ts")) if first else (f"{c}_b1", F.col("start_ts"))
    ok = F.col(f"{side}.ts") <= edge if first else F.col(f"{side}.ts") >= edge
    return F.when(ok, F.col(f"{side}.v"))


Number = float | Column


def measure_trips(windows: DataFrame, rows: DataFrame, ident: list[str], nominal_kwh: float | None = None, min_soc_drop: Number = 0.0, min_energy_kwh: Number = 0.0, band: tuple[Number, Number] | None = None, keep_outside_band: bool | Column = False) -> DataFrame:
    """Trip windows with charge, energy, distance and place of each, and ``failed``: the first gate that a
    window does not pass (``soc``, ``no_energy``, ``energy``, ``band``), null if it passes all.

    The charge is that of the first and last reading inside, else of the nearest before and
    after, unless the windows bring ``start_soc`` and ``end_soc``. Limits may be columns of the
    windows, so that windows of several kinds are measured at once. Energy, negative for use, is the change of the total counter between its readings
    at or before the start and at or after the end, else of the moving counter, else the
    charge's share of ``nominal_kwh``. Capacity is null without a drop; with
    ``keep_outside_band`` a counted trip outside the band stays, without a capacity.
    """
    found = around(windows, rows, ["soc", "odometer_km", "total_wh", "moving_wh", "lat", "lon"], ident)
    none = F.col("soc_n") < 1
    start_soc = F.when(none, F.col("soc_b0.v")).otherwise(_inside("soc", True))
    end_soc = F.when(none, F.col("soc_a1.v")).otherwise(_inside("soc", False))
    if "start_soc" in windows.columns:
        start_soc, end_soc = F.coalesce("start_soc", start_soc), F.coalesce("end_soc", end_soc)
    found = found.withColumns({"start_soc": start_soc, "end_soc": end_soc})
    found = found.withColumn("delta_soc", F.coalesce(F.col("end_soc") - F.col("start_soc"), F.lit(0.0)))
    used = lambda c: F.nullif(F.greatest(F.col(f"{c}_a1.v") - F.col(f"{c}_b0.v"), F.lit(0.0)), F.lit(0.0)) / 1000
    total, moving = used("total_wh"), used("moving_wh")
    estimate = F.when(F.col("delta_soc") < 0, F.col("delta_soc") / 100 * F.lit(nominal_kwh).cast("double"))
    source = F.when(total.isNotNull(), "total_energy").when(moving.isNotNull(), "moving_energy").when(estimate.isNotNull(), "soc_estimate")
    found = found.withColumns({"energy_source": source, "delta_kwh": F.coalesce(-total, -moving, estimate), "delta_moving_kwh": moving})
    counted = lambda side, x: F.when(F.col("energy_source") == "total_energy", F.col(f"total_wh_{side}.{x}")).when(F.col("energy_source") == "moving_energy", F.col(f"moving_wh_{side}.{x}"))
    capacity = F.when(F.col("delta_soc") < 0, F.abs("delta_kwh") / (-F.col("delta_soc") / 100))
    found = found.withColumn("capacity_kwh", capacity)
    outside = F.coalesce(~F.col("capacity_kwh").between(*band), F.lit(False)) if band else F.lit(False)
    kept = outside & F.col("energy_source").isin(*COUNTERS) & (keep_outside_band if isinstance(keep_outside_band, Column) else F.lit(keep_outside_band))
    known_soc = F.col("start_soc").isNotNull() & F.col("end_soc").isNotNull()
    failed = F.when(known_soc & (-F.col("delta_soc") < min_soc_drop), "soc").when(F.col("delta_kwh").isNull(), "no_energy").when((F.abs("delta_kwh") < min_energy_kwh) | (F.col("delta_kwh") >= 0), "energy").when(outside & ~kept, "band")
    found = found.withColumns({
        "failed": failed, "outside_band": F.coalesce(kept, F.lit(False)),
        "odo_start_km": F.col("odometer_km_b0.v").cast("double"), "odo_end_km": F.col("odometer_km_a1.v").cast("double"), "distance_km": (F.col("odometer_km_a1.v") - F.col("odometer_km_b0.v")).cast("double"),
        "lat_start": _inside("lat", True), "lon_start": _inside("lon", True), "lat_end": _inside("lat", False), "lon_end": _inside("lon", False),
        "anchor_start_ts": F.when(F.col("energy_source") == "soc_estimate", F.col("start_ts")).otherwise(counted("b0", "ts")), "anchor_end_ts": F.when(F.col("energy_source") == "soc_estimate", F.col("end_ts")).otherwise(counted("a1", "ts")),
        "anchor_start_kwh": (counted("b0", "v") / 1000).cast("double"), "anchor_end_kwh": (counted("a1", "v") / 1000).cast("double"),
    })
    return found.withColumn("capacity_kwh", F.when(~F.col("outside_band"), F.col("capacity_kwh"))).drop(*(f"{c}_{x}" for c in ("soc", "odometer_km", "total_wh", "moving_wh", "lat", "lon") for x in ("b0", "a0", "b1", "a1", "n")))


def speed_rows(rows: DataFrame, logger: DataFrame | None = None, prefer_logger: bool = False) -> DataFrame:
    """The samples that each leg's speed comes from: its own, or the logger's (vehicle, leg, ts, row_no, speed_kmh) where
    the leg has no speed above zero, or wherever there are any with ``prefer_logger``."""
    own = rows.select(*LEG, "ts", F.col("row_no").cast("long").alias("row_no"), F.col("speed_kmh").cast("double").alias("speed_kmh"), F.lit(False).alias("logged"))
    if logger is None:
        return own.drop("logged")
    both = own.unionByName(logger.select(*LEG, "ts", F.col("row_no").cast("long").alias("row_no"), F.col("speed_kmh").cast("double").alias("speed_kmh"), F.lit(True).alias("logged")))
    leg = Window.partitionBy(*LEG)
    moves = F.bool_or(~F.col("logged") & F.coalesce(F.col("speed_kmh") > 0, F.lit(False))).over(leg)
    return both.withColumn("use", F.bool_or("logged").over(leg) & (F.lit(prefer_logger) | ~moves)).where(F.col("logged") == F.col("use")).drop("logged", "use")


def with_logger_mass(rows: DataFrame, logger: DataFrame, tolerance_min: float = 5.0) -> DataFrame:
    """``rows`` whose legs have no mass above zero take the logger's (vehicle, leg, ts, row_no, mass_kg) nearest in time, if it is near enough."""
    bare = F.bool_and(F.coalesce(F.col("mass_kg") <= 0, F.lit(True))).over(Window.partitionBy(*LEG))
    marked = rows.withColumn("__bare", bare)
    asked = marked.where("__bare").select(*LEG, F.col("row_no").alias("of_row"), F.col("ts").alias("at"))
    known = logger.select(*LEG, "ts", "row_no", F.col("mass_kg").cast("double").alias("logger_kg"))
    near = as_of_nearest(asked, known, "logger_kg", ["of_row"], tolerance_min).select(*LEG, F.col("of_row").alias("row_no"), "logger_kg")
    joined = marked.join(near, [*LEG, "row_no"], "left")
    return joined.withColumn("mass_kg", F.when(F.col("__bare"), F.col("logger_kg")).otherwise(F.col("mass_kg"))).select(*rows.columns)


def discharge_segments(rows: DataFrame, charges: DataFrame | None = None, trip_options: dict | None = None, block_options: dict | None = None, trip_limits: dict | None = None, block_limits: dict | None = None, nominal_kwh: float | None = None, min_block_km: float = 0.0, confirmed_km: float | None = None, logger: DataFrame | None = None, prefer_logger: bool = False) -> DataFrame:
    """Every leg's discharges, by speed or by the state of charge, measured in one pass.

    A leg's ``branch`` (a column of ``rows``; without it all are ``speed``) says how: ``speed``
    takes its trips, from the logger's speed where it has none of its own, ``soc`` the blocks
    in which the charge falls. A speed leg of whose trips none is left, nor rescued by
    the odometer (``confirmed_km``, outside ``charges`` c_start, c_end), takes its blocks instead.
    Blocks under ``min_block_km`` go. Both kinds of windows are one table: readings around
    them are looked up at once and limits go by the kind. Adds ``branch`` and ``seg``.
    """
    if "branch" not in rows.columns:
        rows = rows.withColumn("branch", F.lit("speed"))
    known = F.when(F.col("branch").isin("speed", "soc"), F.col("branch")).otherwise(F.raise_error(F.concat(F.lit("unknown branch "), F.coalesce("branch", F.lit("null")))))
    rows = rows.withColumn("branch", known)
    legs = rows.groupBy(*LEG).agg(F.first("branch").alias("leg_branch"))
    moving = speed_rows(rows.where("branch = 'speed'"), logger, prefer_logger)
    trips = speed_trips(moving, **(trip_options or {})).select(*LEG, "start_ts", "end_ts", F.lit("speed").alias("branch"), F.lit(None).cast("double").alias("start_soc"), F.lit(None).cast("double").alias("end_soc"), us("motion_start_ts").alias("seg"))
    blocks = discharge_blocks(rows, **(block_options or {})).select(*LEG, "start_ts", "end_ts", F.lit("soc").alias("branch"), F.col("start_soc").cast("double").alias("start_soc"), F.col("end_soc").cast("double").alias("end_soc"), us("start_ts").alias("seg"))
    by_block = F.col("branch") == "soc"
    sides = [trip_limits or {}, block_limits or {}]
    by_kind = lambda name: F.when(by_block, sides[1].get(name, 0.0)).otherwise(sides[0].get(name, 0.0))
    bands = [side.get("band") for side in sides]
    band = tuple(F.when(by_block, bands[1][i] if bands[1] else None).otherwise(bands[0][i] if bands[0] else None) for i in (0, 1)) if any(bands) else None
    ident, rows = ["branch", "seg"], rows.drop("branch")
    measured = measure_trips(written(trips.unionByName(blocks)), rows, ident, nominal_kwh, by_kind("min_soc_drop"), by_kind("min_energy_kwh"), band, ~by_block & F.lit(sides[0].get("keep_outside_band", False)))
    measured = written(measured)
    good = measured.where("failed is null").withColumn("odometer_confirmed", F.lit(False))
    if min_block_km > 0:
        good = good.where((F.col("branch") == "speed") | F.col("distance_km").isNull() | (F.col("distance_km") >= min_block_km))
    if confirmed_km is not None and charges is not None:
        limits = {"nominal_kwh": nominal_kwh, **sides[0]}
        good = good.unionByName(odometer_confirmed(measured.where("branch = 'speed'"), charges, rows, ident, confirmed_km, **limits), allowMissingColumns=True)
    by_speed = F.bool_or(F.col("branch") == "speed").over(Window.partitionBy(*LEG))
    chosen = good.join(legs, LEG).withColumn("by_speed", by_speed & (F.col("leg_branch") == "speed"))
    return chosen.where(F.col("branch") == F.when(F.col("by_speed"), "speed").otherwise("soc")).drop("by_speed", "leg_branch", "failed")


def charge_energy(charges: DataFrame, rows: DataFrame, nominal_kwh: float | None = None, min_energy_kwh: float = 5.0, band: tuple[float, float] | None = None) -> DataFrame:
    """Charges (start_row, end_row, delta_soc, start_ts, end_ts) with energy, type, capacity, anchors and mean place.

    By row position in time order: the last row with both counters at or before the start row,
    else the first there is, and the first at or after the end row, else the last; energy is
    their change if the second lies after the first and it is positive, else the charge's
    share of ``nominal_kwh``. Charges under ``min_energy_kwh`` or outside the band go.
    """
    w = Window.partitionBy(*LEG).orderBy("ts", "row_no")
    placed = rows.withColumn("place", F.row_number().over(w))
    both = F.when(F.col("ac_wh").isNotNull() & F.col("dc_wh").isNotNull(), F.struct("place", "ts", F.col("ac_wh").alias("ac"), F.col("dc_wh").alias("dc")))
    # What follows is what precedes in the opposite order: a frame to the end would be read anew for each row.
    upto, onward, leg = w.rowsBetween(Window.unboundedPreceding, 0), backwards().rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*LEG)
    placed = placed.withColumn("both", both).select(*LEG, "row_no", F.coalesce(F.last("both", True).over(upto), F.min("both").over(leg)).alias("low"), F.coalesce(F.last("both", True).over(onward), F.max("both").over(leg)).alias("high"))
    found = charges.join(placed.select(*LEG, F.col("row_no").alias("start_row"), "low"), [*LEG, "start_row"]).join(placed.select(*LEG, F.col("row_no").alias("end_row"), "high"), [*LEG, "end_row"])
    ac, dc = (F.col("high.ac") - F.col("low.ac")) / 1000, (F.col("high.dc") - F.col("low.dc")) / 1000
    counted = F.when((F.col("low.place") < F.col("high.place")) & (ac + dc > 0), ac + dc)
    found = found.withColumns({"counted": counted, "energy_source": F.when(counted.isNotNull(), "ac_dc").when(F.lit(nominal_kwh is not None), "soc_estimate")})
    found = found.withColumn("delta_kwh", F.coalesce("counted", F.col("delta_soc") / 100 * F.lit(nominal_kwh).cast("double")))
    is_counted = F.col("energy_source") == "ac_dc"
    kind = F.when(~is_counted, "estimated").when((ac >= 0.5) & (dc >= 0.5), "Mix charge").when(ac >= 0.5, "AC charge").otherwise("DC charge")
    found = found.withColumns({
        "charge_type": kind, "ac_kwh": F.when(is_counted, ac), "dc_kwh": F.when(is_counted, dc), "capacity_kwh": F.col("delta_kwh") / (F.col("delta_soc") / 100),
        "anchor_start_ts": F.when(is_counted, F.col("low.ts")).otherwise(F.col("start_ts")), "anchor_end_ts": F.when(is_counted, F.col("high.ts")).otherwise(F.col("end_ts")),
    })
    found = found.where((F.col("delta_kwh") >= min_energy_kwh) & (F.col("delta_kwh") > 0))
    if band:
        found = found.where(F.col("capacity_kwh").between(*band))
    return found.drop("low", "high", "counted")


def charge_places(charges: DataFrame, rows: DataFrame, ident: list[str]) -> DataFrame:
    """``charges`` with the mean latitude and longitude of their samples, to five decimals."""
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    mean = in_interval(rows, charges, keys).groupBy(*keys).agg(F.round(F.avg("lat"), 5).alias("lat"), F.round(F.avg("lon"), 5).alias("lon"))
    return charges.join(mean, keys, "left")


def fastest_drop(samples: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, step_pct, step_rate``: of the drops between readings in a row the one quickest by the hour; the first on ties."""
    w = Window.partitionBy(*keys).orderBy("ts", "row_no")
    drop = F.lag("soc").over(w) - F.col("soc")
    hours = (us("ts") - us(F.lag("ts").over(w))) / 3.6e9
    steps = samples.where(F.col("soc").isNotNull()).select(*keys, "ts", "row_no", drop.alias("drop"), hours.alias("hours")).where("drop > 0 and hours > 0")
    best = steps.groupBy(*keys).agg(F.min_by(F.struct("drop", "hours"), F.struct(-F.col("drop") / F.col("hours"), "ts", "row_no")).alias("best"))
    return best.select(*keys, F.col("best.drop").alias("step_pct"), (F.col("best.drop") / F.col("best.hours")).alias("step_rate"))


def odometer_confirmed(measured: DataFrame, charges: DataFrame, rows: DataFrame, ident: list[str], min_km: float = 0.5, **limits) -> DataFrame:
    """What trips that failed a floor leave on the odometer's word: their parts outside charges (c_start, c_end)
    of at least ``min_km``. A part of a trip that a charge cut and whose charge rose is measured again; one
    that the band rejects goes. All others, and those whose change is a single impossible step, keep their
    distance but no energy (``distance_only``)."""
    if not min_km > 0:
        raise ValueError("the least confirmed distance must be positive")
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    rejected = measured.where(F.col("failed").isNotNull() & (F.col("failed") != "band")).select(*keys, "start_ts", "end_ts", F.coalesce(F.col("end_soc") > F.col("start_soc"), F.lit(False)).alias("rose"))
    parts = subtract_intervals(rejected, charges, ident).select(*keys, F.col("part_start").alias("start_ts"), F.col("part_end").alias("end_ts"), (F.col("cut") & F.col("rose")).alias("again"))
    part_ident = [*ident, "start_ts"]
    found = measure_trips(written(parts), rows, part_ident, **limits).where(F.col("distance_km") >= min_km).where(~(F.col("again") & (F.coalesce("failed", F.lit("")) == "band")))
    found = written(found)
    steps = fastest_drop(in_interval(rows, found.withColumn("at", us("start_ts")), [*keys, "at"]), [*keys, "at"])
    found = found.withColumn("at", us("start_ts")).join(steps, [*keys, "at"], "left").drop("at")
    one_step = F.coalesce((F.col("step_rate") > STEP_RATE) & (F.col("step_pct") >= STEP_SHARE * F.abs("delta_soc")), F.lit(False))
    energy = F.col("again") & F.col("failed").isNull() & ~one_step
    gone = ["delta_kwh", "capacity_kwh", "anchor_start_ts", "anchor_end_ts", "anchor_start_kwh", "anchor_end_kwh"]
    return found.withColumns({**{c: F.when(energy, F.col(c)) for c in gone}, "energy_source": F.when(energy, F.col("energy_source")).otherwise("distance_only"), "delta_soc": F.when(F.col("start_soc").isNotNull() & F.col("end_soc").isNotNull(), F.col("delta_soc")), "failed": F.lit(None).cast("string"), "odometer_confirmed": F.lit(True)}).drop("again", "step_pct", "step_rate")


def split_at(segments: DataFrame, splits: DataFrame, rows: DataFrame, ident: list[str], min_soc_drop: float = 5.0, min_energy_kwh: float = 2.0) -> DataFrame:
    """``segments`` cut at ``splits`` (vehicle, leg, ``ident``, split_ts), energy shared out by the change of charge.

    The charge at a split lies on the line between the readings around it, the odometer is the
    one at or before it. Parts under either floor go; a segment of which none is left, or
    that has no energy (``distance_only``), stays whole. Parts have no energy anchors.
    """
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    inside = splits.join(segments.where("energy_source <> 'distance_only'").select(*keys, "start_ts", "end_ts"), keys).where((F.col("split_ts") > F.col("start_ts")) & (F.col("split_ts") < F.col("end_ts"))).select(*keys, "split_ts").distinct()
    points = around(inside.withColumn("at", us("split_ts")), rows, ["soc", "odometer_km", "lat", "lon"], [*ident, "at"], "split_ts", "split_ts")
    point = F.struct(F.col("split_ts").alias("ts"), line_at("soc_b0", "soc_a0", F.col("split_ts"), True).alias("soc"), F.col("odometer_km_b0.v").cast("double").alias("km"), F.struct(F.coalesce("lat_a0.v", "lat_b0.v").alias("lat"), F.coalesce("lon_a0.v", "lon_b0.v").alias("lon")).alias("after"), F.struct(F.coalesce("lat_b0.v", "lat_a0.v").alias("lat"), F.coalesce("lon_b0.v", "lon_a0.v").alias("lon")).alias("before"))
    cut = points.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))
    place = lambda a, b: F.struct(F.col(a).cast("double").alias("lat"), F.col(b).cast("double").alias("lon"))
    edge = lambda x: F.struct(F.col(f"{x}_ts").alias("ts"), F.col(f"{x}_soc").cast("double").alias("soc"), F.col(f"odo_{x}_km").alias("km"), place(f"lat_{x}", f"lon_{x}").alias("after"), place(f"lat_{x}", f"lon_{x}").alias("before"))
    whole = segments.join(cut, keys, "left")
    both = whole.where("points is not null").withColumn("points", F.concat(F.array(edge("start")), F.col("points"), F.array(edge("end"))))
    both = both.withColumn("part", F.explode(F.sequence(F.lit(0), F.size("points") - 2)))
    a, b = F.get("points", F.col("part")), F.get("points", F.col("part") + 1)
    change = b["soc"] - a["soc"]
    both = both.withColumns({"a": a, "b": b, "change": change}).withColumn("share", F.col("delta_kwh") * (F.col("change") / F.nullif("delta_soc", F.lit(0.0))))
    good = both.where((-F.col("change") >= min_soc_drop) & (F.abs("share") >= min_energy_kwh))
    new = {
        "start_ts": F.col("a.ts"), "end_ts": F.col("b.ts"), "start_soc": F.col("a.soc"), "end_soc": F.col("b.soc"), "delta_soc": F.col("change"), "delta_kwh": F.col("share"), "delta_moving_kwh": F.lit(None).cast("double"),
        "odo_start_km": F.col("a.km"), "odo_end_km": F.col("b.km"), "distance_km": F.col("b.km") - F.col("a.km"), "lat_start": F.col("a.after.lat"), "lon_start": F.col("a.after.lon"), "lat_end": F.col("b.before.lat"), "lon_end": F.col("b.before.lon"),
        "capacity_kwh": F.when(~F.col("outside_band") & (F.col("change") != 0), F.abs("share") / (F.abs("change") / 100)),
        **{c: F.lit(None).cast(segments.schema[c].dataType) for c in ("anchor_start_ts", "anchor_end_ts", "anchor_start_kwh", "anchor_end_kwh")},
    }
    parts = good.select(*(new.get(c, F.col(c)).alias(c) for c in segments.columns))
    return whole.join(parts.select(*keys).distinct(), keys, "left_anti").select(*segments.columns).unionByName(parts)


def anchors_again(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """Segments whose counter anchors are missing get them from the readings around the segment."""
    marked = segments.withColumn("at", us("start_ts"))
    found = around(marked, rows, ["total_wh", "moving_wh"], ["at"])
    missing = F.col("anchor_start_ts").isNull() | F.col("anchor_end_ts").isNull() | F.col("anchor_start_kwh").isNull() | F.col("anchor_end_kwh").isNull()
    new = {}
    for name, c in (("total_energy", "total_wh"), ("moving_energy", "moving_wh")):
        use = missing & (F.col("energy_source") == name) & F.col(f"{c}_b0").isNotNull() & F.col(f"{c}_a1").isNotNull()
        for column, side, x, unit in (("anchor_start_ts", "b0", "ts", 1), ("anchor_end_ts", "a1", "ts", 1), ("anchor_start_kwh", "b0", "v", 1000), ("anchor_end_kwh", "a1", "v", 1000)):
            value = F.col(f"{c}_{side}.{x}") if unit == 1 else (F.col(f"{c}_{side}.{x}") / unit).cast("double")
            new[column] = F.when(use, value).otherwise(new.get(column, F.col(column)))
    return found.withColumns(new).select(*segments.columns)


def counter_gap_minutes(rows: DataFrame, counter: str) -> DataFrame:
    """``vehicle_id, leg_id, gap_min``: the median time between a counter's readings, from three on."""
    gap = (us("ts") - us(F.lag("ts").over(Window.partitionBy(*LEG).orderBy("ts", "row_no")))) / MINUTE
    gaps = rows.where(F.col(counter).isNotNull()).select(*LEG, gap.alias("gap"))
    return gaps.groupBy(*LEG).agg(F.when(F.count("*") > 2, F.median("gap")).alias("gap_min"))


def audit(segments: DataFrame, rows: DataFrame, ident: list[str]) -> DataFrame:
    """``segments`` with what grading asks: counter_kwh, outside_km, outside_min (between the energy anchors but outside the
    trip), dist_outside_km (between the odometer's own anchors), odo_samples, samples, step_pct, step_rate; where
    ``rows`` have a propulsion counter ``propulsion_kwh`` as well (see ``propulsion_change``), from the same pass."""
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    rows = rows.withColumn("any", F.lit(1))
    drive = ["propulsion_wh"] if "propulsion_wh" in rows.columns else []
    trip = around(segments, rows, ["odometer_km", "any", *drive], ident)
    ends = around(segments.select(*keys, "anchor_start_ts", "anchor_end_ts"), rows, ["odometer_km"], ident, "anchor_start_ts", "anchor_end_ts")
    at_anchors = ends.select(*keys, line_at("odometer_km_b0", "odometer_km_a0", F.col("anchor_start_ts"), True).alias("km_from"), line_at("odometer_km_b1", "odometer_km_a1", F.col("anchor_end_ts"), True).alias("km_to"))
    found = trip.join(at_anchors, keys, "left")
    km0, km1 = line_at("odometer_km_b0", "odometer_km_a0", F.col("start_ts"), True), line_at("odometer_km_b1", "odometer_km_a1", F.col("end_ts"), True)
    more = lambda cond, x: F.when(cond, F.greatest(x, F.lit(0.0))).otherwise(0.0)
    known = F.col("anchor_start_ts").isNotNull() & F.col("anchor_end_ts").isNotNull()
    outside = more(F.col("anchor_start_ts") < F.col("start_ts"), km0 - F.col("km_from")) + more(F.col("anchor_end_ts") > F.col("end_ts"), F.col("km_to") - km1)
    own = more(F.col("odometer_km_b0.ts") < F.col("start_ts"), km0 - F.col("odometer_km_b0.v")) + more(F.col("odometer_km_a1.ts") > F.col("end_ts"), F.col("odometer_km_a1.v") - km1)
    minutes = (F.greatest(us("start_ts") - us("anchor_start_ts"), F.lit(0)) + F.greatest(us("anchor_end_ts") - us("end_ts"), F.lit(0))) / MINUTE
    found = found.withColumns({
        "counter_kwh": F.col("anchor_end_kwh") - F.col("anchor_start_kwh"), "outside_km": F.when(known & F.col("km_from").isNotNull() & F.col("km_to").isNotNull(), outside), "outside_min": F.when(known, minutes),
        "dist_outside_km": F.when(F.col("odometer_km_b0").isNotNull() & F.col("odometer_km_a1").isNotNull(), own), "odo_samples": F.col("odometer_km_n"), "samples": F.col("any_n"),
        "propulsion_kwh": propelled() if drive else F.lit(None).cast("double"),
    })
    steps = fastest_drop(in_interval(rows, segments, keys), keys)
    made = [c for c in ("counter_kwh", "outside_km", "outside_min", "dist_outside_km", "odo_samples", "samples", "propulsion_kwh") if c not in segments.columns]
    return found.select(*segments.columns, *made).join(steps, keys, "left")
