"""Segments of a leg's timeline: trips by speed, charges and discharges by state of charge, stops.

Each operator is a window over (vehicle, leg) in time order and an aggregate on the same
key, so a leg's rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.telematics import LEG

MINUTE = 60_000_000  # microseconds


def in_time(*keys: str) -> Window:
    return Window.partitionBy(*(keys or LEG)).orderBy("ts", "row_no")


def backwards(*keys: str) -> Window:
    return Window.partitionBy(*(keys or LEG)).orderBy(F.desc("ts"), F.desc("row_no"))


def us(column: str | Column) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def speed_trips(rows: DataFrame, threshold: float = 1.0, min_stop_min: float = 5.0, min_trip_min: float = 2.0, anchor: str = "zero_speed", max_extend_min: float = 5.0) -> DataFrame:
    """``vehicle_id, leg_id, start_ts, end_ts, motion_start_ts, motion_end_ts`` of each trip.

    A sample moves if its speed (null: 0) is over the threshold. Stops of at most
    ``min_stop_min`` are bridged; trips shorter than ``min_trip_min``, first to last motion, go.
    With the ``zero_speed`` anchor an end moves out to the nearest standing sample, if that
    is within ``max_extend_min``.
    """
    if anchor not in ("zero_speed", "first_motion"):
        raise ValueError(f"unknown trip endpoint anchor {anchor!r}")
    w = in_time()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    speed = F.coalesce("speed_kmh", F.lit(0.0))
    marked = rows.select(*LEG, "ts", "row_no", (speed > threshold).alias("moving"), (speed == 0).alias("zero"))
    marked = marked.withColumn("place", F.row_number().over(w))
    moved = F.when(F.col("moving"), F.struct("place", "ts"))
    standing = F.when(F.col("zero"), F.col("ts"))
    marked = marked.withColumns({"moved": F.last(moved, True).over(before), "zero_before": F.last(standing, True).over(before)})
    if anchor == "zero_speed":
        marked = marked.withColumn("zero_after", F.last(standing, True).over(backwards().rowsBetween(Window.unboundedPreceding, -1)))
    apart = F.col("moved").isNull() | ((F.col("place") - F.col("moved.place") > 1) & (us("ts") - us("moved.ts") > int(min_stop_min * MINUTE)))
    moving = marked.where("moving").withColumn("trip", F.sum(apart.cast("long")).over(w))
    sums = [F.min("ts").alias("motion_start_ts"), F.max("ts").alias("motion_end_ts")]
    if anchor == "zero_speed":
        sums += [F.min_by("zero_before", "place").alias("zero_before"), F.max_by("zero_after", "place").alias("zero_after")]
    trips = moving.groupBy(*LEG, "trip").agg(*sums).where(us("motion_end_ts") - us("motion_start_ts") >= int(min_trip_min * MINUTE))
    start, end = F.col("motion_start_ts"), F.col("motion_end_ts")
    if anchor == "zero_speed":
        most = int(max_extend_min * MINUTE)
        start = F.when(us("motion_start_ts") - us("zero_before") <= most, F.col("zero_before")).otherwise(start)
        end = F.when(us("zero_after") - us("motion_end_ts") <= most, F.col("zero_after")).otherwise(end)
    return trips.select(*LEG, start.alias("start_ts"), end.alias("end_ts"), "motion_start_ts", "motion_end_ts")


def _soc_blocks(rows: DataFrame, sign: int, plateau_min: float, most_against: float) -> DataFrame:
    """Blocks of readings that go in the direction of ``sign``, merged over plateaus."""
    w = in_time()
    known = rows.where(F.col("soc").isNotNull()).select(*LEG, "ts", "row_no", "soc")
    last = F.lag(F.struct("ts", "soc", "row_no")).over(w)
    step = known.withColumns({"place": F.row_number().over(w), "from": last}).withColumn("change", (F.col("soc") - F.col("from.soc")) * sign)
    step = step.withColumns({"on": F.coalesce(F.col("change") > 0, F.lit(False)), "against": F.greatest(-F.col("change"), F.lit(0.0))})
    # Islands of steps in the direction; between two of them the largest step against it.
    step = step.withColumn("island", F.sum((F.col("on") & ~F.coalesce(F.lag("on").over(w), F.lit(False))).cast("long")).over(w))
    blocks = step.where("island > 0").groupBy(*LEG, "island").agg(
        F.min_by("from", F.when(F.col("on"), F.col("place"))).alias("a"),
        F.min(F.when(F.col("on"), F.col("ts"))).alias("first_on"),
        F.max_by(F.struct("ts", "soc", "row_no"), F.when(F.col("on"), F.col("place"))).alias("b"),
        F.max(F.when(~F.col("on"), F.col("against"))).alias("against"),
    )
    by_start = Window.partitionBy(*LEG).orderBy("island")
    previous = F.lag(F.struct("b", "against")).over(by_start)
    blocks = blocks.withColumn("previous", previous)
    gap = us("first_on") - us("previous.b.ts")
    against = F.coalesce(F.col("previous.against"), F.lit(0.0))
    joins = (gap <= int(plateau_min * MINUTE)) & ((against == 0) if most_against == 0 else (against < most_against))
    blocks = blocks.withColumn("block", F.sum((~F.coalesce(joins, F.lit(False))).cast("long")).over(by_start))
    merged = blocks.groupBy(*LEG, "block").agg(F.min_by("a", "island").alias("a"), F.max_by("b", "island").alias("b"))
    return merged.select(*LEG, F.col("a.ts").alias("start_ts"), F.col("b.ts").alias("end_ts"), F.col("a.row_no").alias("start_row"), F.col("b.row_no").alias("end_row"), F.col("a.soc").alias("start_soc"), F.col("b.soc").alias("end_soc"), (F.col("b.soc") - F.col("a.soc")).alias("delta_soc"))


def charge_blocks(rows: DataFrame, plateau_min: float = 60.0, min_rise: float = 5.0) -> DataFrame:
    """Rising state of charge, from the reading before it; merged over plateaus without a drop."""
    return _soc_blocks(rows, 1, plateau_min, 0.0).where((F.col("delta_soc") >= min_rise) & (F.col("delta_soc") > 0))


def discharge_blocks(rows: DataFrame, plateau_min: float = 60.0, rise_abort: float = 2.0, min_drop: float = 10.0) -> DataFrame:
    """Falling state of charge; merged over plateaus without a rise of ``rise_abort`` or more."""
    return _soc_blocks(rows, -1, plateau_min, rise_abort).where((-F.col("delta_soc") >= min_drop) & (F.col("delta_soc") < 0))


def stop_rows(segments: DataFrame, least_seconds: float = 60.0, keys: tuple[str, ...] = ("vehicle_id",)) -> DataFrame:
    """A row for each gap of more than ``least_seconds`` between a segment and the next."""
    w = Window.partitionBy(*keys).orderBy("start_ts", "end_ts")
    gaps = segments.select(*keys, F.col("end_ts").alias("stop_start"), F.lead("start_ts").over(w).alias("stop_end"))
    return gaps.where(us("stop_end") - us("stop_start") > int(least_seconds * 1_000_000))


def merge_adjacent(segments: DataFrame, max_gap_min: float) -> DataFrame:
    """Neighbouring trips of one mass class joined: gap under the limit, no charge between,
    class known on both sides, neither of them ``distance_only``.

    Needs ``mass_class, energy_source, delta_kwh, charge_between`` (whether a charge lies
    between the segment before and this one).
    """
    w = Window.partitionBy(*LEG).orderBy("start_ts", "end_ts")
    before = F.lag(F.struct("end_ts", "mass_class", "energy_source")).over(w)
    rows = segments.withColumn("before", before)
    joins = (us("start_ts") - us("before.end_ts") < int(max_gap_min * MINUTE)) & (F.col("mass_class") == F.col("before.mass_class")) & ~F.col("charge_between") & (F.col("energy_source") != "distance_only") & (F.col("before.energy_source") != "distance_only")
    rows = rows.withColumn("group", F.sum((~F.coalesce(joins, F.lit(False))).cast("long")).over(w))
    # The better source names the whole: total, then moving energy, then the charge.
    better = F.struct(F.when(F.col("energy_source") == "total_energy", 0).when(F.col("energy_source") == "moving_energy", 1).when(F.col("energy_source") == "soc_estimate", 2).otherwise(9), "start_ts")
    has = lambda names: [c for c in names if c in segments.columns]
    firsts = has(["start_soc", "odo_start_km", "lat_start", "lon_start", "anchor_start_ts", "anchor_start_kwh", "seg"])
    lasts = has(["end_soc", "odo_end_km", "lat_end", "lon_end", "anchor_end_ts", "anchor_end_kwh"])
    merged = rows.groupBy(*LEG, "group").agg(
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.count("*").alias("n_parts"), F.first("mass_class").alias("mass_class"),
        F.min_by("energy_source", better).alias("energy_source"), F.when(F.count("delta_kwh") == F.count("*"), F.sum("delta_kwh")).alias("delta_kwh"),
        *(F.min_by(c, F.struct("start_ts", "end_ts")).alias(c) for c in firsts), *(F.max_by(c, F.struct("start_ts", "end_ts")).alias(c) for c in lasts),
        *(F.bool_or(c).alias(c) for c in has(["outside_band", "odometer_confirmed"])), *(F.when(F.count("*") == 1, F.first(c)).alias(f"__{c}") for c in has(["delta_moving_kwh", "capacity_kwh"])),
    )
    if "start_soc" in segments.columns:
        merged = merged.withColumns({"delta_soc": F.col("end_soc") - F.col("start_soc"), "distance_km": F.col("odo_end_km") - F.col("odo_start_km")})
        outside = F.coalesce("outside_band", F.lit(False)) if "outside_band" in segments.columns else F.lit(False)
        capacity = F.when((F.abs("delta_soc") > 0) & ~outside, F.abs("delta_kwh") / (F.abs("delta_soc") / 100))
        merged = merged.withColumns({"capacity_kwh": F.when(F.col("n_parts") > 1, capacity).otherwise(F.col("__capacity_kwh")), "delta_moving_kwh": F.col("__delta_moving_kwh")}).drop("__capacity_kwh", "__delta_moving_kwh")
    return merged.drop("group")


def clamp_anchors(segments: DataFrame) -> DataFrame:
    """Energy anchors that reach past the next segment's start anchor are cut there, if the energy stays negative.

    Needs energy_source, delta_kwh, delta_soc, capacity_kwh, outside_band and anchor_start_ts,
    anchor_end_ts, anchor_start_kwh, anchor_end_kwh. Only segments that are cut change: their
    energy is that between the anchors, their capacity follows it unless they are outside the
    band. ``distance_only`` segments take no part; their neighbours meet each other. A segment
    without anchors of its own, or estimated from the charge, is neither cut nor cuts.
    """
    no_part = F.coalesce(F.col("energy_source") == "distance_only", F.lit(False))
    w = Window.partitionBy(*LEG, "__apart").orderBy("start_ts", "end_ts")
    anchors = [F.col(f"anchor_{side}_{x}") for side in ("start", "end") for x in ("ts", "kwh")]
    usable = F.coalesce(F.col("energy_source") != "soc_estimate", F.lit(True))
    for anchor in anchors:
        usable &= anchor.isNotNull()
    rows = segments.withColumns({"__apart": no_part, "__usable": usable & ~no_part})
    rows = rows.withColumn("__next", F.lead(F.struct("anchor_start_ts", "anchor_start_kwh", "__usable")).over(w))
    energy = F.col("anchor_start_kwh") - F.col("__next.anchor_start_kwh")
    cuts = F.coalesce(F.col("__usable") & F.col("__next.__usable") & (F.col("anchor_end_ts") > F.col("__next.anchor_start_ts")) & (energy < 0), F.lit(False))
    follows = cuts & (F.abs("delta_soc") > 0) & ~F.coalesce("outside_band", F.lit(False))
    return rows.withColumns({
        "clamped": cuts,
        "delta_kwh": F.when(cuts, energy).otherwise(F.col("delta_kwh")),
        "capacity_kwh": F.when(follows, F.abs(energy) / (F.abs("delta_soc") / 100)).otherwise(F.col("capacity_kwh")),
        "anchor_end_ts": F.when(cuts, F.col("__next.anchor_start_ts")).otherwise(F.col("anchor_end_ts")),
        "anchor_end_kwh": F.when(cuts, F.col("__next.anchor_start_kwh")).otherwise(F.col("anchor_end_kwh")),
    }).drop("__next", "__apart", "__usable")
