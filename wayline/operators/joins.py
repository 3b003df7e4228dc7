"""As-of and interval joins. Every join is an equi-join on (vehicle, leg) or runs as windows
over a union of both sides, so none is a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.telematics import LEG
from .islands import MINUTE, us


def as_of(instants: DataFrame, samples: DataFrame, value: str, keep: list[str], direction: str = "backward", at: str = "at") -> DataFrame:
    """``instants`` (LEG, ``at``, the ``keep`` columns) with the nearest non-null ``value`` at or
    before (``backward``) or at or after (``forward``) and its time ``<value>_ts``; null if none.

    Of samples at one instant the last row counts going backward, the first going forward.
    """
    back = direction == "backward"
    asked = instants.select(*LEG, F.col(at).alias("ts"), F.struct(*keep).alias("asked"), F.lit(None).cast(samples.schema[value].dataType).alias("v"), F.lit(None).cast("long").alias("row_no"))
    known = samples.where(F.col(value).isNotNull()).select(*LEG, "ts", F.lit(None).cast(asked.schema["asked"].dataType).alias("asked"), F.col(value).alias("v"), F.col("row_no").cast("long"))
    both = known.unionByName(asked)
    # An instant comes after the samples of its time going backward, and last again going forward.
    order = [F.asc("ts") if back else F.desc("ts"), F.col("asked").isNotNull(), F.asc("row_no") if back else F.desc("row_no")]
    w = Window.partitionBy(*LEG).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("hit", F.last(F.when(F.col("asked").isNull(), F.struct("v", "ts")), True).over(w)).where(F.col("asked").isNotNull())
    return found.select(*LEG, F.col("ts").alias(at), "asked.*", F.col("hit.v").alias(value), F.col("hit.ts").alias(f"{value}_ts"))


def as_of_nearest(instants: DataFrame, samples: DataFrame, value: str, keep: list[str], tolerance_min: float = 5.0, at: str = "at") -> DataFrame:
    """The nearest value within the tolerance on either side; the earlier one on ties."""
    back = as_of(instants, samples, value, keep, "backward", at).withColumnsRenamed({value: "v0", f"{value}_ts": "t0"})
    both = as_of(back, samples, value, [*keep, "v0", "t0"], "forward", at)
    most = int(tolerance_min * MINUTE)
    d0, d1 = us(at) - us("t0"), us(f"{value}_ts") - us(at)
    ok0, ok1 = F.coalesce(d0 <= most, F.lit(False)), F.coalesce(d1 <= most, F.lit(False))
    pick = lambda a, b: F.when(ok0 & (~ok1 | (d0 <= d1)), a).when(ok1, b)
    return both.select(*LEG, at, *keep, pick(F.col("v0"), F.col(value)).alias(value), pick(F.col("t0"), F.col(f"{value}_ts")).alias(f"{value}_ts"))


def overlapping(windows: DataFrame, other: DataFrame, keys: list[str], tolerance_min: float = 0.0, bucket_min: float = 24 * 60.0) -> DataFrame:
    """Pairs of ``windows`` (start_ts, end_ts) and ``other`` (o_start, o_end) that overlap, give or
    take the tolerance. Both are dealt to the time buckets that they reach into, so a long
    history is no single join key; a pair counts in the first bucket both are in."""
    size, slack = int(bucket_min * MINUTE), int(tolerance_min * MINUTE)
    spread = lambda start, end: F.explode(F.sequence(F.floor(start / size), F.floor(F.greatest(end, start) / size)))
    a = windows.withColumn("bucket", spread(us("start_ts") - slack, us("end_ts") + slack))
    b = other.withColumn("bucket", spread(us("o_start"), us("o_end")))
    pairs = a.join(b, [*keys, "bucket"]).where((us("o_start") <= us("end_ts") + slack) & (us("o_end") >= us("start_ts") - slack))
    first = F.floor(F.greatest(us("start_ts") - slack, us("o_start")) / size)
    return pairs.where(F.col("bucket") == first).drop("bucket")


def first_overlap(windows: DataFrame, other: DataFrame, keys: list[str], ident: list[str], tolerance_min: float, order: str = "list_order") -> DataFrame:
    """The ``uri`` of the first of ``other`` in list order that overlaps; null if none does."""
    hit = overlapping(windows, other, keys, tolerance_min).groupBy(*ident).agg(F.min_by("uri", order).alias("uri"))
    return windows.join(hit, ident, "left")


def all_overlaps(windows: DataFrame, other: DataFrame, keys: list[str], ident: list[str], tolerance_min: float) -> DataFrame:
    """The earliest overlapping ``uri`` and the sum of the known energies (null if none is known)."""
    hit = overlapping(windows, other, keys, tolerance_min).groupBy(*ident).agg(F.min_by("uri", F.struct("o_start", "uri")).alias("uri"), F.sum("energy_kwh").alias("energy_kwh"))
    return windows.join(hit, ident, "left")


def in_interval(samples: DataFrame, windows: DataFrame, ident: list[str], bucket_min: float = 24 * 60.0) -> DataFrame:
    """Samples of each window, both ends included."""
    size = int(bucket_min * MINUTE)
    a = samples.withColumn("bucket", F.floor(us("ts") / size))
    b = windows.select(*LEG, *(c for c in ident if c not in LEG), "start_ts", "end_ts").withColumn("bucket", F.explode(F.sequence(F.floor(us("start_ts") / size), F.floor(us("end_ts") / size))))
    return a.join(b, [*LEG, "bucket"]).where(F.col("ts").between(F.col("start_ts"), F.col("end_ts"))).drop("bucket")


def subtract_intervals(trips: DataFrame, charges: DataFrame, ident: list[str]) -> DataFrame:
    """The parts of each trip outside all charges (c_start, c_end), ``part_start`` and ``part_end``, with the trip's other
    columns and ``cut``, whether a charge overlapped it. A trip that charges cover leaves no part."""
    keys = [*LEG, *(c for c in ident if c not in LEG)]
    other = charges.where("c_start < c_end").select(*LEG, F.col("c_start").alias("o_start"), F.col("c_end").alias("o_end"))
    pairs = overlapping(trips.select(*keys, "start_ts", "end_ts"), other, LEG).where((F.col("o_start") < F.col("end_ts")) & (F.col("o_end") > F.col("start_ts")))
    # A trip meets few charges: their ends so far give each part's start.
    cuts = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("o_start", "o_end"))).alias("__cuts"))
    rows = trips.join(cuts, keys, "left")
    part = lambda a, b: F.array(F.struct(a.alias("part_start"), b.alias("part_end")))
    begin = F.struct(F.array().cast("array<struct<part_start:timestamp,part_end:timestamp>>").alias("parts"), F.col("start_ts").alias("cursor"))
    walk = F.aggregate("__cuts", begin, lambda s, c: F.struct(F.when(c["o_start"] > s["cursor"], F.concat(s["parts"], part(s["cursor"], c["o_start"]))).otherwise(s["parts"]).alias("parts"), F.greatest(s["cursor"], c["o_end"]).alias("cursor")))
    rows = rows.withColumn("__walk", walk)
    tail = F.when(F.col("__walk.cursor") < F.col("end_ts"), F.concat("__walk.parts", part(F.col("__walk.cursor"), F.col("end_ts")))).otherwise(F.col("__walk.parts"))
    parts = F.when(F.col("__cuts").isNull(), part(F.col("start_ts"), F.col("end_ts"))).otherwise(tail)
    return rows.select(*trips.columns, F.col("__cuts").isNotNull().alias("cut"), F.inline(parts))


def reconcile_charges(charges: DataFrame, trips: DataFrame, ident: list[str]) -> DataFrame:
    """Charges (start_ts, end_ts) cut back where trips (o_start, o_end) reach into them; one that
    holds a trip, lies in one, or would have no length stays as it is."""
    pairs = overlapping(charges, trips, LEG).where((F.col("o_start") < F.col("end_ts")) & (F.col("o_end") > F.col("start_ts")))
    inside = F.col("o_start") >= F.col("start_ts")
    ends_in = F.col("o_end") <= F.col("end_ts")
    cuts = pairs.groupBy(*LEG, *ident).agg(
        F.min(F.when(inside & ~ends_in, F.col("o_start"))).alias("new_end"), F.max(F.when(ends_in & ~inside, F.col("o_end"))).alias("new_start"), F.bool_or((inside & ends_in) | (~inside & ~ends_in)).alias("holds"))
    rows = charges.join(cuts, [*LEG, *ident], "left")
    start, end = F.coalesce("new_start", "start_ts"), F.coalesce("new_end", "end_ts")
    keep = F.coalesce("holds", F.lit(True)) | (start >= end)
    return rows.withColumns({"start_ts": F.when(keep, F.col("start_ts")).otherwise(start), "end_ts": F.when(keep, F.col("end_ts")).otherwise(end)}).drop("new_start", "new_end", "holds")


def charge_between(trips: DataFrame, charges: DataFrame) -> DataFrame:
    """``trips`` with ``charge_between``: whether a charge (o_start, o_end) strictly overlaps the
    gap between the trip before and this one."""
    w = Window.partitionBy(*LEG).orderBy("start_ts", "end_ts")
    gaps = trips.withColumn("gap_start", F.lag("end_ts").over(w))
    asked = gaps.where("gap_start < start_ts").select(*LEG, F.col("start_ts").alias("trip_start"), F.col("gap_start").alias("start_ts"), F.col("start_ts").alias("end_ts"))
    hit = overlapping(asked, charges, LEG).where((F.col("o_start") < F.col("end_ts")) & (F.col("o_end") > F.col("start_ts")))
    hit = hit.select(*LEG, F.col("trip_start").alias("start_ts"), F.lit(True).alias("hit")).distinct()
    return gaps.join(hit, [*LEG, "start_ts"], "left").withColumn("charge_between", F.coalesce("hit", F.lit(False))).drop("hit", "gap_start")


def dated_setting(rows: DataFrame, settings: DataFrame, day: str = "leg_date") -> DataFrame:
    """``rows`` with the ``value`` of the first settings window that holds the day: from it on, before
    its open or given end. Days are looked up once each, not row by row."""
    days = rows.select("vehicle_id", day).distinct()
    hit = days.join(settings, "vehicle_id").where((F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to"))))
    hit = hit.groupBy("vehicle_id", day).agg(F.min_by("value", "valid_from").alias("value"))
    return rows.join(hit, ["vehicle_id", day], "left")
