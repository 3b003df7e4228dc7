"""Vehicle mass: robust estimators per segment, mass classes and where they change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.telematics import LEG

TRACTOR_ONLY_KG = 13_000.0
ESTIMATORS = ("mean", "median", "iqr_median", "mad_median", "iqr_mean", "mad_mean", "mad_tw_mean", "trimmed_mean")


def moving_samples(samples: DataFrame, keys: list[str], least: int = 2, over_kmh: float = 1.0) -> DataFrame:
    """Positive mass readings of moving rows, or all positive ones of a segment with fewer than ``least``."""
    good = samples.where(F.col("mass_kg") > 0).withColumn("moving", F.coalesce(F.col("speed_kmh") > over_kmh, F.lit(False)))
    n = F.sum(F.col("moving").cast("int")).over(Window.partitionBy(*keys))
    return good.withColumn("n_moving", n).where((F.col("n_moving") < least) | F.col("moving")).drop("n_moving", "moving")


def inliers(samples: DataFrame, keys: list[str], fence: str) -> DataFrame:
    """Readings inside the fence of their segment: ``none``, ``iqr`` (1.5 times, linear quartiles),
    ``mad`` (3 times, raw) or ``trimmed`` (a fifth off either end). A fence of no width, or
    one that leaves fewer than two readings, keeps all."""
    if fence == "none":
        return samples
    every = Window.partitionBy(*keys)
    if fence == "trimmed":
        rows = samples.withColumns({"n": F.count("*").over(every), "r": F.row_number().over(every.orderBy("mass_kg", "ts", "row_no"))})
        cut = F.floor(F.col("n") * 0.2)
        return rows.where((F.col("r") > cut) & (F.col("r") <= F.col("n") - cut)).drop("n", "r")
    if fence == "iqr":
        stats = samples.groupBy(*keys).agg(F.percentile("mass_kg", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
        iqr = F.element_at("q", 2) - F.element_at("q", 1)
        bounds = stats.select(*keys, (F.element_at("q", 1) - 1.5 * iqr).alias("low"), (F.element_at("q", 2) + 1.5 * iqr).alias("high"), iqr.alias("width"))
    else:
        middle = samples.groupBy(*keys).agg(F.median("mass_kg").alias("middle"))
        mad = samples.join(middle, keys).groupBy(*keys, "middle").agg(F.median(F.abs(F.col("mass_kg") - F.col("middle"))).alias("width"))
        bounds = mad.select(*keys, (F.col("middle") - 3 * F.col("width")).alias("low"), (F.col("middle") + 3 * F.col("width")).alias("high"), "width")
    marked = samples.join(bounds, keys).withColumn("inside", F.col("mass_kg").between(F.col("low"), F.col("high")))
    marked = marked.withColumn("n_in", F.sum(F.col("inside").cast("int")).over(every))
    return marked.where((F.col("width") <= 0) | (F.col("n_in") < 2) | F.col("inside")).drop("low", "high", "width", "inside", "n_in")


def mass_estimate(samples: DataFrame, keys: list[str], method: str = "mean") -> DataFrame:
    """``keys, n, n_kept, mass_kg, mass_cv`` of segments with two readings or more; an unknown method is the mean."""
    method = method if method in ESTIMATORS else "mean"
    fence = method.split("_")[0] if "_" in method else "none"
    n = samples.groupBy(*keys).agg(F.count("*").alias("n")).where("n >= 2")
    kept = inliers(samples, keys, fence)
    if method == "mad_tw_mean":
        w = Window.partitionBy(*keys).orderBy("ts", "row_no")
        t = F.unix_micros("ts") / 1e6
        kept = kept.withColumn("weight", (F.coalesce(F.lead(t).over(w), t) - F.coalesce(F.lag(t).over(w), t)) / 2)
        value = F.when((F.count("*") >= 2) & (F.sum("weight") > 0), F.sum(F.col("weight") * F.col("mass_kg")) / F.sum("weight")).otherwise(F.avg("mass_kg"))
    else:
        value = F.median("mass_kg") if method.endswith("median") else F.avg("mass_kg")
    cv = F.when(F.avg("mass_kg") > 0, F.stddev_samp("mass_kg") / F.avg("mass_kg"))
    return n.join(kept.groupBy(*keys).agg(F.count("*").alias("n_kept"), value.alias("mass_kg"), cv.alias("mass_cv")), keys)


def mass_classes(rows: DataFrame, min_gap_kg: float = 4000.0, over_kmh: float = 1.0) -> DataFrame:
    """``rows`` with ``mass_class``: 0 for the lightest group of readings that gaps of ``min_gap_kg``
    set apart. Each reading takes the class of the nearest group mean, the lower on ties.
    A lightest group under ``TRACTOR_ONLY_KG`` has no class.

    Groups come from moving readings (all readings of a leg without speed). Means of
    neighbouring groups are always a gap apart, so no groups are left to merge.
    """
    by_mass = Window.partitionBy(*LEG).orderBy("mass_kg")
    moves = F.coalesce(F.col("speed_kmh") > over_kmh, F.lit(False))
    has_speed = F.count("speed_kmh").over(Window.partitionBy(*LEG)) > 0
    valid = rows.where(F.col("mass_kg") > 0).select(*LEG, "mass_kg", moves.alias("moves"), has_speed.alias("has_speed")).where(F.col("moves") | ~F.col("has_speed"))
    gap = F.coalesce(F.col("mass_kg") - F.lag("mass_kg").over(by_mass), F.lit(0.0)) >= min_gap_kg
    groups = valid.withColumn("gap", gap.cast("int")).withColumn("g", F.sum("gap").over(by_mass.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*LEG, "g").agg(F.avg("mass_kg").alias("mean"))
    # A leg has a handful of groups: a mass range over a gap.
    centres = groups.groupBy(*LEG).agg(F.transform(F.array_sort(F.collect_list(F.struct("g", "mean"))), lambda x: x["mean"]).alias("centres"))
    nearest = F.array_min(F.transform("centres", lambda c, i: F.struct(F.abs(c - F.col("mass_kg")).alias("d"), i.alias("i"))))["i"]
    light = (nearest == 0) & (F.get("centres", F.lit(0)) < TRACTOR_ONLY_KG)
    label = F.when((F.col("mass_kg") > 0) & ~light, nearest)
    return rows.join(centres, LEG, "left").withColumn("mass_class", label).drop("centres")


def dominant_class(samples: DataFrame, keys: list[str], over_kmh: float = 1.0) -> DataFrame:
    """The most frequent class of a segment's moving readings, or else of all; the smallest on ties."""
    moving = F.when(F.col("speed_kmh") > over_kmh, F.col("mass_class"))
    return samples.groupBy(*keys).agg(F.coalesce(F.mode(moving, True), F.mode("mass_class", True)).alias("mass_class"))


def standing_near(rows: DataFrame, window_min: float) -> DataFrame:
    """``rows`` of whole legs with ``stands_near``: whether a standing sample lies within half the window on either side."""
    half = int(window_min * 30_000_000)
    near = Window.partitionBy(*LEG).orderBy("__us").rangeBetween(-half, half)
    standing = F.max((F.coalesce("speed_kmh", F.lit(0.0)) == 0).cast("int")).over(near) == 1
    return rows.withColumn("__us", F.unix_micros("ts")).withColumn("stands_near", standing).drop("__us")


def class_changes(samples: DataFrame, keys: list[str], window_min: float | None = 10.0, over_kmh: float = 1.0) -> DataFrame:
    """``keys, split_ts, from_class, to_class`` where the class of a segment's moving samples changes next to a standing one.

    ``samples`` are those of the segments; with ``stands_near`` (see ``standing_near``) the standing
    sample may lie outside the segment. ``window_min`` None asks for none.
    """
    marked = samples if "stands_near" in samples.columns else samples.withColumn("stands_near", F.lit(True)) if window_min is None else standing_near(samples, window_min)
    moving = marked.where((F.col("speed_kmh") > over_kmh) & F.col("mass_class").isNotNull())
    before = F.lag("mass_class").over(Window.partitionBy(*keys).orderBy("ts", "row_no"))
    return moving.withColumn("from_class", before).where((F.col("from_class") != F.col("mass_class")) & F.col("stands_near")).select(*keys, F.col("ts").alias("split_ts"), "from_class", F.col("mass_class").alias("to_class"))
