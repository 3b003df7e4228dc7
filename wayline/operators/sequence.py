"""Operators whose state runs through a leg's samples: chains of successors, pedal events, quanta."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from ..sources.telematics import LEG
from .islands import in_time, us
from .joins import as_of


def downsample(rows: DataFrame, least_seconds: float) -> DataFrame:
    """``vehicle_id, leg_id, row_no, ts`` of the samples kept: the first of a leg, and then each first one that comes
    ``least_seconds`` or more after the one kept before.

    Every sample has a successor, the first one late enough; what is kept is the chain from the
    leg's first sample. Only samples that are somebody's successor can be on it. The chain is
    walked by doubling: who is known to be kept reaches 1, 2, 4 … successors further at
    each step, by joins on leg and row, so a long leg is spread like any other.
    """
    if not least_seconds > 0:
        raise ValueError("the interval must be positive")
    least = int(least_seconds * 1_000_000)
    slim = rows.where(F.col("ts").isNotNull()).select(*LEG, F.col("row_no").cast("long").alias("row_no"), "ts")
    asked = slim.select(*LEG, "row_no", F.timestamp_micros(us("ts") + least).alias("at"))
    here = F.struct("row_no", "ts")
    successor = as_of(asked, slim.withColumn("next", here), "next", ["row_no"], "forward").select(*LEG, "row_no", F.col("next.row_no").alias("next"))
    first = slim.groupBy(*LEG).agg(F.min(F.struct("ts", "row_no")).alias("f"), F.max("ts").alias("last"))
    first = first.select(*LEG, F.col("f.row_no").alias("row_no"), (us("last") - us("f.ts")).alias("span"))
    steps = math.ceil(math.log2((first.agg(F.max("span")).first()[0] or 0) // least + 2))
    kept = first.select(*LEG, "row_no")
    links = successor.where("next is not null")
    reached = links.select(*LEG, F.col("next").alias("row_no")).unionByName(kept).distinct()
    links = written(links.join(reached, [*LEG, "row_no"], "left_semi"))
    for step in range(steps):
        ahead = kept.join(links, [*LEG, "row_no"]).select(*LEG, F.col("next").alias("row_no"))
        kept = written(kept.unionByName(ahead))
        if step + 1 < steps:
            far = links.select(*LEG, F.col("row_no").alias("next"), F.col("next").alias("far"))
            links = written(links.join(far, [*LEG, "next"]).select(*LEG, "row_no", F.col("far").alias("next")))
    return slim.join(kept, [*LEG, "row_no"], "left_semi").select(*LEG, "row_no", "ts")


def rolling_median(rows: DataFrame, value: str, width: int, keys: list[str] = LEG) -> DataFrame:
    """``rows`` with ``value`` replaced by the median of ``width`` known readings around it, an odd number, in time order.
    Where there aren't as many on both sides the nearest full one counts; null if a key has fewer readings. Rows
    without a value go."""
    if width < 1 or width % 2 == 0:
        raise ValueError("the width of a centred median must be odd")
    known = rows.where(F.col(value).isNotNull())
    in_order = Window.partitionBy(*keys).orderBy("ts", "row_no")
    near = F.array_sort(F.collect_list(value).over(in_order.rowsBetween(-(width // 2), width // 2)))
    full = known.withColumns({"__near": near, "__place": F.row_number().over(in_order)})
    full = full.withColumn("__median", F.when(F.size("__near") == width, F.get("__near", F.lit(width // 2))))
    every, there = Window.partitionBy(*keys), F.when(F.col("__median").isNotNull(), F.col("__place"))
    edges = full.withColumns({"__first": F.min_by("__median", there).over(every), "__last": F.max_by("__median", there).over(every)})
    edge = F.when(F.col("__place") <= width // 2, F.col("__first")).otherwise(F.col("__last"))
    return edges.withColumn(value, F.coalesce("__median", edge)).select(*rows.columns)


class PedalPeaks:
    """Finds peaks reading by reading: up by ``rise`` from the lowest value since the last event, then down by ``fall``."""

    def __init__(self, rise: float = 10.0, fall: float = 8.0, least_width: int = 1, least_apart: int = 1):
        self.rise, self.fall, self.least_width, self.least_apart = rise, fall, least_width, least_apart
        self.at = -1
        self.low = self.low_at = self.peak = self.peak_at = self.ended = None

    def feed(self, value: float, label=None):
        """The label of the reading that was a peak, once this one ends its event; else None."""
        self.at += 1
        if self.peak is None:
            if self.low is None or value < self.low:
                self.low, self.low_at = value, self.at
            if value - self.low >= self.rise:
                self.peak, self.peak_at, self.label = value, self.at, label
            return None
        if value > self.peak:
            self.peak, self.peak_at, self.label = value, self.at, label
        if self.peak - value < self.fall:
            return None
        found = None
        if self.peak_at - self.low_at + 1 >= self.least_width and (self.ended is None or self.at - self.ended >= self.least_apart):
            found, self.ended = (self.label, self.peak), self.at
        self.low, self.low_at, self.peak = value, self.at, None
        return found


def pedal_peaks(values: list[float], **limits) -> list[int]:
    """Places of the peaks of a series."""
    machine = PedalPeaks(**limits)
    return [hit[0] for hit in (machine.feed(v, i) for i, v in enumerate(values)) if hit]


def pedal_events(rows: DataFrame, value: str, keys: list[str] = LEG, smooth: int = 0, **limits) -> DataFrame:
    """``keys, ts, value`` of each pedal peak of readings in time order, after a rolling median if ``smooth`` is an odd width.

    A task reads its keys' sorted rows batch by batch and carries on a machine of a few numbers, so a
    key of any length needs no more memory than a batch; its rows are one task's, as each depends on the one before.
    """
    slim = rows.where(F.col(value).isNotNull()).select(*keys, "ts", F.col("row_no").cast("long").alias("row_no"), F.col(value).cast("double").alias("value"))
    if smooth >= 3:
        slim = rolling_median(slim, "value", smooth, keys).where("value is not null")
    sorted_rows = slim.repartition(*keys).sortWithinPartitions(*keys, "ts", "row_no")
    out = sorted_rows.select(*keys, "ts", "value").schema

    def run(batches):
        key, machine = None, None
        for batch in batches:
            columns = batch.columns
            named = list(zip(*(c.to_pylist() for c in columns[: len(keys)])))
            found = []
            for i, (own, v) in enumerate(zip(named, columns[-1].to_pylist())):
                if own != key:
                    key, machine = own, PedalPeaks(**limits)
                hit = machine.feed(v, columns[len(keys)][i])
                if hit:
                    found.append((i, *hit))
            if found:
                at = pa.array([f[0] for f in found])
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in columns[: len(keys)]), pa.array([f[1].as_py() for f in found], columns[len(keys)].type), pa.array([f[2] for f in found])], names=out.names)

    return sorted_rows.mapInArrow(run, out)


def peak_histogram(peaks: DataFrame, keys: list[str], bins: int = 10, width: float = 10.0) -> DataFrame:
    """``keys, histogram``: counts of the peaks' values in ten bins, the last one open, as text."""
    bin_ = F.greatest(F.least(F.floor(F.col("value") / width), F.lit(bins - 1)), F.lit(0)).cast("int")
    counted = peaks.groupBy(*keys).agg(*(F.count(F.when(bin_ == i, 1)).alias(f"b{i}") for i in range(bins)))
    return counted.select(*keys, F.array_join(F.array(*(F.col(f"b{i}").cast("string") for i in range(bins))), ",").alias("histogram"))


def pedal_histograms(samples: DataFrame, value: str, keys: list[str], least_samples: int = 10, **limits) -> DataFrame:
    """``keys, histogram`` of the pedal peaks of ``samples``; keys with fewer than ``least_samples`` readings, or without a peak, have none."""
    enough = samples.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least_samples)
    return peak_histogram(pedal_events(samples, value, keys, **limits), keys).join(enough.select(*keys), keys, "left_semi")


def soc_quantum(rows: DataFrame, least_steps: int = 20, most_pct: float = 5.0) -> DataFrame:
    """``vehicle_id, leg_id, soc_quantum``: the largest step of which all changes of the charge are multiples
    (thousandths of a per cent); null with few changes or a step over ``most_pct``.

    Partitions fold their distinct changes; a leg has few distinct ones.
    """
    known = rows.where(F.col("soc").isNotNull())
    step = F.rint(F.abs(F.col("soc") - F.lag("soc").over(in_time())) * 1000).cast("long")
    steps = known.select(*LEG, step.alias("step")).where("step > 0").groupBy(*LEG, "step").agg(F.count("*").alias("n"))
    euclid = lambda a, b: F.aggregate(F.sequence(F.lit(1), F.lit(48)), F.struct(a.alias("x"), b.alias("y")), lambda s, _: F.when(s["y"] == 0, s).otherwise(F.struct(s["y"].alias("x"), F.pmod(s["x"], F.greatest(s["y"], F.lit(1).cast("long"))).alias("y"))), lambda s: s["x"])
    found = steps.groupBy(*LEG).agg(F.sum("n").alias("n"), F.aggregate(F.collect_list("step"), F.lit(0).cast("long"), lambda a, b: euclid(b, a)).alias("gcd"))
    return found.select(*LEG, F.when((F.col("n") >= least_steps) & (F.col("gcd") <= most_pct * 1000), F.col("gcd") / 1000).alias("soc_quantum"))
