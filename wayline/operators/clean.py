"""Cleaning passes before segmentation: replayed odometers and state-of-charge spikes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.telematics import LEG
from .islands import backwards, in_time, us

MAX_KMH, TOLERANCE_KM = 130.0, 0.05


class Replays:
    """Finds replayed readings one by one: runs that fall behind the kept run, or jump ahead of what the
    speed allows and come back, when the next run follows on from the kept one."""

    def __init__(self, vmax: float = MAX_KMH, tolerance: float = TOLERANCE_KM):
        self.vmax, self.tolerance = vmax, tolerance
        self.kept = self.first = self.last = None  # each a time and a reading: the kept run's last, the open run's first and last
        self.labels = []

    def feed(self, second: float, km: float, label) -> list:
        """The labels of the run that this reading ends, if it was replayed; else none."""
        if self.last is not None and km == self.last[1]:
            self.last = second, km
            self.labels.append(label)
            return []
        gone = self._ended(second, km)
        self.first = self.last = second, km
        self.labels = [label]
        return gone

    def _ended(self, second: float, km: float) -> list:
        if self.kept is not None:
            reach = lambda at: self.vmax * (at - self.kept[0]) / 3600 + self.tolerance
            step = self.first[1] - self.kept[1]
            back = -self.tolerance <= km - self.kept[1] <= reach(second)
            ahead = step > reach(self.first[0]) and km < self.last[1] - self.tolerance
            if back and (step < -self.tolerance or ahead):
                return self.labels
        self.kept = self.last
        return []


def replayed(seconds: list[float], km: list[float], vmax: float = MAX_KMH, tolerance: float = TOLERANCE_KM) -> list[int]:
    """Places of replayed readings."""
    machine = Replays(vmax, tolerance)
    return [place for i, reading in enumerate(zip(seconds, km)) for place in machine.feed(*reading, i)]


def clean_odometer(rows: DataFrame) -> DataFrame:
    """``rows`` with odometer readings blanked that are not positive or replayed.

    Legs whose every step is possible pass by window functions alone. Of the others a task reads the
    sorted rows batch by batch and holds no more than the run that is open.
    """
    valid = F.when(F.col("odometer_km") > 0, F.col("odometer_km").cast("double"))
    rows = rows.withColumn("odometer_km", valid)
    w = in_time()
    read = rows.where(F.col("odometer_km").isNotNull() & F.col("ts").isNotNull()).select(*LEG, "row_no", "ts", "odometer_km")
    step = F.col("odometer_km") - F.lag("odometer_km").over(w)
    reach = (us("ts") - us(F.lag("ts").over(w))) / 3.6e9 * MAX_KMH + TOLERANCE_KM
    odd = read.withColumn("odd", (step < -TOLERANCE_KM) | (step > reach))
    every = Window.partitionBy(*LEG)
    suspects = odd.withColumns({"any": F.max("odd").over(every), "n": F.count("*").over(every)}).where("any and n >= 3")

    read_in_order = suspects.select(*LEG, "row_no", us("ts").alias("us"), F.col("odometer_km").alias("km")).repartition(*LEG).sortWithinPartitions(*LEG, "us", "row_no")
    out = rows.select(*LEG, "row_no").schema

    def run(batches):
        key, machine = None, None
        for batch in batches:
            *keys, row_nos, micros, km = (c.to_pylist() for c in batch.columns)
            found = []
            for own, row_no, at, value in zip(zip(*keys), row_nos, micros, km):
                if own != key:
                    key, machine = own, Replays()
                found += ((*own, n) for n in machine.feed(at / 1e6, value, row_no))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(i).type) for i, c in enumerate(zip(*found))], names=out.names)

    gone = read_in_order.mapInArrow(run, out)
    marked = rows.join(gone.withColumn("gone", F.lit(True)), [*LEG, "row_no"], "left")
    return marked.withColumn("odometer_km", F.when(F.col("gone").isNull(), F.col("odometer_km"))).drop("gone").select(*rows.columns)


def blank_soc_spikes(rows: DataFrame, pct: float, within_min: float = 2.0) -> DataFrame:
    """``rows`` with event readings of the state of charge blanked that stand out from the periodic
    readings on both sides and aren't part of a real change."""
    if not pct > 0:
        raise ValueError("the spike limit must be positive")
    if "trigger_type" not in rows.columns:
        return rows
    soc = F.nullif(F.col("soc"), F.lit(0.0))
    periodic = F.coalesce(F.upper(F.trim("trigger_type")) == "TIMER", F.lit(False))
    kept = F.when(periodic, soc)
    w = in_time()
    span = int(within_min * 60_000_000)
    near = Window.partitionBy(*LEG).orderBy("__us").rangeBetween(-span, span)
    marked = rows.withColumn("__us", us("ts")).withColumns({
        "__before": F.last(kept, True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "__after": F.last(kept, True).over(backwards().rowsBetween(Window.unboundedPreceding, 0)),
        "__low": F.min(soc).over(near),
    })
    over_before, over_after = soc - F.col("__before"), soc - F.col("__after")
    stands_out = ~periodic & (over_before >= pct) & (over_after >= pct)
    genuine = (F.abs(F.col("__before") - F.col("__after")) >= F.least(over_before, over_after)) & ~(soc - F.col("__low") >= pct)
    blank = F.coalesce(stands_out & ~genuine, F.lit(False))
    return marked.withColumn("soc", F.when(~blank, soc)).drop("__us", "__before", "__after", "__low")
