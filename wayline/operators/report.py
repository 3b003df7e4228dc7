"""The finished report: distance filter, scrub, order and numbers, chart points, tallies, and the written table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import is_charge_label, is_stop_label, is_trip_label
from .capacity import ledger_average, period_capacity, upsert_ledger

#: The energy columns that only trips may have, the row colours, and the missing-value formula.
TRIP_ONLY = ("ep", "ep_corrected", "ep_kinetic", "ep_without_aux")
COLOURS = {"charge": "red", "stop": "white", "trip": "green"}
MISSING = "=NA()"


@dataclass(frozen=True)
class Chart:
    """One scatter chart: its columns, the values that it takes (inclusive; None is open) and its axes."""

    x: str
    y: str
    x_takes: tuple[float | None, float | None] = (None, None)
    y_takes: tuple[float | None, float | None] = (None, None)
    x_axis: tuple[float, float, float] = (0, 1, 1)
    y_axis: tuple[float, float, float] = (0, 1, 1)
    driving_only: bool = True


def _charts(y: str, y_takes: tuple[float, float], y_axis: tuple[float, float, float]) -> tuple[Chart, ...]:
    """Lowest, highest and step of the three horizontal axes, and what they take."""
    return (
        Chart("mass_kg", y, (1.0, None), y_takes, (0, 45000, 5000), y_axis),
        Chart("temperature", y, (None, None), y_takes, (-5, 30, 5), y_axis),
        Chart("avg_speed_kmh", y, (0.0, 90.0), y_takes, (0, 90, 10), y_axis),
    )


EV_CHARTS = _charts("ep", (0.1, 3.0), (0, 3, 0.5))
DIESEL_CHARTS = _charts("l_per_100km", (0.0, 60.0), (0, 60, 10))


def charts_for(columns: list[str]) -> tuple[Chart, ...]:
    return DIESEL_CHARTS if "l_per_100km" in columns else EV_CHARTS


def _number(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def chart_points(rows: DataFrame, chart: Chart, keys: list[str]) -> DataFrame:
    """``keys, x, y``: both numbers known and taken by the chart, stops never, charges only if it isn't of driving alone."""
    points = rows.select(*keys, "leg_type", _number(chart.x).alias("x"), _number(chart.y).alias("y"))
    wanted = F.col("x").isNotNull() & F.col("y").isNotNull() & ~is_stop_label(F.col("leg_type"))
    if chart.driving_only:
        wanted &= ~is_charge_label(F.col("leg_type"))
    for c, (low, high) in (("x", chart.x_takes), ("y", chart.y_takes)):
        if low is not None:
            wanted &= F.col(c) >= low
        if high is not None:
            wanted &= F.col(c) <= high
    return points.where(wanted).drop("leg_type")


def far_enough(trips: DataFrame, min_km: float = 0.0) -> DataFrame:
    """Trips of ``min_km`` and more by the odometer; where an end of it is unknown they stay. Zero keeps all."""
    if min_km <= 0:
        return trips
    distance = F.col("odometer_end_km") - F.col("odometer_start_km")
    return trips.where(distance.isNull() | (distance >= min_km))


def scrub(rows: DataFrame, columns: tuple[str, ...] = TRIP_ONLY) -> DataFrame:
    """``rows`` without energy performance on charges and stops; rows without a label stay as they are."""
    other = is_charge_label(F.col("leg_type")) | is_stop_label(F.col("leg_type"))
    return rows.withColumns({c: F.when(~other, F.col(c)) for c in columns if c in rows.columns})


def row_class(label: Column) -> Column:
    return F.when(is_stop_label(label), "stop").when(is_charge_label(label), "charge").when(is_trip_label(label), "trip")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``leg_number`` from 1 by start (charges before trips that start with them), one report for each vehicle, and ``colour`` by kind of row."""
    kind = row_class(F.col("leg_type"))
    order = Window.partitionBy("vehicle_id").orderBy("start_ts", F.when(kind == "charge", 0).otherwise(1), "end_ts", "leg_type")
    colour = F.coalesce(*(F.when(kind == k, c) for k, c in COLOURS.items()))
    return rows.withColumns({"leg_number": F.row_number().over(order).cast("long"), "colour": colour})


def operator_tally(legs: DataFrame) -> DataFrame:
    """``vehicle_id, operator, n``: how many legs each operator has; null counts those that have none."""
    return legs.groupBy("vehicle_id", "operator").agg(F.count("*").alias("n"))


def backfilled(ledger: DataFrame, report: DataFrame) -> DataFrame:
    """The ledger with every period of the finished reports worked out again: ``vehicle_id, period, kwh, n``.

    Periods without a donor leave the ledger as it was; values go to one decimal.
    """
    found = period_capacity(report, ["vehicle_id", "period"]).where("source <> 'none'")
    return upsert_ledger(ledger, found.withColumn("kwh", F.round("kwh", 1)))


def backfill_summary(ledger: DataFrame, report: DataFrame) -> DataFrame:
    """``vehicle_id, old_kwh, new_kwh`` of a backfill, for a look before it is written."""
    old = ledger_average(ledger).withColumnRenamed("kwh", "old_kwh")
    new = ledger_average(backfilled(ledger, report)).withColumnRenamed("kwh", "new_kwh")
    return old.join(new, "vehicle_id", "full")


def cells(rows: DataFrame, blank: list[str] = ()) -> DataFrame:
    """All columns as text, as a sheet shows them: an unknown number is the missing-value formula, a null of
    another type or of a column in ``blank`` an empty cell."""
    shown = []
    for field in rows.schema:
        c, text = F.col(field.name), F.col(field.name).cast("string")
        if field.dataType.typeName() in ("double", "float"):
            unknown = F.coalesce(F.isnan(c), F.lit(False)) | c.isNull()
            text = F.when(~unknown, text).otherwise(F.lit("" if field.name in blank else MISSING))
        elif field.dataType.typeName() in ("integer", "long", "short", "decimal") and field.name not in blank:
            text = F.coalesce(text, F.lit(MISSING))
        shown.append(F.coalesce(text, F.lit("")).alias(field.name))
    return rows.select(*shown)


def write_report(rows: DataFrame, path: str, blank: list[str] = ()) -> None:
    """The numbered report under ``path``: ``table`` as Parquet by vehicle, ``sheet`` as CSV of its cells."""
    ready = numbered(scrub(rows))
    ready.write.mode("overwrite").partitionBy("vehicle_id").parquet(f"{path}/table")
    sheet = ready.repartitionByRange("vehicle_id", "leg_number").sortWithinPartitions("vehicle_id", "leg_number")
    cells(sheet, blank).write.mode("overwrite").csv(f"{path}/sheet", header=True)
