"""Online trips: an extension beyond the batch engine, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.telematics import LEG


def streaming_trips(rows: DataFrame, threshold: float = 1.0, min_stop_min: int = 5, min_trip_min: float = 2.0, late: str = "10 minutes") -> DataFrame:
    """Trips as sessions of moving samples, closed once the watermark is past the stop; samples later than
    ``late`` are dropped. Ends are first and last motion. Samples just a stop apart join, as in
    ``speed_trips``, but a sensor that is silent longer than the stop ends the trip here."""
    moving = rows.withWatermark("ts", late).where(F.coalesce("speed_kmh", F.lit(0.0)) > threshold)
    sessions = moving.groupBy(*LEG, F.session_window("ts", f"{min_stop_min} minutes")).agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"))
    return sessions.where(F.unix_micros("end_ts") - F.unix_micros("start_ts") >= int(min_trip_min * 60_000_000)).select(*LEG, "start_ts", "end_ts", "n")
