"""Report tables filled in place."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayline.operators import patch

T0 = datetime(2024, 3, 4, 6)
REPORT = "vehicle_id string, leg_number long, leg_type string, start_ts timestamp, end_ts timestamp, origin string, destination string, charger_link string, charger_kwh double, logger_link string, temperature double, pressure double, humidity double, wind_speed double, wind_direction string, weather_kind string, mass_kg double, mass_cv double, ep_kinetic double, delta_kwh double, distance_km double, height_m double, accelerator_histogram string, decelerator_histogram string, month string"


def at(minute):
    return T0 + timedelta(minutes=minute)


def row(vehicle, n, kind, start, end, month="m1", **cells):
    base = dict(vehicle_id=vehicle, leg_number=n, leg_type=kind, start_ts=at(start), end_ts=at(end), origin="Point(50.000000 1.000000)", destination="Point(51.000000 1.000000)", month=month)
    names = [c.split()[0] for c in REPORT.split(", ")]
    return tuple((base | cells).get(c) for c in names)


@pytest.fixture
def table(spark, tmp_path):
    rows = [row("v", 1, "In Transit", 0, 60, delta_kwh=-50.0, distance_km=40.0), row("v", 2, "AC Home", 60, 120), row("v", 3, "Stop", 120, 180), row("v", 4, "In Transit", 180, 240, "m2", temperature=9.0, mass_kg=7.0, distance_km=5.0, delta_kwh=-5.0), row("w", 1, "DC Away", 60, 120, "m3", charger_link="old", charger_kwh=3.0)]
    path = str(tmp_path / "report")
    spark.createDataFrame(rows, REPORT).write.partitionBy("month").parquet(path)
    return path


def files(path):
    return {(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def read(spark, path, *columns):
    return {(r.vehicle_id, r.leg_number): tuple(r[c] for c in columns) for r in spark.read.parquet(path).collect()}


def test_chargers_fill_empty_cells_of_their_partition_once(spark, table):
    sessions = spark.createDataFrame([("v", "https://x.example/2", at(70), at(80), 5.0), ("v", "https://x.example/1", at(40), at(57), 7.5), ("v", "https://x.example/0", at(0), at(55), 100.0), ("w", "https://x.example/9", at(70), at(80), 1.0)], "vehicle_id string, uri string, o_start timestamp, o_end timestamp, energy_kwh double")
    before = files(table)
    fill = lambda: patch.patch_table(spark, table, lambda r: patch.charger_cells(r, sessions), ["month"])
    assert fill() == 1
    link, kwh = read(spark, table, "charger_link", "charger_kwh")["v", 2]
    assert link.startswith("https://x.example/explore/graphics/usage?start=2024-03-04+07%3A00%3A00") and link.endswith("https%3A%2F%2Fx.example%2F1") and kwh == 12.5
    assert read(spark, table, "charger_link", "charger_kwh")["w", 1] == ("old", 3.0) and len(read(spark, table)) == 5
    after = files(table)
    assert {k for k in before if "month=m1" not in k[0]} <= set(after) and all(before[k] == after[k] for k in before if "month=m1" not in k[0])
    assert fill() == 0 and files(table) == after


def test_loggers_fill_weather_mass_and_kinetics(spark, table):
    samples = spark.createDataFrame([("v", at(m), m, 10.0 + m % 2, 90.0, float(18_000 + m), 50.0, [0.0, 40.0][m % 2]) for m in range(0, 240)], "vehicle_id string, ts timestamp, row_no long, temperature double, wind_deg double, mass_kg double, speed_kmh double, accelerator double")
    windows = spark.createDataFrame([("v", "https://x.example/l2", at(0), at(70), 2), ("v", "https://x.example/l1", at(62), at(90), 1)], "vehicle_id string, uri string, o_start timestamp, o_end timestamp, list_order int")
    fill = lambda: patch.patch_table(spark, table, lambda r: patch.logger_cells(r, windows, samples), ["month"])
    assert fill() == 3
    got = read(spark, table, "temperature", "pressure", "wind_direction", "mass_kg", "ep_kinetic", "accelerator_histogram")
    assert got["v", 1] == (pytest.approx(10.4918, abs=1e-3), None, "E", 18_030.0, 50 / 40, "0,0,0,0,30,0,0,0,0,0")
    assert got["v", 2] == (None,) * 6 and got["v", 4][3] == 7.0 and got["v", 4][5] is None
    # One weather cell was unknown, so all that the logger has are its own.
    assert got["v", 4][0] == pytest.approx(10.5, abs=0.02) and got["v", 3][2] == "E"
    assert read(spark, table, "logger_link")["v", 1][0].endswith("l1") and fill() == 0


def test_coarse_weather_needs_both_ends(spark, table):
    from wayline.functions.scalars import weather_key

    places = spark.createDataFrame([(50.0, 1.0, at(0), 10.0, 350.0, "Rain"), (51.0, 1.0, at(60), 20.0, 10.0, "Clear"), (50.0, 1.0, at(180), 30.0, 0.0, "Fog")], "lat double, lon double, ts timestamp, x double, wind_deg double, kind string")
    cache = places.select(weather_key("lat", "lon", "ts").alias("key"), *(F.col("x").alias(c) for c in patch.MEANS), "wind_deg", "kind")
    assert patch.patch_weather(spark, table, ["month"], "coarse", cache=cache) == 1
    got = read(spark, table, "temperature", "wind_direction", "weather_kind")
    # The plain mean of 350 and 10 degrees is south.
    assert got["v", 1] == (15.0, "S", "Rain") and got["v", 4] == (9.0, None, None) and got["v", 3] == (None, None, None)
    with pytest.raises(ValueError):
        patch.patch_weather(spark, table, ["month"], "other")
