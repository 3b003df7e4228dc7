"""Hand-computed cases of the telematics operators, and folds against other forms of the same rule."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayline.functions import scalars
from wayline.operators import capacity, clean, enrich, islands, joins, mass, measure, sequence
from wayline.operators.grade import grade
from wayline.sources import telematics as src

T0 = datetime(2024, 3, 1, 8)
SAMPLE = "vehicle_id string, leg_id int, row_no long, ts timestamp, speed_kmh double, soc double, odometer_km double, mass_kg double, trigger_type string"


def minute(m):
    return T0 + timedelta(minutes=m)


def samples(spark, rows):
    """rows: (minute, speed, soc, odometer, mass, trigger)."""
    full = [("v", 0, i, minute(r[0]), *[*r[1:], *[None] * 5][:5]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SAMPLE)


def minutes(df, *columns):
    base = int(T0.timestamp() * 1e6)
    return [tuple(None if x is None else (x - base) / 6e7 for x in r) for r in df.select(*(F.unix_micros(c) for c in columns)).orderBy(*range(1, len(columns) + 1)).collect()]


@pytest.fixture(autouse=True)
def utc(monkeypatch):
    monkeypatch.setenv("TZ", "UTC")
    import time

    time.tzset()


def test_trips_bridge_stops_of_at_most_five_minutes(spark):
    moving = [(m, 30.0) for m in (0, 1, 2, 7, 8, 9, 16, 17, 18)]
    standing = [(m, 0.0) for m in (-1, 4, 12, 20)]
    rows = samples(spark, sorted(moving + standing))
    # 2 to 7 is bridged (exactly five), 9 to 16 isn't.
    assert minutes(islands.speed_trips(rows, anchor="first_motion"), "start_ts", "end_ts") == [(0, 9), (16, 18)]
    assert minutes(islands.speed_trips(rows), "start_ts", "end_ts") == [(-1, 12), (12, 20)]
    assert islands.speed_trips(rows, min_trip_min=3).count() == 1
    assert islands.speed_trips(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        islands.speed_trips(rows, anchor="other")


def test_charge_and_discharge_blocks(spark):
    rows = samples(spark, [(m, None, s) for m, s in ((0, 40.0), (10, 50.0), (20, 50.0), (50, 60.0), (60, 58.0), (70, 70.0), (80, None), (90, 55.0), (100, 40.0))])
    charges = islands.charge_blocks(rows).orderBy("start_ts").collect()
    assert [(r.start_soc, r.end_soc) for r in charges] == [(40.0, 60.0), (58.0, 70.0)]
    assert [(r.start_soc, r.end_soc) for r in islands.discharge_blocks(rows).collect()] == [(70.0, 40.0)]


def test_stops_fill_gaps_over_a_minute(spark):
    trips = spark.createDataFrame([("v", minute(0), minute(10)), ("v", minute(11), minute(20)), ("v", minute(22), minute(30))], "vehicle_id string, start_ts timestamp, end_ts timestamp")
    assert minutes(islands.stop_rows(trips), "stop_start", "stop_end") == [(20, 22)]


def test_as_of_takes_the_last_row_before_and_the_first_after(spark):
    rows = samples(spark, [(0, None, 1.0), (5, None, 2.0), (5, None, 3.0), (9, None, None), (20, None, 4.0)])
    at = spark.createDataFrame([("v", 0, minute(m), m) for m in (-1, 5, 10, 30)], "vehicle_id string, leg_id int, at timestamp, m int")
    back = {r.m: r.soc for r in joins.as_of(at, rows, "soc", ["m"]).collect()}
    forth = {r.m: r.soc for r in joins.as_of(at, rows, "soc", ["m"], "forward").collect()}
    assert back == {-1: None, 5: 3.0, 10: 3.0, 30: 4.0} and forth == {-1: 1.0, 5: 2.0, 10: 4.0, 30: None}
    near = {r.m: r.soc for r in joins.as_of_nearest(at, rows, "soc", ["m"], 5).collect()}
    assert near == {-1: 1.0, 5: 3.0, 10: 3.0, 30: None}


def test_intervals(spark):
    trips = spark.createDataFrame([("v", 0, 1, minute(0), minute(60)), ("v", 0, 2, minute(100), minute(120))], "vehicle_id string, leg_id int, seg int, start_ts timestamp, end_ts timestamp")
    charges = spark.createDataFrame([("v", 0, minute(10), minute(20)), ("v", 0, minute(15), minute(30)), ("v", 0, minute(55), minute(70))], "vehicle_id string, leg_id int, c_start timestamp, c_end timestamp")
    assert minutes(joins.subtract_intervals(trips, charges, ["seg"]), "part_start", "part_end") == [(0, 10), (30, 55), (100, 120)]
    other = charges.withColumnsRenamed({"c_start": "o_start", "c_end": "o_end"})
    gaps = {r.seg: r.charge_between for r in joins.charge_between(trips, other).collect()}
    assert gaps == {1: False, 2: True}
    cut = joins.reconcile_charges(trips.withColumnRenamed("seg", "c"), other.where(F.col("o_start") == F.lit(minute(55))), ["c"])
    assert minutes(cut, "start_ts", "end_ts") == [(0, 55), (100, 120)]
    meter = spark.createDataFrame([("v", 0, "a", minute(62), minute(63), 1.5), ("v", 0, "b", minute(50), minute(52), None)], "vehicle_id string, leg_id int, uri string, o_start timestamp, o_end timestamp, energy_kwh double")
    got = {r.seg: (r.uri, r.energy_kwh) for r in joins.all_overlaps(trips, meter, src.LEG, ["seg"], 4).collect()}
    assert got == {1: ("b", 1.5), 2: (None, None)}


def plain_replayed(seconds, km, vmax=130.0, tol=0.05):
    """The rule read run by run, without indices into runs."""
    runs = []
    for i, x in enumerate(km):
        if runs and runs[-1][0] == x:
            runs[-1][1].append(i)
        else:
            runs.append((x, [i]))
    gone, kept = [], runs[0][1][-1]
    for k in range(1, len(runs) - 1):
        value, places = runs[k]
        after = runs[k + 1][1][0]
        follows = -tol <= km[after] - km[kept] <= vmax * (seconds[after] - seconds[kept]) / 3600 + tol
        behind = value < km[kept] - tol
        ahead = value - km[kept] > vmax * (seconds[places[0]] - seconds[kept]) / 3600 + tol and km[after] < value - tol
        if follows and (behind or ahead):
            gone += places
        else:
            kept = places[-1]
    return gone


def test_odometer_replays(spark):
    rng = random.Random(1)
    for _ in range(500):
        n = rng.randint(1, 12)
        seconds = sorted(rng.randrange(0, 36000) for _ in range(n))
        km = [float(rng.choice((100, 100, 101, 105, 90, 300))) for _ in range(n)]
        assert clean.replayed(seconds, km) == plain_replayed(seconds, km)
    rows = samples(spark, [(m, None, None, km) for m, km in ((0, 100.0), (10, 110.0), (20, 50.0), (30, 50.0), (40, 130.0), (50, 0.0), (60, 140.0))])
    got = [r.odometer_km for r in clean.clean_odometer(rows).orderBy("row_no").collect()]
    assert got == [100.0, 110.0, None, None, 130.0, None, 140.0]


def test_soc_spikes(spark):
    rows = samples(spark, [(0, None, 50.0, None, None, "TIMER"), (5, None, 60.0, None, None, "EVENT"), (10, None, 50.0, None, None, "timer"), (20, None, 51.0, None, None, None)])
    assert [r.soc for r in clean.blank_soc_spikes(rows, 3).orderBy("row_no").collect()] == [50.0, None, 50.0, 51.0]
    with pytest.raises(ValueError):
        clean.blank_soc_spikes(rows, 0)


def test_mass_estimators(spark):
    rows = samples(spark, [(m, 50.0, None, None, x) for m, x in enumerate((10.0, 10.0, 11.0, 12.0, 100.0))])
    value = lambda method: mass.mass_estimate(rows, ["vehicle_id"], method).first()
    assert value("mean").mass_kg == pytest.approx(28.6) and value("median").mass_kg == 11.0
    assert (value("iqr_mean").mass_kg, value("mad_median").n_kept) == (10.75, 4)
    assert value("trimmed_mean").mass_kg == 11.0 and value("unknown").mass_kg == pytest.approx(28.6)
    assert value("mad_tw_mean").mass_kg == pytest.approx((10 * 0.5 + 10 + 11 + 12 * 0.5) / 3)
    assert mass.mass_estimate(rows.limit(1), ["vehicle_id"]).count() == 0


def test_mass_classes(spark):
    rows = samples(spark, [(m, 50.0, None, None, x) for m, x in enumerate((9000.0, 9100.0, 20000.0, 21000.0, 40000.0, None))])
    assert [r.mass_class for r in mass.mass_classes(rows).orderBy("row_no").collect()] == [None, None, 1, 1, 2, None]


def test_folds():
    assert sequence.pedal_peaks([0, 5, 12, 30, 25, 20, 22, 40, 10]) == [3, 7]
    assert sequence.pedal_peaks([50, 40, 49, 41]) == [] and sequence.pedal_peaks([]) == []


def test_soc_quantum(spark):
    rows = samples(spark, [(m, None, 50.0 + (0.4 if m % 2 else 0.0) * (m % 3 + 1)) for m in range(60)])
    assert sequence.soc_quantum(rows).first().soc_quantum == pytest.approx(0.4)


def test_capacity_is_local_in_time(spark):
    day = lambda n: T0 + timedelta(days=n)
    rows = spark.createDataFrame([
        ("v", "p", 1, day(0), 20.0, 300.0, "ac_dc", None), ("v", "p", 2, day(40), 10.0, 400.0, "ac_dc", None), ("v", "p", 3, day(41), 30.0, 440.0, "ac_dc", None),
        ("v", "p", 4, day(38), -10.0, 1.0, "soc_estimate", None), ("v", "p", 5, day(20), -10.0, 1.0, "soc_estimate", None), ("w", "p", 6, day(1), -10.0, 1.0, "soc_estimate", None)],
        "vehicle_id string, leg_id string, row_no long, ts timestamp, delta_soc double, capacity_kwh double, energy_source string, delta_kwh double")
    got = {r.row_no: (r.capacity_kwh, r.delta_kwh) for r in capacity.correct_estimates(rows, fallback_kwh=250.0).collect()}
    assert got[4] == pytest.approx((430.0, -43.0))  # the two within 15 days
    assert got[5][0] == pytest.approx((300 * 20 + 400 * 10 + 440 * 30) / 60)  # 30 days reach all three
    assert got[6] == pytest.approx((250.0, -25.0)) and got[1] == (300.0, None)
    ledger = spark.createDataFrame([("v", "a", 300.0, 10), ("v", "b", 400.0, 30), ("v", "c", 900.0, 2)], "vehicle_id string, period string, kwh double, n long")
    assert capacity.ledger_average(ledger).first().kwh == pytest.approx(375.0)
    new = capacity.upsert_ledger(ledger, ledger.where("period = 'a'").withColumn("kwh", F.lit(1.0)))
    assert {r.period: r.kwh for r in new.collect()} == {"a": 1.0, "b": 400.0, "c": 900.0}
    assert capacity.ledger_map(new).first().periods["b"].n == 30


def test_energy_expressions(spark):
    row = spark.range(1).select(
        measure.elevation_kwh(F.lit(36000.0), F.lit(100.0)).alias("up"), measure.elevation_kwh(F.lit(36000.0), F.lit(-100.0)).alias("down"),
        measure.energy_performance(F.lit(-50.0), F.lit(40.0)).alias("ep"), measure.energy_performance(F.lit(-50.0), F.lit(0.0)).alias("none"),
        scalars.cardinal(F.lit(22.5)).alias("c"), scalars.cardinal(F.lit(350.0)).alias("n"), scalars.point_text(F.lit(1.5), F.lit(-2.0)).alias("p"),
        scalars.is_trip_label(F.lit("In Transit")).alias("t"), scalars.is_charge_label(F.lit("ac Home")).alias("a"), scalars.needs_value(F.lit(" =na() ")).alias("e"),
        scalars.distance_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d")).first()
    assert row.up == pytest.approx(9.81 / 0.9) and row.down == pytest.approx(-9.81 * 0.9)
    assert (row.ep, row.none, row.c, row.n, row.p) == (1.25, None, "N", "N", "Point(1.500000 -2.000000)")
    assert row.t and row.a and row.e and row.d == pytest.approx(111.19, abs=0.01)


def test_grades(spark):
    base = {"energy_source": "total_energy", "delta_kwh": -100.0, "delta_soc": -30.0, "distance_km": 80.0, "counter_kwh": 100.0, "outside_km": 0.0, "outside_min": 0.0, "dist_outside_km": 0.0, "odo_samples": 5, "samples": 9, "soc_quantum": 0.4, "step_pct": 0.4, "step_rate": 10.0, "referee_kwh": 333.0, "ep": 1.25}
    cases = {"good": {}, "caution": {"outside_km": 10.0}, "poor": {"distance_km": 0.9}, "edge": {"outside_km": 8.0}, "none": {"energy_source": "distance_only"}}
    rows = [(k, T0, T0 + timedelta(hours=2), *(base | c).values()) for k, c in cases.items()]
    frame = spark.createDataFrame(rows, ["k", "start_ts", "end_ts", *base])
    got = {r.k: (r.grade, r.reason) for r in grade(frame).collect()}
    assert got["good"] == ("good", "") and got["edge"] == ("good", "") and got["none"] == (None, "NO_ENERGY")
    assert got["caution"][0] == "caution" and got["caution"][1].startswith("ENERGY_WINDOW 0.1")
    assert got["poor"] == ("poor", "SHORT_DIST 0.90")


def test_weather(spark):
    rows = spark.createDataFrame([("t", 1, minute(0), 10.0, 359.0, "Rain"), ("t", 2, minute(1), 20.0, 1.0, "Clear")], "trip string, row_no long, ts timestamp, x double, wind_deg double, kind string")
    found = enrich.fine_weather(rows.withColumns({c: F.col("x") for c in ("temperature", "pressure", "humidity", "wind_speed")}), ["trip"]).first()
    assert found.temperature == 15.0 and min(found.wind_deg, 360 - found.wind_deg) < 1e-9 and found.weather_kind == "Rain"


def test_canonical_columns(spark):
    raw = spark.createDataFrame([("v", 0, 1, "2024-03-01 08:00:00", "0", "12.5", "x"), ("v", 0, 2, "never", "50", "1", "2")], "vehicle_id string, leg_id int, row_no long, eventDatetime string, electricBatteryLevelPercent string, speed string, odometer string")
    row = src.canonical(raw).collect()
    assert len(row) == 1 and row[0].soc is None and row[0].speed_kmh == 12.5 and row[0].odometer_km is None and row[0].has_speed and not row[0].has_mass


def test_streaming_trips_agree_with_batch_ends(spark, tmp_path):
    from wayline.streaming.trips import streaming_trips

    rows = samples(spark, [(m, 30.0) for m in (0, 1, 2, 3, 20, 21, 22, 23, 24)] + [(60, 30.0), (90, 0.0)]).select("vehicle_id", "leg_id", "ts", "speed_kmh")
    rows.write.parquet(f"{tmp_path}/in")
    found = streaming_trips(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    run = found.writeStream.format("memory").queryName("trips_seen").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    run.awaitTermination(120)
    assert minutes(spark.table("trips_seen"), "start_ts", "end_ts") == [(0, 3), (20, 24)]
