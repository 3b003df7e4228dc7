"""The electric report's rows worked out by hand, and the operators that only it used."""

from __future__ import annotations

from datetime import datetime, timedelta
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from wayline.functions.scalars import cardinal, resource_url
from wayline.operators import measure, segments
from wayline.operators.rows import REPORT, with_performance
from wayline.plans.ev import ev_report

T0 = datetime(2024, 3, 4, 6)
ROWS = "vehicle_id string, leg_id int, row_no long, ts timestamp, speed_kmh double, soc double, odometer_km double, mass_kg double, total_wh double, moving_wh double, ac_wh double, dc_wh double, recup_wh double, propulsion_wh double, lat double, lon double, altitude_m double, trigger_type string"


def at(minute):
    return T0 + timedelta(minutes=minute)


def leg(n, *rows):
    """rows: (minute, speed, soc, km, total kWh, ac kWh, dc kWh, lat)."""
    made = []
    for i, (m, speed, soc, km, total, ac, dc, lat) in enumerate(rows):
        wh = lambda x: None if x is None else x * 1000.0
        made.append(("v", n, i, at(m), speed, soc, km, 20_000.0, wh(total), None, wh(ac), wh(dc), wh(total / 10), wh(total * 1.2), lat, 1.0, float(10 * i), "TIMER"))
    return made


@pytest.fixture(scope="module")
def report(spark):
    rows = leg(0, (0, 0.0, 80.0, 100.0, 500.0, 10.0, 50.0, 52.0), (1, 50.0, 80.0, 100.0, 500.0, 10.0, 50.0, 52.0), (30, 60.0, 70.0, 130.0, 530.0, 10.0, 50.0, 52.2), (60, 60.0, 60.0, 160.0, 560.0, 10.0, 50.0, 52.4), (61, 0.0, 60.0, 160.0, 560.0, 10.0, 50.0, 52.4),
               (90, 0.0, 60.0, 160.0, 560.0, 10.0, 50.0, 52.4), (120, 0.0, 75.0, 160.0, 560.0, 10.0, 95.0, 52.4), (150, 0.0, 90.0, 160.0, 560.0, 10.0, 140.0, 52.4))
    # No speed at all: the blocks in which the charge falls.
    rows += leg(1, (300, None, 90.0, 160.0, 560.0, 10.0, 140.0, 52.4), (330, None, 80.0, 190.0, 590.0, 10.0, 140.0, 52.2), (360, None, 70.0, 220.0, 620.0, 10.0, 140.0, 52.0))
    legs = spark.createDataFrame([("v", 0, "https://x.example/legs/7", "OP"), ("v", 1, None, None)], "vehicle_id string, leg_id int, leg_uri string, operator string")
    chargers = spark.createDataFrame([("v", "https://x.example/c/1", at(92), at(149), 93.5, 1), ("v", "https://x.example/c/0", at(0), at(10), 1.0, 0)], "vehicle_id string, uri string, o_start timestamp, o_end timestamp, energy_kwh double, list_order int")
    found = ev_report(spark.createDataFrame(rows, ROWS), legs=legs, chargers=chargers, limits={"nominal_kwh": 300.0}, confirmed_km=0.5, split_by_mass=True, merge_gap_min=30.0, reconcile=True)
    assert found.columns == ["vehicle_id", "leg_id", *REPORT]
    return found.orderBy("leg_number").collect()


def test_rows_come_in_order_with_stops_between(report):
    assert [(r.leg_number, r.leg_type, r.leg_id, r.start_ts, r.end_ts) for r in report] == [
        (1, "In Transit", 0, at(0), at(61)), (2, "Stop", 0, at(61), at(90)), (3, "DC Home", 0, at(90), at(150)), (4, "Stop", 0, at(150), at(300)), (5, "Outbound", 1, at(300), at(360))]


def test_a_trip_by_speed(report):
    trip = report[0]
    assert (trip.start_soc, trip.end_soc, trip.delta_soc, trip.delta_kwh, trip.energy_source, trip.distance_km) == (80.0, 60.0, -20.0, -60.0, "total_energy", 60.0)
    assert (trip.ep, trip.capacity_kwh, trip.mass_kg, trip.height_m, trip.cumulative_km) == (1.0, 300.0, 20_000.0, 40.0, 60.0)
    assert trip.avg_speed_kmh == pytest.approx(60 / (61 / 60)) and trip.duration_days == pytest.approx(61 / 1440)
    assert trip.ep_corrected == pytest.approx((60 - 20_000 * 9.81 * 40 / 3.6e6 / 0.9) / 60)
    assert trip.propulsion_kwh == pytest.approx(72.0) and trip.recuperation_kwh == pytest.approx(6.0) and trip.ep_without_aux == pytest.approx(1.1)
    assert (trip.origin, trip.destination, trip.operator, trip.grade, trip.battery_power_kw) == ("Point(52.000000 1.000000)", "Point(52.400000 1.000000)", "OP", "good", None)
    assert trip.charger_link is None and trip.telematics_link == f"https://x.example/explore/graphics/plots?start={quote_plus('2024-03-04 06:00:00+00:00')}&end={quote_plus('2024-03-04 07:01:00+00:00')}&type=96&type=HSS2&resourceUri={quote_plus('https://x.example/legs/7')}"


def test_a_charge(report):
    charge = report[2]
    assert (charge.delta_soc, charge.delta_kwh, charge.energy_source, charge.ac_kwh, charge.dc_kwh, charge.capacity_kwh, charge.battery_power_kw) == (30.0, 90.0, "ac_dc", 0.0, 90.0, 300.0, 90.0)
    assert (charge.ep, charge.grade, charge.cumulative_km, charge.origin, charge.charger_kwh) == (None, None, None, "Point(52.400000 1.000000)", 93.5)
    assert "%2Fc%2F1" in charge.charger_link and charge.logger_link is None


def test_a_stop_between_charge_and_trip(report):
    stop = report[3]
    assert (stop.distance_km, stop.avg_speed_kmh, stop.height_m, stop.start_soc, stop.end_soc, stop.delta_soc, stop.origin, stop.operator, stop.grade, stop.telematics_link) == (0.0, 0.0, 0.0, 90.0, 90.0, 0.0, "Point(52.400000 1.000000)", "OP", None, None)
    assert stop.mass_kg == 20_000.0 and stop.cumulative_km is None


def test_a_leg_without_speed_goes_by_the_charge(report):
    trip = report[4]
    assert (trip.start_soc, trip.end_soc, trip.delta_kwh, trip.distance_km, trip.cumulative_km, trip.telematics_link, trip.operator) == (90.0, 70.0, -60.0, 60.0, 120.0, None, None)


def test_links_are_as_python_writes_them(spark):
    rows = spark.createDataFrame([("http://h.example/a b/ü?x=1&y", datetime(2024, 1, 2, 3, 4, 5, 678), datetime(2024, 1, 2, 3, 4, 6))], "uri string, a timestamp, b timestamp")
    got = rows.select(resource_url(F.lit("http://h.example/a"), "p", F.col("a"), F.col("b"), F.col("uri"))).first()[0]
    assert got == f"http://h.example/p?start={quote_plus('2024-01-02 03:04:05.000678+00:00')}&end={quote_plus('2024-01-02 03:04:06+00:00')}&resourceUri={quote_plus('http://h.example/a b/ü?x=1&y')}"


def test_no_direction_is_no_compass_point(spark):
    rows = spark.createDataFrame([(None,), (359.0,), (22.5,), (90.0,)], "d double")
    assert [r[0] for r in rows.select(cardinal(F.col("d"))).collect()] == [None, "N", "N", "E"]


def test_performance_corrections_and_their_gates(spark):
    columns = "kind string, delta_kwh double, distance_km double, mass_kg double, height_m double, kinetic_kwh double, propulsion_kwh double, recuperation_kwh double, energy_source string, start_ts timestamp, end_ts timestamp"
    base = ("discharge", -10.0, 20.0, 36_000.0, None, 8.0, 12.0, 3.0, "total_energy", at(0), at(60))
    change = lambda **kw: tuple(kw.get(c.split()[0], v) for c, v in zip(columns.split(", "), base))
    cases = [base, change(kinetic_kwh=8.1), change(kinetic_kwh=-8.0, height_m=-100.0), change(kinetic_kwh=None), change(distance_km=None), change(energy_source="soc_estimate"), change(kind="charge", delta_kwh=30.0, energy_source="ac_dc"), change(energy_source="distance_only", delta_kwh=None)]
    got = [(r.ep, r.ep_corrected, r.ep_kinetic, r.ep_without_aux, r.battery_power_kw) for r in with_performance(spark.createDataFrame(cases, columns)).collect()]
    down = 36_000 * 9.81 * -100 / 3.6e6 * 0.9
    none = (None,) * 3
    want = [(0.5, None, 0.1, 0.45, None), (0.5, None, None, 0.45, None), (0.5, (10 - down) / 20, (10 - down + 8) / 20, 0.45, None), (0.5, None, None, 0.45, None), (*none, None, None), (0.5, None, 0.1, 0.45, -10.0), (*none, None, 30.0), (*none, None, None)]
    assert [tuple(pytest.approx(x) if x is not None else None for x in w) for w in want] == got


def test_propulsion_on_the_lines_and_inside(spark):
    rows = spark.createDataFrame([("v", 0, i, at(m), v) for i, (m, v) in enumerate([(0, 0.0), (10, 10_000.0), (20, 30_000.0), (30, 20_000.0)])], "vehicle_id string, leg_id int, row_no long, ts timestamp, propulsion_wh double")
    windows = spark.createDataFrame([("v", 0, 1, at(5), at(15)), ("v", 0, 2, at(-5), at(12)), ("v", 0, 3, at(-9), at(-5)), ("v", 0, 4, at(20), at(30)), ("v", 0, 5, at(25), at(40))], "vehicle_id string, leg_id int, seg int, start_ts timestamp, end_ts timestamp")
    got = {r.seg: r.propulsion_kwh for r in measure.propulsion_change(windows, rows, ["seg"]).collect()}
    assert got == {1: 15.0, 2: 10.0, 3: None, 4: None, 5: None}


def test_band_keeps_counted_trips_without_a_capacity(spark):
    rows = spark.createDataFrame(leg(0, (0, 0.0, 80.0, 100.0, 500.0, 10.0, 50.0, 52.0), (30, 60.0, 79.0, 130.0, 530.0, 10.0, 50.0, 52.2)), ROWS)
    windows = spark.createDataFrame([("v", 0, 1, at(0), at(30))], "vehicle_id string, leg_id int, seg int, start_ts timestamp, end_ts timestamp")
    outside = segments.measure_trips(windows, rows, ["seg"], band=(100.0, 600.0)).first()
    kept = segments.measure_trips(windows, rows, ["seg"], band=(100.0, 600.0), keep_outside_band=True).first()
    assert (outside.failed, kept.failed, kept.outside_band, kept.capacity_kwh, kept.delta_kwh) == ("band", None, True, None, -30.0)


def test_an_unknown_branch_is_an_error(spark):
    rows = spark.createDataFrame(leg(0, (0, 0.0, 80.0, 100.0, 500.0, 10.0, 50.0, 52.0)), ROWS).withColumn("branch", F.lit("guess"))
    with pytest.raises(Exception, match="unknown branch"):
        segments.discharge_segments(rows).collect()


def test_mass_of_the_logger_where_a_leg_has_none(spark):
    rows = spark.createDataFrame([("v", 0, 0, at(0), None), ("v", 0, 1, at(10), 0.0), ("v", 1, 0, at(0), 9.0), ("v", 1, 1, at(1), None)], "vehicle_id string, leg_id int, row_no long, ts timestamp, mass_kg double")
    logger = spark.createDataFrame([("v", 0, at(3), 0, 30.0), ("v", 0, at(4), 1, 40.0), ("v", 0, at(16), 2, 50.0), ("v", 1, at(1), 0, 60.0)], "vehicle_id string, leg_id int, ts timestamp, row_no long, mass_kg double")
    got = {(r.leg_id, r.row_no): r.mass_kg for r in segments.with_logger_mass(rows, logger).collect()}
    assert got == {(0, 0): 30.0, (0, 1): None, (1, 0): 9.0, (1, 1): None}


def test_charges_come_before_trips_that_start_with_them(spark):
    from wayline.operators.report import numbered

    rows = spark.createDataFrame([("v", "Outbound", at(0), at(5)), ("v", "DC Home", at(0), at(9)), ("v", "AC Away", at(-1), at(0))], "vehicle_id string, leg_type string, start_ts timestamp, end_ts timestamp")
    assert [r.leg_type for r in numbered(rows).orderBy("leg_number").collect()] == ["AC Away", "DC Home", "Outbound"]


def test_trips_that_fail_a_floor_stay_on_the_odometers_word(spark):
    rows = leg(0, (0, 0.0, 80.0, 100.0, 500.0, 1.0, 1.0, 52.0), (30, 60.0, 80.0, 130.0, 501.0, 1.0, 1.0, 52.2), (60, 0.0, 80.0, 130.2, 502.0, 1.0, 1.0, 52.2), (90, 0.0, 79.0, 140.0, 503.0, 1.0, 1.0, 52.3), (120, 0.0, 90.0, 140.0, 503.0, 1.0, 50.0, 52.3), (150, 0.0, 70.0, 180.0, 560.0, 1.0, 50.0, 52.3))
    rows = spark.createDataFrame(rows, ROWS)
    window = "vehicle_id string, leg_id int, seg int, start_ts timestamp, end_ts timestamp"
    windows = spark.createDataFrame([("v", 0, 1, at(0), at(30)), ("v", 0, 2, at(30), at(60)), ("v", 0, 3, at(60), at(150))], window)
    charges = spark.createDataFrame([("v", 0, at(90), at(120))], "vehicle_id string, leg_id int, c_start timestamp, c_end timestamp")
    limits = {"min_soc_drop": 15.0, "min_energy_kwh": 2.0}
    measured = segments.measure_trips(windows, rows, ["seg"], **limits)
    assert {r.seg: r.failed for r in measured.collect()} == {1: "soc", 2: "soc", 3: "soc"}
    got = {(r.seg, r.start_ts, r.end_ts): (r.energy_source, r.delta_kwh, r.distance_km, r.odometer_confirmed) for r in segments.odometer_confirmed(measured, charges, rows, ["seg"], 0.5, **limits).collect()}
    # A part under half a kilometre goes; a charge parts the third, whose charge did not rise on the whole, so its parts have no energy.
    assert got == {(1, at(0), at(30)): ("distance_only", None, 30.0, True), (3, at(60), at(90)): ("distance_only", None, pytest.approx(9.8), True), (3, at(120), at(150)): ("distance_only", None, 40.0, True)}


def test_parts_of_a_trip_whose_charge_rose_are_measured_again(spark):
    rows = leg(0, (0, 60.0, 50.0, 100.0, 500.0, 1.0, 1.0, 52.0), (60, 60.0, 30.0, 160.0, 560.0, 1.0, 1.0, 52.0), (90, 0.0, 95.0, 160.0, 560.0, 1.0, 200.0, 52.0), (150, 60.0, 75.0, 220.0, 620.0, 1.0, 200.0, 52.0))
    rows = spark.createDataFrame(rows, ROWS)
    windows = spark.createDataFrame([("v", 0, 1, at(0), at(150))], "vehicle_id string, leg_id int, seg int, start_ts timestamp, end_ts timestamp")
    charges = spark.createDataFrame([("v", 0, at(60), at(90))], "vehicle_id string, leg_id int, c_start timestamp, c_end timestamp")
    measured = segments.measure_trips(windows, rows, ["seg"], min_soc_drop=5.0)
    got = [(r.start_ts, r.end_ts, r.energy_source, r.delta_kwh, r.delta_soc, r.capacity_kwh) for r in segments.odometer_confirmed(measured, charges, rows, ["seg"], 0.5, min_soc_drop=5.0).orderBy("start_ts").collect()]
    assert got == [(at(0), at(60), "total_energy", -60.0, -20.0, 300.0), (at(90), at(150), "total_energy", -60.0, -20.0, 300.0)]
