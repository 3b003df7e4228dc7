"""Results and plans that larger tables depend on."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wayline.operators import capacity, clean, enrich, measure
from wayline.operators.grade import grade, grade_tally
from wayline.plans.queries import QUERIES
from wayline.sources import settings, telematics


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_whole_capacities_one_deviation_off_are_no_outliers_in_any_order(spark):
    rng, rows = random.Random(9), []
    for vehicle in range(300):
        half = rng.randint(1, 9)
        own = [312 + rng.randint(0, 60)] * half
        own += [own[0] + rng.randint(1, 40)] * half
        rng.shuffle(own)
        rows += [(vehicle, datetime(2024, 1, 1) + timedelta(hours=i), 5.0, float(x), "total_energy", None) for i, x in enumerate(own)]
    rows += [(-1, datetime(2024, 1, 1), 5.0, 312.4, "total_energy", None)] * 3
    rows += [(-2, datetime(2024, 1, 1), 5.0, x, "total_energy", None) for x in (300.0, 300.0, 300.0, 400.0)]
    df = spark.createDataFrame(rows, "vehicle_id long, ts timestamp, delta_soc double, capacity_kwh double, energy_source string, delta_kwh double")
    assert [(r.vehicle_id, r.capacity_kwh) for r in capacity.replace_outliers(df).where("outlier").collect()] == [(-2, 300.0)]


def test_a_tally_works_grades_out_once_and_without_interpreted_rules(spark):
    plan = plan_of(QUERIES["a26_grade_tally"](spark, "/root/testdata/sf0.001"))
    assert "lambda" not in plan and plan.count("105.0") == 1


def test_grades_at_limits(spark):
    fixed = "'soc_estimate' AS energy_source, -9.0D AS delta_kwh, 10.0D AS distance_km, timestamp'2024-01-01 00:00:00' AS start_ts, timestamp'2024-01-01 01:00:00' AS end_ts, 0.9D AS ep, 1.0D AS counter_kwh, 0.0D AS outside_km, 0.0D AS outside_min, 0.0D AS dist_outside_km, 5 AS odo_samples, 5 AS samples, 900.0D AS step_rate, 300.0D AS referee_kwh"
    rows = spark.sql(f"SELECT n, {fixed}, -8.0D AS delta_soc, quantum AS soc_quantum, step AS step_pct FROM VALUES (1, 0D, 2D), (2, 0D, 4D), (3, 0D, 1.9999D), (4, 2D, 0D), (5, 2.5D, 0D), (6, NULL, NULL), (7, 0D, double('NaN')) AS v(n, quantum, step)")
    graded = grade(rows)
    found = {r.n: (r.grade, r.reason) for r in graded.collect()}
    assert found == {1: ("caution", "SOC_STEP 0.25"), 2: ("poor", "SOC_STEP 0.50"), 3: ("good", ""), 4: ("caution", "SOC_RES 0.25"), 5: ("poor", "SOC_RES 0.31"), 6: ("good", ""), 7: ("poor", "SOC_STEP NaN")}
    ungraded = graded.unionByName(graded.limit(1).withColumn("grade", F.lit(None).cast("string")))
    assert sorted((r.grade, r.n) for r in grade_tally(ungraded, []).collect()) == [("caution", 2), ("good", 2), ("poor", 3)]


def test_override_checks_are_worked_out_once_and_in_many_tasks(spark):
    plan = plan_of(settings.override_errors(spark.sql("SELECT id AS vehicle_id, string(id) AS json FROM range(0, 10, 1, 1)"), spark.sql("SELECT 'p' AS name")))
    assert plan.count("RepartitionByExpression [vehicle_id") == 3  # one for each part of the union
    assert "size(filter(" not in plan  # all errors once more, for Spark's own filter


def test_points_and_places_that_share_coordinates_meet_once(spark):
    points = spark.sql("SELECT id AS n, CASE WHEN id % 3 > 0 THEN 50.0D END AS lat, CASE WHEN id % 5 > 0 THEN id % 2 * 0.5D END AS lon FROM range(600)")
    places = spark.sql("SELECT string(id) AS postcode, 50.001D AS lat, id % 2 * 0.5D AS lon FROM range(10, 400) UNION ALL SELECT NULL, 50.001D, 0.5D UNION ALL SELECT '1', 50.002D, 0.0D")
    found = enrich.nearest_place(points, places, ["n"])
    assert {(r.n, r.postcode) for r in found.collect()} == {(n, "10" if n % 3 and n % 5 and n % 2 == 0 else None) for n in range(600)}
    joins = [line for line in plan_of(found).splitlines() if "Join Left" in line]
    assert joins and all("p_lat" in line for line in joins)  # not by the points' own ids


def test_channels_side_by_side_are_dealt_to_many_tasks(spark):
    readings = spark.sql("SELECT id % 40 AS vehicle_id, id % 4 AS leg_id, timestamp_seconds(id) AS ts, id * 10 + n AS row_no, CASE n WHEN 3 THEN 'other' WHEN 2 THEN 'b' ELSE 'a' END AS channel, double(id + n) AS value FROM range(400) JOIN (SELECT explode(array(0, 1, 2, 3, NULL)) AS n)")
    wide = telematics.wide_logger(readings, ["a", "b", "c"])
    # Not merged by the bytes of narrow readings, nor put together before they are dealt out.
    assert wide.rdd.getNumPartitions() >= telematics.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert [(r.a, r.b, r.c) for r in wide.orderBy("ts").collect()] == [(float(i), float(i + 2), None) for i in range(400)]


def test_replays_are_found_by_tasks_that_read_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rng, rows, want = random.Random(4), [], {}
        for vehicle in range(30):
            km = [float(rng.choice((100, 100, 101, 105, 90, 300))) for _ in range(rng.randint(1, 25))]
            gone = set(clean.replayed([60.0 * i for i in range(len(km))], km))
            rows += [(vehicle, f"leg {vehicle % 2}", i, datetime(2024, 1, 1) + timedelta(minutes=i), x) for i, x in enumerate(km)]
            want |= {(vehicle, i): None if i in gone else x for i, x in enumerate(km)}
        rng.shuffle(rows)
        found = clean.clean_odometer(spark.createDataFrame(rows, "vehicle_id long, leg_id string, row_no int, ts timestamp, odometer_km double"))
        assert {(r.vehicle_id, r.row_no): r.odometer_km for r in found.collect()} == want and None in want.values()
        assert "MapInArrow" in plan_of(found) and "FlatMapGroups" not in plan_of(found)  # no leg whole in one frame
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_speed_is_smoothed_without_interpreted_functions(spark):
    rows = spark.createDataFrame([(1, i, datetime(2024, 1, 1) + timedelta(minutes=i), v) for i, v in enumerate((36.0, 72.0, 0.0, 36.0, None))] + [(2, 0, datetime(2024, 1, 1), 36.0)], "k int, row_no int, ts timestamp, speed_kmh double")
    found = measure.kinetic_kwh(rows, ["k"], 3.6e6, eta=1.0, least=2)
    assert "lambda" not in plan_of(found)
    # 54, 36, 36 and 18 km/h: 15, 10, 10 and 5 m/s.
    assert {r.k: r.kinetic_kwh for r in found.collect()} == {1: (5.0**2 - 15.0**2) / 2, 2: None}
