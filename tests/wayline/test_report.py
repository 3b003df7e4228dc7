"""The finished report's operators on hand-made rows."""

from __future__ import annotations

import csv
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wayline.operators import measure, report

T0 = datetime(2024, 3, 1, 8)
ROWS = [("v", "Outbound", 0, 1.0, 10.0), ("v", " DC Home", 60, 2.0, None), ("v", "STOP", 120, 3.0, 0.0), ("v", None, 180, 4.0, 5.0), ("v", "Return", 240, float("nan"), 7.0), ("v", "Return", 300, 9.0, 2.0)]


def rows(spark, given=ROWS):
    return spark.createDataFrame([(v, label, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 9), ep, km) for v, label, m, ep, km in given], "vehicle_id string, leg_type string, start_ts timestamp, end_ts timestamp, ep double, km double")


def test_scrub_clears_charges_and_stops_only(spark):
    got = [r["ep"] for r in report.scrub(rows(spark)).orderBy("start_ts").collect()]
    assert got[:4] == [1.0, None, None, 4.0] and got[4] != got[4] and got[5] == 9.0


def test_rows_are_numbered_from_one_and_coloured(spark):
    got = report.numbered(rows(spark)).orderBy("leg_number").select("leg_number", "colour").collect()
    assert [tuple(r) for r in got] == [(1, "green"), (2, "red"), (3, "white"), (4, None), (5, "green"), (6, "green")]


def test_chart_takes_known_values_inside_its_windows(spark):
    def chart(**more):
        return report.Chart("km", "ep", y_takes=(1.0, 4.0), **more)

    def points(c):
        return sorted(tuple(r) for r in report.chart_points(rows(spark), c, []).collect())

    assert points(chart()) == [(5.0, 4.0), (10.0, 1.0)]
    with_charges = rows(spark).withColumn("km", F.coalesce("km", F.lit(3.0)))
    assert report.chart_points(with_charges, chart(driving_only=False), []).count() == 3
    assert report.chart_points(with_charges, chart(), []).count() == 2


def test_distance_filter_keeps_what_it_cannot_measure(spark):
    trips = spark.createDataFrame([(1, 10.0, 14.9), (2, 10.0, 15.0), (3, None, 15.0), (4, 10.0, None)], "k int, odometer_start_km double, odometer_end_km double")
    assert [r.k for r in report.far_enough(trips, 5.0).orderBy("k").collect()] == [2, 3, 4]
    assert report.far_enough(trips).count() == 4


def test_running_distance_on_all_kinds(spark):
    given = [("charge", 0, None), ("discharge", 1, None), ("discharge", 2, 4.0), ("stop", 3, 0.0), ("charge", 4, None), ("stop", 5, 0.0), ("discharge", 6, 2.5)]
    df = spark.createDataFrame([("v", 0, n, n, k, km) for k, n, km in given], "vehicle_id string, leg_id int, start_ts int, seg_no int, kind string, distance_km double")
    assert [r.cumulative_km for r in measure.running_distance(df).orderBy("seg_no").collect()] == [None, 0.0, 4.0, 4.0, None, None, 6.5]


def test_backfill_leaves_periods_without_donors(spark):
    was = spark.createDataFrame([("v", "p1", 300.0, 9), ("v", "p2", 310.0, 9)], "vehicle_id string, period string, kwh double, n long")
    done = spark.createDataFrame([("v", "p1", 280.04, 10.0, "ac_dc"), ("v", "p1", 100.0, -10.0, "total_energy"), ("v", "p2", 500.0, 50.0, "soc_estimate"), ("v", "p3", 290.0, -5.0, "total_energy")], "vehicle_id string, period string, capacity_kwh double, delta_soc double, energy_source string")
    got = {r.period: (r.kwh, r.n) for r in report.backfilled(was, done).collect()}
    assert got == {"p1": (280.0, 1), "p2": (310.0, 9), "p3": (290.0, 1)}
    summary = report.backfill_summary(was, done).first()
    assert summary.old_kwh == 305.0 and summary.new_kwh == 310.0


def test_tally_counts_legs_without_an_operator(spark):
    legs = spark.createDataFrame([("v", "A"), ("v", "A"), ("v", None)], "vehicle_id string, operator string")
    assert {(r.operator, r.n) for r in report.operator_tally(legs).collect()} == {("A", 2), (None, 1)}


def test_written_report_tells_unknown_numbers_from_blank_cells(spark, tmp_path):
    report.write_report(rows(spark).withColumn("capacity_kwh", F.lit(None).cast("double")), str(tmp_path / "r"), ["capacity_kwh"])
    assert spark.read.parquet(str(tmp_path / "r" / "table")).count() == 6
    sheet = {}
    for part in (tmp_path / "r" / "sheet").glob("part-*.csv"):
        with part.open() as f:
            sheet |= {row["leg_number"]: row for row in csv.DictReader(f)}
    assert len(sheet) == 6 and {row["capacity_kwh"].strip('"') for row in sheet.values()} == {""}
    assert [sheet[str(n)]["ep"] for n in range(1, 7)] == ["1.0", "=NA()", "=NA()", "4.0", "=NA()", "9.0"]


def test_empty_report(spark):
    none = rows(spark, []).withColumn("mass_kg", F.lit(None).cast("double"))
    assert report.numbered(report.scrub(none)).count() == 0
    assert report.chart_points(none, report.EV_CHARTS[0], ["vehicle_id"]).count() == 0
