"""Raw payloads kept, put together and dumped; settings checked."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayline.sources import raw, settings


def errors_of(spark, pipeline):
    text = pipeline if isinstance(pipeline, str) else json.dumps(pipeline)
    return [r.error for r in settings.pipeline_errors(spark.createDataFrame([("p", text)], "name string, json string")).orderBy("place").collect()]


GOOD = [{"soc_event_spike_pct": v} for v in (3, 3.0, 0.5, 12)] + [{"speed_params": {"keep_trips_outside_cap_band": v, "keep_odometer_confirmed_trips": v, "min_confirmed_distance_km": d}} for v in (True, False) for d in (0.5, 2, 0.05)] + [{}, {"branch": "speed", "speed_params": {}}, {"speed_params": None}, []]
BAD_SPIKE = [0, -3, "3", True, None, [3]]
BAD_FLAG = ["true", 1, 0, None, "yes"]
BAD_KM = [0, -0.5, "0.5", True, None]


def test_pipelines_that_are_right(spark):
    rows = [(str(i), json.dumps(p)) for i, p in enumerate(GOOD)]
    settings.require_valid(settings.pipeline_errors(spark.createDataFrame(rows, "name string, json string")))


def test_values_of_the_wrong_kind(spark):
    cases = [({"soc_event_spike_pct": v}, "soc_event_spike_pct must be a positive number") for v in BAD_SPIKE]
    cases += [({"speed_params": {k: v}}, f"speed_params.{k} must be true or false") for k in ("keep_trips_outside_cap_band", "keep_odometer_confirmed_trips") for v in BAD_FLAG]
    cases += [({"speed_params": {"min_confirmed_distance_km": v}}, "speed_params.min_confirmed_distance_km must be a positive number") for v in BAD_KM]
    rows = [(i, json.dumps(p)) for i, (p, _) in enumerate(cases)]
    got = {r.name: r.error for r in settings.pipeline_errors(spark.createDataFrame(rows, "name int, json string")).collect()}
    assert got == {i: e for i, (_, e) in enumerate(cases)}


def test_keys_in_the_wrong_place(spark):
    keys = (("keep_trips_outside_cap_band", True), ("keep_odometer_confirmed_trips", True), ("min_confirmed_distance_km", 0.5))
    for key, value in keys:
        assert errors_of(spark, {key: value}) == [f"{key} belongs in speed_params, not at the top level"]
        assert errors_of(spark, {"discharge_params": {key: value}}) == [f"{key} belongs in speed_params, not in discharge_params"]
    for group in settings.GROUPS:
        assert errors_of(spark, {group: {"soc_event_spike_pct": 3}}) == [f"soc_event_spike_pct belongs at the top level, not in {group}"]
    assert errors_of(spark, '{"soc_event_spike_pct": NaN}') == ["is no JSON"]
    with pytest.raises(ValueError, match="broken: 0: soc_event_spike_pct"):
        settings.require_valid(settings.pipeline_errors(spark.createDataFrame([("good", "{}"), ("broken", '{"soc_event_spike_pct": 0}')], "name string, json string")))


def test_overrides(spark):
    window = lambda a="2024-01-01", b="2024-02-01", **more: {"from": a, "to": b, "set": {"split_by_mass": True}} | more
    cases = {
        "good": ([window(), window("2024-02-01", None, reason="why"), {"from": "2023-01-01", "to": "2024-01-01", "set": {"pipeline": "known", "split_long_stops_min": None, "mass_agg": "median", "min_stop_duration_min": 2.5}}], []),
        "none": (None, []), "list": ({"from": 1}, [(-1, "period_overrides must be a list")]),
        "object": (["x"], [(0, "an override must be an object")]),
        "fields": ([window(till=1, also=2)], [(0, "unknown fields: also, till")]),
        "no from": ([{"set": {"split_by_mass": True}}], [(0, "'from' is required")]),
        "dates": ([window("2024-13-01"), window("2024-1-1"), window("2025-01-01", "never"), window("2026-01-01", "2026-01-01")], [(0, "'from' must be a day written YYYY-MM-DD"), (1, "'from' must be a day written YYYY-MM-DD"), (2, "'to' must be a day written YYYY-MM-DD"), (3, "'to' must be after 'from'"), (3, "overlaps override 2")]),
        "sets": ([{"from": "2024-01-01", "to": "2024-01-02"}, window("2024-02-01", "2024-03-01", set={}), window("2024-03-01", "2024-04-01", set=[1]), window("2024-04-01", "2024-05-01", set={"nominal_kwh": 3})], [(0, "'set' is required"), (1, "'set' is empty"), (2, "'set' must be an object"), (3, "'set' may not change nominal_kwh")]),
        "kinds": ([window(set={"prefer_logger_speed": 1, "min_cluster_gap_kg": -1, "mass_agg": " "}, reason=3)], [(0, "'reason' must be text"), (0, "'set'.mass_agg must be a name"), (0, "'set'.min_cluster_gap_kg must be a positive number"), (0, "'set'.prefer_logger_speed must be true or false")]),
        "pipeline": ([window(set={"pipeline": "other"})], [(0, "no such pipeline: other")]),
        "overlap": ([window("2024-03-01", "2024-04-01"), window("2024-01-01", None)], [(0, "overlaps override 1")]),
    }
    rows = [(k, json.dumps({"period_overrides": v})) for k, (v, _) in cases.items()] + [("diesel", json.dumps({"fuel_type": "Diesel", "period_overrides": [window()]})), ("empty", json.dumps({"fuel_type": "DIESEL", "period_overrides": []})), ("text", "{")]
    found = settings.override_errors(spark.createDataFrame(rows, "vehicle_id string, json string"), spark.createDataFrame([("known",)], "name string")).collect()
    got = {k: sorted((r.place, r.error) for r in found if r.vehicle_id == k) for k, _ in rows}
    assert got == {k: sorted(e) for k, (_, e) in cases.items()} | {"diesel": [(-1, "period_overrides are not for diesel vehicles")], "empty": [], "text": [(-1, "is no JSON")]}


def test_pieces_make_a_payload_once_and_in_order(spark):
    text = 'a,"b c",d\r\n1,"x, y",\r\n\r\n2,z,"say ""hi"""\r\n'
    pieces = [("p", i, text[i * 4 : i * 4 + 4]) for i in range(len(text) // 4 + 1)]
    rows = spark.createDataFrame([*reversed(pieces), *pieces[:3], ("q", 0, "b\n"), ("q", 2, "9\n"), ("r", 0, "d,a\n")], "key string, piece int, text string")
    whole = raw.assembled(rows, ["key"])
    assert {r.key: r.complete for r in whole.collect()} == {"p": True, "q": False, "r": True}
    got = [tuple(r) for r in raw.csv_rows(whole.where("complete"), ["key"], ["d", "a", "b c", "none"], 4).orderBy("row_no").collect()]
    assert [r[:5] for r in got] == [("p", 0, None, "1", "x, y"), ("p", 1, 'say "hi"', "2", "z")]
    assert all(r[5] is None for r in got)


def test_a_second_read_fetches_and_writes_nothing(spark, tmp_path):
    path, asked = str(tmp_path / "bronze"), []
    source = spark.createDataFrame([("v", leg, i, f"x{i}") for leg in (0, 1) for i in range(5)], "vehicle_id string, leg_id int, row_no int, soc string")

    def fetch(missing):
        asked.append(sorted(r.leg_id for r in missing.collect()))
        return source.join(missing, ["vehicle_id", "leg_id"], "left_semi")

    legs = lambda *n: spark.createDataFrame([("v", i) for i in n], "vehicle_id string, leg_id int")
    files = lambda: {os.path.join(f, n) for f, _, names in os.walk(path) for n in names}
    assert raw.read_through(legs(0, 7), path, fetch).count() == 5
    before = files()
    assert raw.read_through(legs(7, 0, 0), path, fetch).count() == 5 and asked == [[0, 7]] and files() == before
    assert raw.read_through(legs(0, 1), path, fetch).count() == 10 and asked == [[0, 7], [1]]
    # A key that two writers fetched counts once.
    source.where("leg_id = 1").withColumn("batch", F.lit("zzz")).write.mode("append").partitionBy("batch").parquet(f"{path}/rows")
    legs(1).withColumn("batch", F.lit("zzz")).write.mode("append").parquet(f"{path}/keys")
    assert raw.read_through(legs(0, 1), path, fetch).count() == 10


def test_dump_by_version_and_leg_date(spark, tmp_path):
    at = lambda h: datetime(2024, 3, 1, 23 if h else 22)
    rows = spark.createDataFrame([("v", 0, "SRFLOGGER_V1", at(0), "true", "3"), ("v", 0, "SRFLOGGER_V1", datetime(2024, 3, 2), "False", "x"), ("v", 1, "SRFLOGGER", at(1), "tRuE", "NaN"), ("v", 1, "SRFLOGGER", at(1), None, "-1.5")], "vehicle_id string, leg_id int, source string, ts timestamp, a string, b string")
    raw.dump_logger(rows, str(tmp_path / "d"), ["a", "b"])
    got = sorted((r.version, str(r.leg_date), r.ts.day, r.a, r.b) for r in spark.read.parquet(str(tmp_path / "d")).collect() if r.a is not None or r.b is not None)
    assert got == [("raw_logger", "2024-03-01", 1, None, -1.5), ("raw_logger_v1", "2024-03-01", 1, 1.0, 3.0), ("raw_logger_v1", "2024-03-01", 2, 0.0, None)]
    assert sorted(p for p in os.listdir(tmp_path / "d") if "=" in p) == ["version=raw_logger", "version=raw_logger_v1"]
