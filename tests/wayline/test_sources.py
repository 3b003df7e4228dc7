"""Paged records, daily raw files, report discovery and the ledger table."""

from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayline.operators import sequence
from wayline.sources import daily, ledger, pages

T0 = datetime(2024, 3, 1)
LEGS = "vehicle_id string, leg_id int, start_ts timestamp, note string"


@pytest.fixture
def legs(spark, tmp_path):
    rows = [(f"v{i % 4}", i, T0 + timedelta(hours=7 * i), None if i % 5 else "n") for i in range(200)]
    pages.write_pages(spark.createDataFrame(rows, LEGS), str(tmp_path), 10, ["vehicle_id", "start_ts"])
    return rows, str(tmp_path)


def test_a_page_is_a_partition_and_filters_prune_pages(spark, legs):
    rows, path = legs
    every = pages.read_pages(spark, path)
    assert sorted(map(tuple, every.collect())) == sorted(rows, key=lambda r: (r[0], r[1]))
    n = every.rdd.getNumPartitions()
    assert 15 <= n <= 25
    one = every.where("vehicle_id = 'v2'")
    assert one.count() == 50 and one.rdd.getNumPartitions() <= n / 4 + 2
    few = one.where(F.col("start_ts").between(T0 + timedelta(days=20), T0 + timedelta(days=22)))
    assert few.rdd.getNumPartitions() <= 2 and {r.leg_id for r in few.collect()} == {i for v, i, t, _ in rows if v == "v2" and 20 <= (t - T0).total_seconds() / 86400 <= 22}
    assert every.where("vehicle_id = 'none'").collect() == [] and every.where("note = 'n'").count() == 40
    assert every.where("vehicle_id in ('v0', 'v9')").rdd.getNumPartitions() <= n / 4 + 2
    assert every.select("note").where("start_ts > timestamp'2030-01-01'").collect() == []


def test_fetch_legs_takes_both_days_whole_and_sorts(spark, legs):
    rows, path = legs
    got = [(r.leg_id, r.start_ts) for r in pages.fetch_legs(spark, path, "v1", "2024-03-03", "2024-03-09").collect()]
    assert got == sorted(((i, t) for v, i, t, _ in rows if v == "v1" and datetime(2024, 3, 3) <= t < datetime(2024, 3, 10)), key=lambda r: r[1])


def test_pages_of_nothing(spark, tmp_path):
    pages.write_pages(spark.createDataFrame([], LEGS), str(tmp_path), 10, ["vehicle_id"])
    assert pages.read_pages(spark, str(tmp_path)).collect() == []


def plain_kept(times, least):
    kept = []
    for t, row in sorted(times):
        if not kept or t - kept[-1][0] >= least:
            kept.append((t, row))
    return {row for _, row in kept}


def test_downsample_equals_the_fold_on_random_legs(spark):
    rng = random.Random(6)
    rows = []
    for leg in range(12):
        at = 0
        for i in range(rng.choice([1, 2, 40, 150])):
            at += rng.choice([0, 0, 1, 3, 9, 40])
            rows.append(("v", leg, len(rows), T0 + timedelta(seconds=at)))
    rows.append(("v", 3, len(rows), None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vehicle_id string, leg_id int, row_no long, ts timestamp")
    for least in (1, 7, 10_000):
        got = {(r.leg_id, r.row_no) for r in sequence.downsample(df, least).collect()}
        assert got == {(leg, n) for leg in range(12) for n in plain_kept([((t - T0).total_seconds(), n) for _, own, n, t in rows if own == leg and t], least)}
    assert sequence.downsample(df.limit(0), 5).collect() == []


def test_day_files_by_name_and_by_their_own_headers(spark, tmp_path):
    files = {
        "raw_2024-03-01_0001.csv": "eventDatetime,latitude,longitude,gnss_latitude,gnss_longitude\n2024-03-01T08:00:00Z,50,1,51,\n2024-03-01T09:00:00Z,50,1,bad,2\nnot a time,50,1,51,2\n",
        "raw_2024-03-02_0002.csv": '﻿odometer,longitude,eventDatetime,latitude\n7,"3",2024-03-02T10:00:00Z,52\n7,,2024-03-02T11:00:00Z,52\n',
        "raw_2024-03-03_0003.csv": "eventDatetime,latitude\n2024-03-03T10:00:00Z,53\n",
        "raw_2024-03-09_0004.csv": "eventDatetime,latitude,longitude\n2024-03-09T10:00:00Z,54,4\n",
        "raw_2024-03-02.csv": "eventDatetime,latitude,longitude\n2024-03-02T10:00:00Z,55,5\n",
        "raw_2024-03-02_0005.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = sorted((r.source_file, r.ts.hour, r.lat, r.lon) for r in daily.read_raw_files(spark, str(tmp_path), "2024-03-01", "2024-03-03").collect())
    assert got == [("raw_2024-03-01_0001.csv", 8, 51.0, 1.0), ("raw_2024-03-01_0001.csv", 9, 50.0, 2.0), ("raw_2024-03-02_0002.csv", 10, 52.0, 3.0)]
    headers = {r.path.rsplit("/", 1)[1]: r.columns for r in daily.file_headers(daily.list_files(spark, str(tmp_path))).collect()}
    assert headers["raw_2024-03-02_0002.csv"] == ["odometer", "longitude", "eventDatetime", "latitude"] and "raw_2024-03-02_0005.csv" not in headers


def test_reports_by_their_strict_names(spark, tmp_path):
    names = ["v1/AB12CDE_2024-01-01_2024-03-31.xlsx", "v2/deep/ab12cde_2024-04-01_2024-06-30.parquet", "AB12CDE_2024-01-01_2024-03-31_finetuned.xlsx", "dashboard/AB12CDE_2024-01-01_2024-03-31.xlsx", "AB12CDE_2024-13-01_2024-03-31.xlsx", "AB12CDE_2024-05-01_2024-03-31.xlsx", "~AB12CDE_2024-01-01_2024-03-31.xlsx", "AB12CDE_2024-01-01.xlsx", "notes.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    got = sorted((r.registration, str(r.start_day), str(r.end_day)) for r in daily.report_files(spark, str(tmp_path)).collect())
    assert got == [("AB12CDE", "2024-01-01", "2024-03-31"), ("AB12CDE", "2024-04-01", "2024-06-30")]


PERIODS = "vehicle_id string, period string, kwh double, n long"


def entries(df):
    return sorted(tuple(r) for r in df.collect())


def test_of_two_writers_one_is_told(spark, tmp_path):
    path = str(tmp_path)
    assert entries(ledger.read_ledger(spark, path)) == [] and ledger.current_version(spark, path) == 0
    a, b = (spark.createDataFrame([(v, "2024Q1", 300.0, 5)], PERIODS) for v in "ab")
    assert ledger.commit_ledger(a, path, 0) == 1
    with pytest.raises(ledger.LedgerConflict):
        ledger.commit_ledger(b, path, 0)
    assert entries(ledger.read_ledger(spark, path)) == [("a", "2024Q1", 300.0, 5)]


def test_an_update_that_comes_second_keeps_the_first(spark, tmp_path):
    path, done = str(tmp_path), []
    other = spark.createDataFrame([("a", "2024Q2", 310.0, 7), ("b", "2024Q1", 1.0, 1)], PERIODS)

    def interfere():
        if not done:
            done.append(ledger.update_ledger(spark, path, other))

    ledger.update_ledger(spark, path, spark.createDataFrame([("a", "2024Q1", 300.0, 5), ("b", "2024Q1", 280.0, 9), ("c", "2024Q1", None, 0)], PERIODS), before_commit=interfere)
    assert entries(ledger.read_ledger(spark, path)) == [("a", "2024Q1", 300.0, 5), ("a", "2024Q2", 310.0, 7), ("b", "2024Q1", 280.0, 9)]
    assert ledger.current_version(spark, path) == 2 and len(entries(ledger.read_ledger(spark, path, version=1))) == 2


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path, errors = str(tmp_path), []

    def write(v):
        try:
            ledger.update_ledger(spark, path, spark.createDataFrame([(v, "p", 1.0, 1)], PERIODS))
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(f"v{i}",)) for i in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and [e[0] for e in entries(ledger.read_ledger(spark, path))] == [f"v{i}" for i in range(5)] and ledger.current_version(spark, path) == 5


def test_a_ledger_of_the_wrong_shape_is_an_error(spark, tmp_path):
    path = str(tmp_path)
    for bad in ([(None, "p", 1.0, 1)], [("a", "p", -1.0, 1)], [("a", "p", 1.0, 1), ("a", "p", 2.0, 1)]):
        with pytest.raises(ValueError):
            ledger.commit_ledger(spark.createDataFrame(bad, PERIODS), path, 0)
    spark.createDataFrame([(1, 2)], "vehicle_id int, size int").write.parquet(f"{path}/versions/other")
    ledger._commit(spark, path, 1, '{"folder": "versions/other"}')
    with pytest.raises(ValueError):
        ledger.read_ledger(spark, path)
    ledger._commit(spark, path, 2, "{}")
    assert entries(ledger.read_ledger(spark, path)) == []
