"""Rolling medians and pedal events against plain versions, also where a leg is cut into many batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from wayline.operators import sequence

T0 = datetime(2024, 1, 1)
SCHEMA = "vehicle_id string, leg_id int, row_no long, ts timestamp, value double"


def plain_peaks(y, up, down, width, apart):
    """The same machine over indexes of a list."""
    found, state, low, peak, ended = [], "seek", 0, 0, -(10**9)
    for i in range(1, len(y)):
        if state == "seek":
            low = i if y[i] < y[low] else low
            if y[i] - y[low] >= up:
                state, peak = "in", i
        else:
            peak = i if y[i] > y[peak] else peak
            if y[peak] - y[i] >= down:
                if peak - low + 1 >= width and i - ended >= apart:
                    found.append(peak)
                    ended = i
                state, low = "seek", i
    return found


@pytest.mark.parametrize("limits", [(10, 8, 1, 1), (5, 5, 3, 1), (10, 8, 1, 12)])
def test_peaks_equal_a_plain_machine(limits):
    rng = random.Random(1)
    for _ in range(200):
        y = [rng.choice([0, 5, 12, 30, 60, 100]) * rng.random() for _ in range(rng.randrange(60))]
        assert sequence.pedal_peaks(y, **dict(zip(("rise", "fall", "least_width", "least_apart"), limits))) == plain_peaks(y, *limits)


@pytest.mark.parametrize("smooth", [0, 3, 5])
def test_events_of_a_hot_leg_in_small_batches(spark, smooth):
    rng = random.Random(2)
    legs = {0: 3000, 1: 40, 2: 1, 3: 4}
    rows = [("v", leg, i, T0 + timedelta(seconds=i // 2), None if rng.random() < 0.1 else 100 * rng.random()) for leg, n in legs.items() for i in range(n)]
    want = set()
    for leg in legs:
        own = [r for r in rows if r[1] == leg and r[4] is not None]
        y = pd.Series([r[4] for r in own], dtype=float)
        y = y.rolling(smooth, center=True).median().bfill().ffill() if smooth else y
        want |= {(leg, own[i][3], y[i]) for i in plain_peaks(list(y), 10, 8, 1, 1)} if y.notna().all() else set()
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        got = {(r.leg_id, r.ts, r.value) for r in sequence.pedal_events(spark.createDataFrame(rows, SCHEMA), "value", smooth=smooth).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(want) > 100


def test_medians_need_an_odd_width_and_enough_readings(spark):
    rows = spark.createDataFrame([("v", 0, i, T0 + timedelta(seconds=i), v) for i, v in enumerate([5.0, 1.0, None, 9.0])], SCHEMA)
    with pytest.raises(ValueError):
        sequence.rolling_median(rows, "value", 4)
    assert [r.value for r in sequence.rolling_median(rows, "value", 3).collect()] == [5.0, 5.0, 5.0]
    assert [r.value for r in sequence.rolling_median(rows, "value", 5).collect()] == [None, None, None]


def test_histograms_need_ten_readings_and_clamp_the_last_bin(spark):
    up_down = [0.0, 15.0, 0.0, 95.0, 0.0, 100.0, 0.0, 120.0, 0.0, 50.0]
    rows = [("v", leg, i, T0 + timedelta(seconds=i), v) for leg, values in ((0, [*up_down, 0.0]), (1, up_down[:9]), (2, [1.0] * 20)) for i, v in enumerate(values)]
    got = {r.leg_id: r.histogram for r in sequence.pedal_histograms(spark.createDataFrame(rows, SCHEMA), "value", ["vehicle_id", "leg_id"]).collect()}
    assert got == {0: "0,1,0,0,0,1,0,0,0,3"}
