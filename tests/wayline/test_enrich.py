"""Operators of legs and places by hand-made cases."""

from __future__ import annotations

import math
import random
from datetime import date

from wayline.operators import enrich


def test_the_operator_cascade(spark):
    day = date(2024, 5, 1)
    legs = [("v", 1, "Big Round  Robin: Acme Foods - Maker", "Umbrella", day), ("v", 2, "round robin: new & co. -OTHER", None, day), ("v", 3, None, " Dairy Ltd ", day), ("v", 4, "Round Robin: Acme Foods - Nobody", "Umbrella", day), ("v", 5, None, "stranger", date(2023, 1, 1)), ("w", 1, None, None, day)]
    tokens = [("acme foods", "ACME"), ("ACME FOODS", "ACME")]
    organisations = [("dairy ltd", "DAIRY"), ("Dairy Ltd", "DAIRY"), ("umbrella", "NO")]
    settings = [("v", 1, date(2024, 5, 1), None, "LATER"), ("v", 0, date(2024, 4, 1), date(2024, 5, 1), "BEFORE"), ("v", 2, None, None, " SINGLE ")]
    found = enrich.leg_operator(
        spark.createDataFrame(legs, "vehicle_id string, leg_id int, trial_desc string, organisation string, leg_date date"), spark.createDataFrame(tokens, "token string, code string"), spark.createDataFrame(organisations, "name string, code string"),
        spark.createDataFrame(settings, "vehicle_id string, place int, valid_from date, valid_to date, code string"), ["Maker", "Other"], ("umbrella",), ("ACME", "DAIRY", "LATER"))
    got = {(r.vehicle_id, r.leg_id): (r.operator, r.operator_source, r.operator_unknown) for r in found.collect()}
    assert got == {("v", 1): ("ACME", "trial", False), ("v", 2): ("NEW_CO", "trial", True), ("v", 3): ("DAIRY", "organisation", False), ("v", 4): ("LATER", "config", False), ("v", 5): ("SINGLE", "config", True), ("w", 1): (None, "none", True)}


def test_the_nearest_place_at_every_latitude(spark):
    rng = random.Random(3)
    km = lambda a, b: 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)))
    points, places = [], []
    for lat in (0.0, 51.999, 52.0, 63.5, 70.0, 79.99, 88.5, 89.97, -45.0, -66.0):
        for lon in (0.0, 179.9999, -179.9999, 12.34):
            points.append((lat, lon))
            for _ in range(4):
                d, angle = rng.uniform(0.0, 0.9), rng.uniform(0, 2 * math.pi)
                north = lat + math.degrees(d * math.cos(angle) / 6371.0088)
                east = lon + math.degrees(d * math.sin(angle) / 6371.0088 / math.cos(math.radians(lat)))
                places.append((f"p{len(places)}", min(north, 89.999), (east + 180) % 360 - 180))
    want = {i: min(((km(p, q[1:]), q[0]) for q in places if km(p, q[1:]) <= 0.5), default=(0, None))[1] for i, p in enumerate(points)}
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(99, None, 1.0)], "i int, lat double, lon double")
    got = {r.i: r.postcode for r in enrich.nearest_place(rows, spark.createDataFrame(places, "postcode string, lat double, lon double"), ["i"]).collect()}
    assert got == want | {99: None} and sum(v is not None for v in want.values()) > 20
