"""Queries of measured, split and audited segments, and the same in SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import enrich, islands, joins, mass, measure, segments
from ..sources import telematics as src
from ..sources.fixture_tables import telematics
from ..sources.store import written
from .queries import CHARGES_SQL, CLASSES_SQL, DISCHARGES, ID, TELEMATICS_SQL, TRIPS, TRIPS_SQL, blocks_sql, charges_of, query, shown, trips_of, us

#: More channels of the same rows, as whole numbers.
FULL_SQL = """u AS (SELECT *, CASE WHEN trigger_type IN ('TIMER', 'SIGNUP') THEN odo * 600 END AS ac, CASE WHEN trigger_type IN ('TIMER', 'SIGNUP', 'CLICK') THEN odo * 400 END AS dc,
    CASE WHEN trigger_type IN ('CLICK', 'PURCHASE') THEN odo * 800 END AS mov, CASE WHEN trigger_type IN ('CLICK', 'SIGNUP') THEN odo * 100 END AS rec, CASE WHEN trigger_type IN ('TIMER', 'PURCHASE') THEN odo * 900 END AS pro, CASE WHEN row_no % 3 > 0 THEN 50 + (row_no % 100) / 128.0 END AS lat, CASE WHEN row_no % 3 > 0 THEN (row_no % 77) / 128.0 END AS lon FROM t)"""


def full(spark, d) -> DataFrame:
    rows = telematics(spark, d)
    kind, n, km = F.col("trigger_type"), F.col("row_no"), F.col("odometer_km")
    return rows.withColumns({
        "ac_wh": F.when(kind.isin("TIMER", "SIGNUP"), km * 600), "dc_wh": F.when(kind.isin("TIMER", "SIGNUP", "CLICK"), km * 400), "moving_wh": F.when(kind.isin("CLICK", "PURCHASE"), km * 800), "recup_wh": F.when(kind.isin("CLICK", "SIGNUP"), km * 100), "propulsion_wh": F.when(kind.isin("TIMER", "PURCHASE"), km * 900),
        "lat": F.when(n % 3 > 0, 50 + (n % 100) / 128.0), "lon": F.when(n % 3 > 0, (n % 77) / 128.0), "altitude_m": (n % 500).cast("double"),
    })


def around_sql(name: str, windows: str, *columns: str, start: str = "start_us", end: str = "end_us") -> str:
    """The readings around both ends of each window, column by column, by as-of joins."""
    picked, joined = ["p.*"], [f"{windows} p"]
    for c in columns:
        for side, at in ((0, start), (1, end)):
            for x, op in (("b", ">="), ("a", "<=")):
                k = f"{c}_{x}{side}"
                picked.append(f"{k}.v AS {k}, {k}.us AS {k}_us")
                joined.append(f"ASOF LEFT JOIN (SELECT vehicle_id, us, {c} AS v FROM u WHERE {c} IS NOT NULL) {k} ON p.vehicle_id = {k}.vehicle_id AND p.{at} {op} {k}.us")
    return f"{name} AS (SELECT {', '.join(picked)} FROM {' '.join(joined)})"


LIMITS = {"nominal_kwh": 300.0, "min_soc_drop": 1.0, "min_energy_kwh": 2.0, "band": (150.0, 6000.0)}
MEASURED_SQL = ["""m1 AS (SELECT *, CASE WHEN soc_a0_us <= end_us THEN soc_a0 ELSE soc_b0 END AS start_soc, CASE WHEN soc_b1_us >= start_us THEN soc_b1 ELSE soc_a1 END AS end_soc,
    CASE WHEN wh_a1 > wh_b0 THEN CAST(wh_a1 - wh_b0 AS DOUBLE) / 1000 END AS tot, CASE WHEN mov_a1 > mov_b0 THEN CAST(mov_a1 - mov_b0 AS DOUBLE) / 1000 END AS mv, CAST(odo_a1 - odo_b0 AS DOUBLE) AS distance_km FROM m0)""",
    """m2 AS (SELECT *, coalesce(end_soc - start_soc, 0.0) AS delta_soc FROM m1)""",
    """m3 AS (SELECT *, CASE WHEN tot IS NOT NULL THEN 'total_energy' WHEN mv IS NOT NULL THEN 'moving_energy' WHEN delta_soc < 0 THEN 'soc_estimate' END AS energy_source, coalesce(-tot, -mv, CASE WHEN delta_soc < 0 THEN delta_soc / 100 * 300.0 END) AS delta_kwh FROM m2)""",
    """m4 AS (SELECT *, CASE WHEN delta_soc < 0 THEN abs(delta_kwh) / (-delta_soc / 100) END AS cap FROM m3)""",
    """m5 AS (SELECT *, CASE WHEN start_soc IS NOT NULL AND end_soc IS NOT NULL AND -delta_soc < 1 THEN 'soc' WHEN delta_kwh IS NULL THEN 'no_energy' WHEN abs(delta_kwh) < 2 OR delta_kwh >= 0 THEN 'energy' WHEN NOT coalesce(cap BETWEEN 150 AND 6000, true) THEN 'band' END AS failed FROM m4)"""]


@query("n5_trip_measures", TRIPS_SQL, FULL_SQL, around_sql("m0", "trips", "soc", "odo", "wh", "mov"), *MEASURED_SQL, "SELECT vehicle_id, seg, start_soc, end_soc, delta_soc, energy_source, delta_kwh, mv AS delta_moving_kwh, distance_km, cap AS capacity_kwh, failed FROM m5")
def _(spark, d):
    rows = full(spark, d)
    found = segments.measure_trips(trips_of(rows), rows, ["seg"], **LIMITS)
    return found.select("vehicle_id", "seg", "start_soc", "end_soc", "delta_soc", "energy_source", "delta_kwh", "delta_moving_kwh", "distance_km", "capacity_kwh", "failed")


#: Every third user's legs go by the charge; every third has no speed, half of these the logger's.
BRANCH_SQL = TRIPS_SQL.replace("t AS (", "t0 AS (", 1).replace(", trips AS (", ", t AS (SELECT * REPLACE (CASE WHEN vehicle_id % 3 = 1 AND vehicle_id % 2 = 1 THEN NULL ELSE speed END AS speed) FROM t0), trips AS (", 1)
BLOCK_LIMITS = {"min_soc_drop": 5.0, "min_energy_kwh": 5.0, "band": (100.0, 8000.0)}


def measured_sql(windows: str, out: str, limits: dict) -> list[str]:
    """``MEASURED_SQL`` over other windows, into other names."""
    steps = [around_sql(f"{out}0", windows, "soc", "odo", "wh", "mov"), *MEASURED_SQL]
    low, high = limits["band"]
    steps[-1] = steps[-1].replace("< 1 THEN", f"< {limits['min_soc_drop']:g} THEN").replace("< 2 OR", f"< {limits['min_energy_kwh']:g} OR").replace("BETWEEN 150 AND 6000", f"BETWEEN {low:g} AND {high:g}")
    return [steps[0], *(re.sub(r"\bm([0-5])\b", rf"{out}\1", x) for x in steps[1:])]


@query("n18_leg_dispatch", BRANCH_SQL, blocks_sql("falls", -1, 43_200_000_000, "prev_against < 2", 5), FULL_SQL, "tw AS (SELECT * FROM trips WHERE vehicle_id % 3 > 0)", "fw AS (SELECT vehicle_id, leg_id, start_us AS seg, start_us, end_us FROM falls)", *measured_sql("tw", "p", LIMITS), *measured_sql("fw", "b", BLOCK_LIMITS),
    "al AS (SELECT 'speed' AS branch, * FROM p5 WHERE failed IS NULL UNION ALL BY NAME SELECT 'soc' AS branch, * FROM b5 WHERE failed IS NULL AND distance_km >= 30)", "pk AS (SELECT *, bool_or(branch = 'speed') OVER (PARTITION BY vehicle_id) AS by_speed FROM al)",
    "SELECT branch, vehicle_id, seg, start_us, end_us, start_soc, end_soc, delta_soc, energy_source, delta_kwh, mv AS delta_moving_kwh, distance_km, cap AS capacity_kwh FROM pk WHERE (branch = 'speed') = by_speed")
def _(spark, d):
    rows, user = full(spark, d), F.col("vehicle_id")
    logger = rows.where((user % 3 == 1) & (user % 2 == 0)).select(*src.LEG, "ts", "row_no", "speed_kmh")
    rows = rows.withColumns({"branch": F.when(user % 3 == 0, "soc").otherwise("speed"), "speed_kmh": F.when(user % 3 != 1, F.col("speed_kmh"))})
    limits = {k: v for k, v in LIMITS.items() if k != "nominal_kwh"}
    found = segments.discharge_segments(rows, None, TRIPS, DISCHARGES, limits, BLOCK_LIMITS, 300.0, min_block_km=30.0, logger=logger)
    return shown(found, "branch", "vehicle_id", "seg", "start_ts", "end_ts", "start_soc", "end_soc", "delta_soc", "energy_source", "delta_kwh", "delta_moving_kwh", "distance_km", "capacity_kwh")


CHARGED_SQL = ["""q AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY us, row_no) AS place FROM u)""", """k AS (SELECT * FROM q WHERE ac IS NOT NULL AND dc IS NOT NULL)""",
    """cp AS (SELECT c.*, a.place AS p0, b.place AS p1 FROM charges c JOIN q a ON a.vehicle_id = c.vehicle_id AND a.us = c.start_us JOIN q b ON b.vehicle_id = c.vehicle_id AND b.us = c.end_us)""",
    """ce AS (SELECT cp.*, coalesce((SELECT max(place) FROM k WHERE k.vehicle_id = cp.vehicle_id AND place <= p0), (SELECT min(place) FROM k WHERE k.vehicle_id = cp.vehicle_id)) AS lo, coalesce((SELECT min(place) FROM k WHERE k.vehicle_id = cp.vehicle_id AND place >= p1), (SELECT max(place) FROM k WHERE k.vehicle_id = cp.vehicle_id)) AS hi FROM cp)""",
    """cd AS (SELECT ce.*, end_soc - start_soc AS ds, CASE WHEN lo < hi THEN CAST(b.ac - a.ac AS DOUBLE) / 1000 END AS dac, CASE WHEN lo < hi THEN CAST(b.dc - a.dc AS DOUBLE) / 1000 END AS ddc FROM ce LEFT JOIN k a ON a.vehicle_id = ce.vehicle_id AND a.place = lo LEFT JOIN k b ON b.vehicle_id = ce.vehicle_id AND b.place = hi)""",
    """cf AS (SELECT *, CASE WHEN dac + ddc > 0 THEN dac + ddc ELSE ds / 100 * 300.0 END AS delta_kwh, dac + ddc > 0 IS TRUE AS counted FROM cd)"""]


@query("j2_charge_energy", TELEMATICS_SQL, CHARGES_SQL, FULL_SQL, *CHARGED_SQL, """SELECT vehicle_id, start_us, end_us, delta_kwh, CASE WHEN counted THEN 'ac_dc' ELSE 'soc_estimate' END AS energy_source, CASE WHEN NOT counted THEN 'estimated' WHEN dac >= 0.5 AND ddc >= 0.5 THEN 'Mix charge' WHEN dac >= 0.5 THEN 'AC charge' ELSE 'DC charge' END AS charge_type,
    delta_kwh / (ds / 100) AS capacity_kwh FROM cf WHERE delta_kwh >= 5""")
def _(spark, d):
    rows = full(spark, d)
    return shown(segments.charge_energy(charges_of(rows), rows, nominal_kwh=300.0), "vehicle_id", "start_ts", "end_ts", "delta_kwh", "energy_source", "charge_type", "capacity_kwh")


@query("a30_charge_places", TELEMATICS_SQL, CHARGES_SQL, FULL_SQL, "SELECT c.vehicle_id, c.start_us, CAST(floor(avg(lat) * 1e5 + 0.5 + 1e-7) AS BIGINT) AS lat_1e5, CAST(floor(avg(lon) * 1e5 + 0.5 + 1e-7) AS BIGINT) AS lon_1e5 FROM charges c LEFT JOIN u ON u.vehicle_id = c.vehicle_id AND us BETWEEN start_us AND end_us GROUP BY c.vehicle_id, c.start_us")
def _(spark, d):
    rows = full(spark, d)
    places = segments.charge_places(charges_of(rows).withColumn("seg", us("start_ts")), rows, ["seg"])
    whole = lambda c: F.floor(F.col(c) * 1e5 + 0.5).cast("long").alias(f"{c}_1e5")
    return places.select("vehicle_id", F.col("seg").alias("start_us"), whole("lat"), whole("lon"))


def _passed(spark, d):
    rows = full(spark, d)
    return rows, written(segments.measure_trips(trips_of(rows), rows, ["seg"], **LIMITS).where("failed is null"))


GOOD_SQL = """g AS (SELECT *, CASE energy_source WHEN 'total_energy' THEN wh_b0_us WHEN 'moving_energy' THEN mov_b0_us ELSE start_us END AS a_start_us, CASE energy_source WHEN 'total_energy' THEN wh_a1_us WHEN 'moving_energy' THEN mov_a1_us ELSE end_us END AS a_end_us FROM m5 WHERE failed IS NULL)"""


def line_sql(c: str, side: int, at: str) -> str:
    b, a = f"{c}_b{side}", f"{c}_a{side}"
    return f"coalesce(CASE WHEN {b}_us = {a}_us THEN CAST({b} AS DOUBLE) ELSE {b} + (CAST({a} AS DOUBLE) - {b}) * (CAST({at} - {b}_us AS DOUBLE) / CAST({a}_us - {b}_us AS DOUBLE)) END, {b}, {a})"


@query("a25_audit", TRIPS_SQL, FULL_SQL, around_sql("m0", "trips", "soc", "odo", "wh", "mov"), *MEASURED_SQL, GOOD_SQL, "g2 AS (SELECT vehicle_id, seg, start_us, end_us, a_start_us, a_end_us, odo_b0, odo_b0_us, odo_a1, odo_a1_us, " + line_sql("odo", 0, "start_us") + " AS k0, " + line_sql("odo", 1, "end_us") + " AS k1 FROM g)",
    around_sql("g3", "(SELECT vehicle_id, seg, a_start_us, a_end_us FROM g2)", "odo", start="a_start_us", end="a_end_us"), "g4 AS (SELECT vehicle_id, seg, " + line_sql("odo", 0, "a_start_us") + " AS f0, " + line_sql("odo", 1, "a_end_us") + " AS f1 FROM g3)",
    """st AS (SELECT vehicle_id, seg, min([-drop_ / hours, us, row_no]) AS best FROM (SELECT g.vehicle_id, seg, u.us, u.row_no, lag(soc) OVER w - soc AS drop_, (u.us - lag(u.us) OVER w) / 3.6e9 AS hours FROM g JOIN u ON u.vehicle_id = g.vehicle_id AND u.us BETWEEN start_us AND end_us WHERE soc IS NOT NULL WINDOW w AS (PARTITION BY g.vehicle_id, seg ORDER BY u.us, u.row_no)) WHERE drop_ > 0 AND hours > 0 GROUP BY ALL)""",
    """SELECT g2.vehicle_id, g2.seg, CAST(floor(((CASE WHEN a_start_us < start_us THEN greatest(k0 - f0, 0) ELSE 0 END) + (CASE WHEN a_end_us > end_us THEN greatest(f1 - k1, 0) ELSE 0 END)) * 1e3 + 0.5) AS BIGINT) AS outside_m,
    (greatest(start_us - a_start_us, 0) + greatest(a_end_us - end_us, 0)) // 1000000 AS outside_s, CAST(floor(((CASE WHEN odo_b0_us < start_us THEN greatest(k0 - odo_b0, 0) ELSE 0 END) + (CASE WHEN odo_a1_us > end_us THEN greatest(odo_a1 - k1, 0) ELSE 0 END)) * 1e3 + 0.5) AS BIGINT) AS dist_outside_m,
    (SELECT count(*) FROM t WHERE t.vehicle_id = g2.vehicle_id AND us BETWEEN start_us AND end_us) AS samples, CAST(floor(-best[1] * 1e3 + 0.5) AS BIGINT) AS step_rate_milli FROM g2 JOIN g4 USING (vehicle_id, seg) LEFT JOIN st USING (vehicle_id, seg)""")
def _(spark, d):
    rows, trips = _passed(spark, d)
    found = segments.audit(trips, rows, ["seg"])
    whole = lambda c, k, name: F.floor(F.col(c) * k + 0.5).cast("long").alias(name)
    return found.select("vehicle_id", "seg", whole("outside_km", 1e3, "outside_m"), F.floor(F.col("outside_min") * 60 + 1e-7).cast("long").alias("outside_s"), whole("dist_outside_km", 1e3, "dist_outside_m"), "samples", whole("step_rate", 1e3, "step_rate_milli"))


@query("a27_counter_gap", TELEMATICS_SQL, "SELECT vehicle_id, CASE WHEN count(*) > 2 THEN median(g) END AS gap_min FROM (SELECT vehicle_id, (us - lag(us) OVER (PARTITION BY vehicle_id ORDER BY us, row_no)) / 60000000 AS g FROM t WHERE wh IS NOT NULL) GROUP BY 1")
def _(spark, d):
    return segments.counter_gap_minutes(telematics(spark, d), "total_wh").select("vehicle_id", "gap_min")


@query("n6_odometer_confirmed")
def _(spark, d):
    rows = full(spark, d)
    charges = charges_of(rows).select(*src.LEG, F.col("start_ts").alias("c_start"), F.col("end_ts").alias("c_end"))
    measured = written(segments.measure_trips(trips_of(rows), rows, ["seg"], **LIMITS))
    return shown(segments.odometer_confirmed(measured, charges, rows, ["seg"], **LIMITS), "vehicle_id", "start_ts", "end_ts", "energy_source", "delta_kwh", "distance_km")


@query("n11_split_by_mass", TRIPS_SQL, CLASSES_SQL, FULL_SQL, around_sql("m0", "trips", "soc", "odo", "wh", "mov"), *MEASURED_SQL, GOOD_SQL, """sp AS (SELECT DISTINCT vehicle_id, seg, split_us FROM (SELECT g.vehicle_id, seg, l.us AS split_us, mass_class, lag(mass_class) OVER (PARTITION BY g.vehicle_id, seg ORDER BY l.us, l.row_no) AS p, start_us, end_us FROM g JOIN lab l ON l.vehicle_id = g.vehicle_id AND l.us BETWEEN start_us AND end_us WHERE speed > 1 AND mass_class IS NOT NULL) WHERE p <> mass_class AND split_us > start_us AND split_us < end_us)""",
    around_sql("s0", "sp", "soc", start="split_us", end="split_us"), "pt AS (SELECT vehicle_id, seg, split_us AS us, " + line_sql("soc", 0, "split_us") + """ AS soc FROM s0 UNION ALL SELECT vehicle_id, seg, start_us, start_soc FROM g WHERE (vehicle_id, seg) IN (SELECT (vehicle_id, seg) FROM sp) UNION ALL SELECT vehicle_id, seg, end_us, end_soc FROM g WHERE (vehicle_id, seg) IN (SELECT (vehicle_id, seg) FROM sp))""",
    """pr AS (SELECT * FROM (SELECT vehicle_id, seg, us AS start_us, lead(us) OVER w AS end_us, lead(soc) OVER w - soc AS ds FROM pt WINDOW w AS (PARTITION BY vehicle_id, seg ORDER BY us)) WHERE end_us IS NOT NULL)""",
    """kp AS (SELECT pr.vehicle_id, pr.seg, pr.start_us, pr.end_us, g.delta_kwh * (ds / g.delta_soc) AS e FROM pr JOIN g USING (vehicle_id, seg) WHERE -ds >= 0.5 AND abs(g.delta_kwh * (ds / nullif(g.delta_soc, 0))) >= 2)""",
    """SELECT vehicle_id, seg, start_us, end_us, CAST(floor(e * 1e3 + 0.5) AS BIGINT) AS delta_wh FROM kp UNION ALL SELECT vehicle_id, seg, start_us, end_us, CAST(floor(delta_kwh * 1e3 + 0.5) AS BIGINT) FROM g WHERE (vehicle_id, seg) NOT IN (SELECT (vehicle_id, seg) FROM kp)""")
def _(spark, d):
    rows, trips = _passed(spark, d)
    labelled = mass.mass_classes(rows)
    splits = mass.class_changes(joins.in_interval(labelled, trips.select(*ID, "start_ts", "end_ts"), ID), ID, window_min=None)
    parts = segments.split_at(trips, splits, rows, ["seg"], min_soc_drop=0.5)
    return parts.select("vehicle_id", "seg", us("start_ts").alias("start_us"), us("end_ts").alias("end_us"), F.floor(F.col("delta_kwh") * 1e3 + 0.5).cast("long").alias("delta_wh"))


@query("a9_height", TRIPS_SQL, "SELECT vehicle_id, seg, CAST(last(a ORDER BY us, row_no) - first(a ORDER BY us, row_no) AS DOUBLE) AS height_m FROM (SELECT trips.vehicle_id, seg, us, row_no, row_no % 500 AS a FROM trips JOIN t ON t.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us) GROUP BY 1, 2 HAVING count(*) >= 2 UNION ALL SELECT trips.vehicle_id, seg, NULL FROM trips JOIN t ON t.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us GROUP BY 1, 2 HAVING count(*) < 2")
def _(spark, d):
    rows = full(spark, d)
    return measure.height_difference(joins.in_interval(rows, trips_of(rows), ID), ID).select("vehicle_id", "seg", "height_m")


@query("p25_nearest_place", FULL_SQL.replace("FROM t)", "FROM (SELECT event_id AS row_no, NULL AS trigger_type, NULL AS odo FROM events))"), """pl AS (SELECT s_suppkey AS postcode, 50 + (s_suppkey % 90) / 128.0 + 0.001 AS lat, (s_suppkey % 70) / 128.0 + 0.001 AS lon FROM supplier)""",
    """hv AS (SELECT row_no, postcode, 2 * 6371.0088 * asin(sqrt(least(1, pow(sin((radians(pl.lat) - radians(u.lat)) / 2), 2) + cos(radians(u.lat)) * cos(radians(pl.lat)) * pow(sin((radians(pl.lon) - radians(u.lon)) / 2), 2)))) AS km FROM u JOIN pl ON abs(pl.lat - u.lat) < 0.02 AND abs(pl.lon - u.lon) < 0.02)""",
    "SELECT u.row_no, (SELECT arg_min(postcode, [km, postcode]) FROM hv WHERE hv.row_no = u.row_no AND km <= 0.5) AS postcode FROM u")
def _(spark, d):
    n, k = F.col("row_no"), F.col("s_suppkey")
    points = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("row_no")).withColumns({"lat": F.when(n % 3 > 0, 50 + (n % 100) / 128.0), "lon": F.when(n % 3 > 0, (n % 77) / 128.0)})
    places = spark.read.parquet(f"{d}/supplier.parquet").select(k.alias("postcode"), (50 + (k % 90) / 128.0 + 0.001).alias("lat"), ((k % 70) / 128.0 + 0.001).alias("lon"))
    return enrich.nearest_place(points, places, ["row_no"]).select("row_no", "postcode")


@query("p18_spellings", """SELECT c_custkey, list_aggregate(list_filter([upper(r), upper(r)[1:2] || upper(r)[3:4] || ' ' || upper(r)[5:7]], lambda x: x IS NOT NULL), 'string_agg', '|') || '|' || upper(r)[1:2] || ' ' || upper(r)[3:7] AS spellings FROM (SELECT c_custkey, chr(97 + CAST(c_custkey % 26 AS INTEGER)) || 'k' || lpad(CAST(c_custkey % 90 + 10 AS VARCHAR), 2, '0') || 'abc' AS r FROM customer)""")
def _(spark, d):
    k = F.col("c_custkey")
    plate = F.concat(F.char((97 + k % 26).cast("long")), F.lit("k"), F.lpad((k % 90 + 10).cast("string"), 2, "0"), F.lit("abc"))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.array_join(S.spelling_variants(plate), "|").alias("spellings"))
