"""The diesel report over the supplied events, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diesel
from ..sources.fixture_tables import telematics
from .queries import TELEMATICS_SQL, TRIPS, TRIPS_SQL, query

#: Users differ in channels: every fourth has no speed but the GPS one, every third no odometer, every second no weather station.
FRAME_SQL = TELEMATICS_SQL.replace("floor(value) AS speed,", "CASE WHEN user_id % 4 = 1 THEN floor(value) / 3.6 * 3.6 ELSE floor(value) END AS speed,")
WIDE_SQL = """w AS (SELECT vehicle_id, us, speed, CASE WHEN trigger_type IN ('TIMER', 'CLICK') THEN odo * 0.5 END AS fuel, CASE WHEN vehicle_id % 3 > 0 THEN odo END AS km, CASE WHEN vehicle_id % 5 > 0 THEN mass END AS mass, CASE WHEN vehicle_id % 7 > 0 THEN row_no % 40 END AS amb,
    CASE WHEN vehicle_id % 2 = 0 THEN row_no % 30 END AS temp, CASE WHEN vehicle_id % 2 = 0 THEN 1000 + row_no % 20 END AS press, CASE WHEN vehicle_id % 2 = 0 THEN row_no % 100 END AS hum, CASE WHEN vehicle_id % 2 = 0 THEN row_no % 15 END AS wind, CASE WHEN vehicle_id % 2 = 0 THEN row_no % 360 END AS deg,
    CASE WHEN row_no % 3 > 0 THEN 50 + (row_no % 100) / 64.0 END AS lat, CASE WHEN row_no % 3 > 0 THEN (row_no % 77) / 64.0 END AS lon, row_no % 500 AS alt FROM t)"""


def _channels(spark, d):
    rows, user, n = telematics(spark, d), F.col("vehicle_id"), F.col("row_no")
    speed, km = F.col("speed_kmh"), F.col("odometer_km")
    station = user % 2 == 0
    values = {
        "speed_kmh": F.when(user % 4 != 1, speed), "gps_speed_ms": speed / 3.6, "fuel_l": F.when(F.col("trigger_type").isin("TIMER", "CLICK"), km * 0.5), "odometer_km": F.when(user % 3 > 0, km), "mass_kg": F.when(user % 5 > 0, F.col("mass_kg")), "ambient_c": F.when(user % 7 > 0, n % 40),
        "temperature": F.when(station, n % 30), "pressure": F.when(station, 1000 + n % 20), "humidity": F.when(station, n % 100), "wind_speed": F.when(station, n % 15), "wind_deg": F.when(station, n % 360), "lat": F.when(n % 3 > 0, 50 + (n % 100) / 64.0), "lon": F.when(n % 3 > 0, (n % 77) / 64.0), "altitude_m": n % 500,
    }
    long = rows.select("vehicle_id", "leg_id", "ts", "row_no", F.explode(F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*(v.cast("double") for v in values.values())))).alias("channel", "value")).where("value is not null")
    # Some readings come twice, the second one wrong.
    return long.unionByName(long.where("row_no % 9 = 0").withColumns({"value": F.col("value") + 7, "row_no": F.col("row_no") + 10**9}))


@query("diesel_report", TRIPS_SQL.replace(TELEMATICS_SQL.strip(), FRAME_SQL.strip()), WIDE_SQL,
    "s AS (SELECT p.seg, p.start_us, p.end_us, w.*, coalesce(speed, 0) * ((lead(us) OVER (PARTITION BY p.vehicle_id, p.seg ORDER BY us) - us) / 3.6e9) AS drv FROM trips p JOIN w ON w.vehicle_id = p.vehicle_id AND us BETWEEN start_us AND end_us)",
    """m AS (SELECT vehicle_id, seg, start_us, end_us, CASE WHEN count(fuel) > 1 AND arg_max(fuel, us) > arg_min(fuel, us) THEN arg_max(fuel, us) - arg_min(fuel, us) END AS fuel, CASE WHEN count(km) > 1 AND arg_max(km, us) > arg_min(km, us) THEN arg_max(km, us) - arg_min(km, us) END AS by_km, CASE WHEN count(*) > 1 THEN sum(drv) END AS by_speed, count(km) > 1 AS has_km,
        CASE WHEN count(*) FILTER (mass > 0 AND speed > 1) > 0 THEN median(mass) FILTER (mass > 0 AND speed > 1) ELSE median(mass) FILTER (mass > 0) END AS own, CASE WHEN count(*) FILTER (mass > 0 AND speed > 1) > 0 THEN CASE WHEN count(*) FILTER (mass > 0 AND speed > 1) > 2 THEN stddev_samp(mass) FILTER (mass > 0 AND speed > 1) / avg(mass) FILTER (mass > 0 AND speed > 1) END WHEN count(*) FILTER (mass > 0) > 2 THEN stddev_samp(mass) FILTER (mass > 0) / avg(mass) FILTER (mass > 0) END AS cv,
        CASE WHEN count(*) > 1 THEN CAST(arg_max(alt, us) - arg_min(alt, us) AS DOUBLE) END AS height, coalesce(avg(temp), avg(amb)) AS temperature, avg(press) AS pressure, avg(hum) AS humidity, avg(wind) AS wind_speed, avg(deg) AS deg, arg_min(lat, us) AS lat0, arg_min(lon, us) AS lon0, arg_max(lat, us) AS lat1, arg_max(lon, us) AS lon1 FROM s GROUP BY ALL)""",
    "f AS (SELECT *, coalesce(by_km, by_speed, CASE WHEN has_km THEN 0 END) AS km FROM m WHERE coalesce(by_km, by_speed, 0) >= 1)",
    "c AS (SELECT *, coalesce(own, last_value(own IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY start_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CASE WHEN vehicle_id % 10 = 0 THEN 18000.0 END) AS mass FROM f)",
    "g AS (SELECT *, sum(km) OVER (PARTITION BY vehicle_id ORDER BY start_us, seg ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far, printf('Point(%.6f %.6f)', lat0, lon0) AS origin, printf('Point(%.6f %.6f)', lat1, lon1) AS destination FROM c WHERE coalesce(fuel, mass, temperature) IS NOT NULL)",
    "h AS (SELECT *, lead(start_us) OVER v AS nxt, lead(origin) OVER v AS next_origin FROM g WINDOW v AS (PARTITION BY vehicle_id ORDER BY start_us, seg))",
    """r AS (SELECT vehicle_id, 'In Transit' AS leg_type, start_us, end_us, origin, destination, km, km / ((end_us - start_us) / 3.6e9) AS speed, height, mass, cv, so_far, fuel, fuel / km * 100 AS per100, temperature, pressure, humidity, wind_speed, CASE WHEN deg IS NOT NULL THEN ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(round_even(deg / 45, 0) AS BIGINT) % 8 + 1] END AS wind_direction, 'lfc_fuel' AS energy_source FROM h
    UNION ALL SELECT vehicle_id, 'Stop', end_us, nxt, coalesce(destination, next_origin), coalesce(destination, next_origin), 0, 0, 0, mass, cv, so_far, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM h WHERE nxt - end_us > 60000000)""",
    """SELECT vehicle_id, row_number() OVER (PARTITION BY vehicle_id ORDER BY start_us, end_us) AS leg_number, leg_type, start_us, end_us, origin, destination, CAST(floor(km * 1e3 + 0.5) AS BIGINT) AS distance_m, CAST(floor(speed * 1e3 + 0.5) AS BIGINT) AS speed_milli, height AS height_m, mass AS mass_kg, CAST(floor(cv * 1e6 + 0.5) AS BIGINT) AS cv_micro, CAST(floor(so_far * 1e3 + 0.5) AS BIGINT) AS cumulative_m, fuel AS fuel_l, CAST(floor(per100 * 1e3 + 0.5) AS BIGINT) AS per100_milli, temperature, pressure, humidity, wind_speed, wind_direction, energy_source FROM r""")
def _(spark, d):
    report = diesel.diesel_report(_channels(spark, d), TRIPS, weight_class_t=F.when(F.col("vehicle_id") % 10 == 0, 18.0))
    whole = lambda c, k, name: F.floor(F.col(c) * k + 0.5).cast("long").alias(name)
    return report.select(
        "vehicle_id", "leg_number", "leg_type", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), "origin", "destination", whole("distance_km", 1e3, "distance_m"), whole("avg_speed_kmh", 1e3, "speed_milli"), "height_m", "mass_kg", whole("mass_cv", 1e6, "cv_micro"), whole("cumulative_km", 1e3, "cumulative_m"),
        "fuel_l", whole("l_per_100km", 1e3, "per100_milli"), "temperature", "pressure", "humidity", "wind_speed", "wind_direction", "energy_source")
