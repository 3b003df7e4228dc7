"""Queries of the finished report, with line items as its rows, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import measure, report
from .queries import query

#: Line items as report rows: one vehicle for each supplier, a time of its own for each line, labels by the part.
LABELS = ("AC Home", "Stop", "Outbound", " dc away", "In Transit", "")
ROWS_SQL = """rp AS (SELECT l_suppkey AS vehicle_id, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS us, CASE l_partkey % 7 WHEN 0 THEN 'AC Home' WHEN 1 THEN 'Stop' WHEN 2 THEN 'Outbound' WHEN 3 THEN ' dc away' WHEN 4 THEN 'In Transit' WHEN 5 THEN '' END AS leg_type,
    CASE WHEN l_linenumber <> 3 THEN CAST(floor(l_quantity) AS DOUBLE) / 16 END AS ep, CAST(l_partkey % 50 AS DOUBLE) * 1024 AS mass_kg, CASE WHEN l_linenumber = 2 THEN CAST('nan' AS DOUBLE) ELSE CAST(l_partkey % 128 AS DOUBLE) END AS speed, CAST(floor(l_quantity) AS DOUBLE) AS km, l_returnflag AS flag FROM lineitem)"""
CLASS_SQL = """rc AS (SELECT *, CASE WHEN lower(trim(leg_type)) = 'stop' THEN 'stop' WHEN regexp_matches(lower(trim(leg_type)), '^(ac|dc|charge|mix|estimated)') THEN 'charge' WHEN trim(leg_type) <> '' THEN 'trip' END AS kind FROM rp)"""


def report_rows(spark, d) -> DataFrame:
    items = spark.read.parquet(f"{d}/lineitem.parquet")
    moment = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    label = F.coalesce(*(F.when(F.col("l_partkey") % 7 == k, v) for k, v in enumerate(LABELS)))
    n, whole = F.col("l_linenumber"), F.floor("l_quantity").cast("double")
    return items.select(
        F.col("l_suppkey").alias("vehicle_id"), moment.alias("us"), F.timestamp_micros(moment).alias("start_ts"), F.timestamp_micros(moment).alias("end_ts"), label.alias("leg_type"),
        F.when(n != 3, whole / 16).alias("ep"), ((F.col("l_partkey") % 50).cast("double") * 1024).alias("mass_kg"), F.when(n == 2, float("nan")).otherwise((F.col("l_partkey") % 128).cast("double")).alias("avg_speed_kmh"), whole.alias("km"), F.col("l_returnflag").alias("flag"),
    )


@query("f6_far_enough", ROWS_SQL, "SELECT vehicle_id, us FROM rp WHERE flag = 'R' OR km >= 20")
def _(spark, d):
    ends = report_rows(spark, d).withColumns({"odometer_start_km": F.lit(100.0), "odometer_end_km": F.when(F.col("flag") != "R", 100.0 + F.col("km"))})
    return report.far_enough(ends, 20.0).select("vehicle_id", "us")


@query("f10_chart_points", ROWS_SQL, CLASS_SQL, "ok AS (SELECT * FROM rc WHERE kind IS DISTINCT FROM 'stop' AND kind IS DISTINCT FROM 'charge' AND ep BETWEEN 0.1 AND 3)",
    "SELECT 'mass_kg' AS chart, vehicle_id, us, mass_kg AS x, ep AS y FROM ok WHERE mass_kg >= 1 UNION ALL SELECT 'avg_speed_kmh', vehicle_id, us, speed, ep FROM ok WHERE NOT isnan(speed) AND speed BETWEEN 0 AND 90")
def _(spark, d):
    rows = report_rows(spark, d)
    mass, _, speed = report.charts_for(rows.columns)
    points = lambda c: report.chart_points(rows, c, ["vehicle_id", "us"]).select(F.lit(c.x).alias("chart"), "vehicle_id", "us", "x", "y")
    return points(mass).unionByName(points(speed))


@query("f11_scrub", ROWS_SQL, CLASS_SQL, "SELECT vehicle_id, us, CASE WHEN kind IN ('stop', 'charge') THEN NULL ELSE ep END AS ep FROM rc")
def _(spark, d):
    return report.scrub(report_rows(spark, d)).select("vehicle_id", "us", "ep")


@query("w5_report_numbers", ROWS_SQL, CLASS_SQL, "SELECT vehicle_id, us, row_number() OVER (PARTITION BY vehicle_id ORDER BY us) AS leg_number, CASE kind WHEN 'stop' THEN 'white' WHEN 'charge' THEN 'red' WHEN 'trip' THEN 'green' END AS colour FROM rc")
def _(spark, d):
    return report.numbered(report_rows(spark, d)).select("vehicle_id", "us", "leg_number", "colour")


@query("w4_running_distance", ROWS_SQL, CLASS_SQL, "rk AS (SELECT vehicle_id, us, kind, coalesce(sum(CASE WHEN kind = 'trip' THEN km END) OVER (PARTITION BY vehicle_id ORDER BY us), 0) AS so_far FROM rc WHERE kind IS NOT NULL)",
    "nb AS (SELECT *, max(CASE WHEN kind <> 'stop' THEN us END) OVER (PARTITION BY vehicle_id ORDER BY us) AS from_us FROM rk)", "SELECT nb.vehicle_id, nb.us, CASE WHEN o.kind = 'trip' THEN o.so_far END AS cumulative_km FROM nb LEFT JOIN rk o ON o.vehicle_id = nb.vehicle_id AND o.us = from_us")
def _(spark, d):
    kind = report.row_class(F.col("leg_type"))
    rows = report_rows(spark, d).where(kind.isNotNull()).withColumns({"leg_id": F.lit(0), "seg_no": F.col("us"), "distance_km": F.col("km"), "kind": F.when(kind == "trip", "discharge").otherwise(kind)})
    return measure.running_distance(rows).select("vehicle_id", "us", "cumulative_km")


@query("a28_operator_tally", "SELECT o_custkey AS vehicle_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS operator, count(*) AS n FROM orders GROUP BY ALL")
def _(spark, d):
    legs = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("vehicle_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("operator"))
    return report.operator_tally(legs)


#: Fixed value: the energy source of rows whose capacity counts is ac_dc.
@query("l2_backfill", "dn AS (SELECT l_suppkey AS vehicle_id, l_returnflag AS period, 256 + floor(l_quantity) AS cap, floor(l_quantity) - 25 AS soc FROM lineitem WHERE l_linenumber % 2 = 1)",
    "pd AS (SELECT vehicle_id, period, count(*) FILTER (soc > 0) AS nu, count(*) FILTER (soc < 0) AS nd, sum(cap * soc) FILTER (soc > 0) / sum(soc) FILTER (soc > 0) AS u, sum(cap * soc) FILTER (soc < 0) / sum(soc) FILTER (soc < 0) AS dn FROM dn GROUP BY ALL)",
    "fresh AS (SELECT vehicle_id, period, CASE WHEN nu > 0 THEN u ELSE dn END AS kwh, CASE WHEN nu > 0 THEN nu ELSE nd END AS n FROM pd WHERE nu + nd > 0)",
    "was AS (SELECT s_suppkey AS vehicle_id, unnest(['A', 'X']) AS period, 300.0 AS kwh, 7 AS n FROM supplier)",
    "SELECT coalesce(f.vehicle_id, w.vehicle_id) AS vehicle_id, coalesce(f.period, w.period) AS period, CAST(round(coalesce(round(f.kwh, 1), w.kwh) * 10) AS BIGINT) AS kwh_tenths, coalesce(f.n, w.n) AS n FROM fresh f FULL JOIN was w ON w.vehicle_id = f.vehicle_id AND w.period = f.period")
def _(spark, d):
    whole = F.floor("l_quantity").cast("double")
    items = spark.read.parquet(f"{d}/lineitem.parquet")
    rows = items.select(F.col("l_suppkey").alias("vehicle_id"), F.col("l_returnflag").alias("period"), F.when(F.col("l_linenumber") % 2 == 1, "ac_dc").otherwise("soc_estimate").alias("energy_source"), (256 + whole).alias("capacity_kwh"), (whole - 25).alias("delta_soc"))
    was = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("vehicle_id"), F.explode(F.array(F.lit("A"), F.lit("X"))).alias("period"), F.lit(300.0).alias("kwh"), F.lit(7).cast("long").alias("n"))
    return report.backfilled(was, rows).select("vehicle_id", "period", F.round(F.col("kwh") * 10).cast("long").alias("kwh_tenths"), "n")
