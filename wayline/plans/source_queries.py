"""Queries of sources and stores, and the same in SQL. What they read they first write from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import sequence
from ..sources import daily, ledger, pages
from ..sources.fixture_tables import telematics
from ..sources.store import shared_folder
from .queries import TELEMATICS_SQL, TRIPS_SQL, _ledger, query, shown, trips_of

LEGS_SQL = "SELECT o_custkey AS vehicle_id, o_orderkey AS leg_id, epoch_us(o_orderdate) AS start_us, o_totalprice AS km FROM orders"


def fresh_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _paged(spark, d) -> str:
    folder = fresh_folder(spark, "pages")
    orders = spark.read.parquet(f"{d}/orders.parquet")
    legs = orders.select(F.col("o_custkey").alias("vehicle_id"), F.col("o_orderkey").alias("leg_id"), F.col("o_orderdate").cast("timestamp").alias("start_ts"), F.col("o_totalprice").alias("km"))
    pages.write_pages(legs, folder, 2_000, ["vehicle_id", "start_ts"])
    return folder


@query("src2_paged_records", LEGS_SQL)
def _(spark, d):
    return shown(pages.read_pages(spark, _paged(spark, d)), "vehicle_id", "leg_id", "start_ts", "km")


@query("src1_fetch_legs", f"{LEGS_SQL} WHERE o_custkey BETWEEN 20 AND 60 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1994-03-01' AND DATE '1996-08-31'")
def _(spark, d):
    from ..sources.telematics import legs_between

    legs = pages.read_pages(spark, _paged(spark, d)).where(F.col("vehicle_id").between(20, 60))
    return shown(legs_between(legs, "1994-03-01", "1996-08-31"), "vehicle_id", "leg_id", "start_ts", "km")


def chain_sql(rows: str, keys: str, least_us: int) -> list[str]:
    """``kept``: the greedy chain over ``rows``, by recursion; ``rows`` has ``keys``, us and row_no."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    own = ", ".join(f"a.{k}" for k in keys.split(", "))
    return [
        f"once AS (SELECT {keys}, us, min(row_no) AS row_no FROM {rows} GROUP BY {keys}, us)",
        f"hops AS (SELECT {own}, a.us, min(b.us) AS next_us, arg_min(b.row_no, b.us) AS next_row FROM once a JOIN once b ON {on} AND a.us + {least_us} <= b.us GROUP BY {own}, a.us)",
        f"kept AS (SELECT {keys}, min(us) AS us, arg_min(row_no, us) AS row_no FROM once GROUP BY {keys} UNION ALL SELECT {own}, b.next_us, b.next_row FROM kept a JOIN hops b ON {on} AND a.us = b.us)",
    ]


@query("n16_downsample", "RECURSIVE " + TELEMATICS_SQL.strip(), *chain_sql("t", "vehicle_id", 86_400_000_000), "SELECT vehicle_id, row_no FROM kept")
def _(spark, d):
    return sequence.downsample(telematics(spark, d), 86_400).select("vehicle_id", "row_no")


#: Raw texts: a satellite position on even rows, that isn't a number on some, and a plain one on most.
RAW_SQL = """ps AS (SELECT * FROM (SELECT vehicle_id, row_no, us, coalesce(CASE WHEN row_no % 2 = 0 AND row_no % 10 > 0 THEN 51 + (row_no % 64) / 64.0 END, CASE WHEN row_no % 3 > 0 THEN 50 + (row_no % 100) / 128.0 END) AS lat, coalesce(CASE WHEN row_no % 4 = 0 THEN (row_no % 32) / 64.0 END, CASE WHEN row_no % 3 > 0 THEN (row_no % 77) / 128.0 END) AS lon FROM t) WHERE lat IS NOT NULL AND lon IS NOT NULL AND us BETWEEN epoch_us(TIMESTAMP '2024-01-08') AND epoch_us(TIMESTAMP '2024-01-22') - 1)"""


@query("src11_trip_positions", "RECURSIVE " + TRIPS_SQL.strip(), RAW_SQL, "ins AS (SELECT trips.vehicle_id, seg, us, row_no, lat, lon FROM trips JOIN ps ON ps.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us)", *chain_sql("ins", "vehicle_id, seg", 21_600_000_000), "SELECT vehicle_id, seg, row_no, us, lat, lon FROM kept JOIN ins USING (vehicle_id, seg, row_no, us)")
def _(spark, d):
    rows, n = telematics(spark, d), F.col("row_no")
    text = lambda wanted, value: F.when(wanted, value.cast("string"))
    raw = rows.select(
        "vehicle_id", "row_no", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("eventDatetime"), F.when((n % 10 == 0), "n/a").otherwise(text(n % 2 == 0, 51 + (n % 64) / 64.0)).alias("gnss_latitude"), text(n % 4 == 0, (n % 32) / 64.0).alias("gnss_longitude"),
        text(n % 3 > 0, 50 + (n % 100) / 128.0).alias("latitude"), text(n % 3 > 0, (n % 77) / 128.0).alias("longitude"))
    folder = fresh_folder(spark, "daily")
    daily.write_daily(raw, folder)
    places = daily.daily_positions(spark, folder, "2024-01-08", "2024-01-21")
    found = daily.trip_positions(trips_of(rows), places, 21_600)
    return shown(found.withColumn("us_ts", F.col("ts")), "vehicle_id", "seg", "row_no", "us_ts", "lat", "lon").withColumnRenamed("us_us", "us")


LEDGER_TABLE_SQL = "l AS (SELECT o_custkey AS vehicle_id, o_orderstatus || o_orderpriority AS period, CAST(max(o_orderkey) + 1 AS DOUBLE) AS kwh, count(*) AS n FROM orders GROUP BY 1, 2)"


@query("l4_ledger_table", LEDGER_TABLE_SQL, "SELECT vehicle_id, period, CASE WHEN period LIKE 'O%' THEN kwh + 1 ELSE kwh END AS kwh, CASE WHEN period LIKE 'O%' THEN n + 2 ELSE n END AS n FROM l")
def _(spark, d):
    """Three commits: some periods, the others, and one that overlaps both; then the last version."""
    rows = _ledger(spark, d).withColumn("kwh", F.col("kwh") + 1)
    schema, path = ledger.ledger_schema(rows.schema["vehicle_id"].dataType), fresh_folder(spark, "ledger")
    for part in (rows.where("period like 'F%'"), rows.where("period not like 'F%'"), rows.where("period like 'O%'").selectExpr("vehicle_id", "period", "kwh + 1 as kwh", "n + 2 as n")):
        ledger.update_ledger(spark, path, part, schema)
    return ledger.read_ledger(spark, path, schema)
