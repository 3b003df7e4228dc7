"""Raw payloads and settings over the supplied tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import raw, settings
from ..sources.telematics import number
from .queries import query
from .source_queries import fresh_folder

EVENTS_SQL = "SELECT user_id AS vehicle_id, event_id, epoch_us(ts) AS us, event_type, CAST(floor(value) AS BIGINT) AS value FROM events"


def _lines(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.select(F.col("user_id").alias("vehicle_id"), "event_id", F.col("ts"), "event_type", F.floor("value").cast("string").alias("value"))


@query("m5_chunked_csv", EVENTS_SQL)
def _(spark, d):
    """Each user's events as a CSV text whose columns stand in one of two orders, cut into pieces of 97 characters, some sent twice."""
    rows, even = _lines(spark, d), F.col("vehicle_id") % 2 == 0
    us = F.unix_micros("ts").cast("string")
    line = F.when(even, F.concat_ws(",", F.col("event_id").cast("string"), us, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), "value")).otherwise(F.concat_ws(",", "value", "event_type", F.lit("x"), us, F.col("event_id").cast("string")))
    header = F.when(even, "id,us,type,value\n").otherwise("value,type,other,us,id\n")
    texts = rows.groupBy("vehicle_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("body")).withColumn("text", F.concat(header, "body"))
    size = 97
    cut = texts.select("vehicle_id", "text", F.explode(F.sequence(F.lit(0), ((F.length("text") - 1) / size).cast("int"))).alias("piece")).select("vehicle_id", "piece", F.substring(F.col("text"), F.col("piece") * size + 1, F.lit(size)).alias("text"))
    sent = cut.unionByName(cut.where("piece % 5 = 0"))
    whole = raw.assembled(sent, ["vehicle_id"]).where("complete")
    found = raw.csv_rows(whole, ["vehicle_id"], ["id", "us", "type", "value"], most_columns=8)
    return found.select("vehicle_id", F.col("id").cast("long").alias("event_id"), F.col("us").cast("long").alias("us"), F.col("type").alias("event_type"), F.col("value").cast("long").alias("value"))


@query("src3_raw_cache", "SELECT user_id AS vehicle_id, event_id, epoch_us(ts) AS us, CAST(floor(value) AS BIGINT) AS value FROM events WHERE user_id % 3 < 2")
def _(spark, d):
    """Two reads through one table: users of one kind, then of two; the second fetches only what is new."""
    rows, path = _lines(spark, d).withColumn("leg_id", F.lit(0)), fresh_folder(spark, "bronze")
    keys = ["vehicle_id", "leg_id"]
    fetch = lambda missing: rows.join(missing, keys, "left_semi")
    legs = rows.select(*keys).distinct()
    raw.read_through(legs.where("vehicle_id % 3 = 0"), path, fetch)
    found = raw.read_through(legs.where("vehicle_id % 3 < 2"), path, fetch)
    return found.select("vehicle_id", "event_id", F.unix_micros("ts").alias("us"), number(F.col("value")).cast("long").alias("value"))


@query("snk7_raw_dump", """WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, CASE WHEN event_id % 5 = 0 THEN 1 WHEN event_id % 5 = 1 THEN 0 WHEN event_id % 5 = 2 THEN NULL ELSE floor(value) END AS flag, floor(value) AS value, min(ts) OVER (PARTITION BY user_id) AS t0 FROM events)
    SELECT user_id AS vehicle_id, us, CAST(flag AS DOUBLE) AS flag, CAST(value AS DOUBLE) AS value, CASE user_id % 3 WHEN 0 THEN 'raw_logger' WHEN 1 THEN 'raw_logger_v1' ELSE 'raw_logger_v2b' END AS version, strftime(t0, '%Y-%m-%d') AS leg_date FROM x""")
def _(spark, d):
    rows, k, path = _lines(spark, d), F.col("event_id"), fresh_folder(spark, "dump")
    flag = F.when(k % 5 == 0, F.when(k % 2 == 0, "true").otherwise("TRUE")).when(k % 5 == 1, F.when(k % 2 == 0, "False").otherwise("false")).when(k % 5 == 2, "tRuE").otherwise(F.col("value"))
    source = F.when(F.col("vehicle_id") % 3 == 0, "SRFLOGGER").when(F.col("vehicle_id") % 3 == 1, "SRFLOGGER_V1").otherwise("SRFLOGGER_V2b_")
    raw.dump_logger(rows.select("vehicle_id", F.lit(0).alias("leg_id"), source.alias("source"), "ts", flag.alias("flag"), "value"), path, ["flag", "value"])
    found = spark.read.parquet(path)
    return found.select("vehicle_id", F.unix_micros("ts").alias("us"), "flag", "value", "version", F.date_format("leg_date", "yyyy-MM-dd").alias("leg_date"))


#: A pipeline's text for each customer, by the customer's number, and what is wrong with it.
PIPELINES = [
    ('{"soc_event_spike_pct": 3.5, "speed_params": {"keep_trips_outside_cap_band": true}}', None),
    ('{"soc_event_spike_pct": 0}', "soc_event_spike_pct must be a positive number"),
    ('{"soc_event_spike_pct": "3"}', "soc_event_spike_pct must be a positive number"),
    ('{"soc_event_spike_pct": null}', "soc_event_spike_pct must be a positive number"),
    ('{"speed_params": {"keep_trips_outside_cap_band": 1}}', "speed_params.keep_trips_outside_cap_band must be true or false"),
    ('{"keep_odometer_confirmed_trips": true}', "keep_odometer_confirmed_trips belongs in speed_params, not at the top level"),
    ('{"charge_params": {"min_confirmed_distance_km": 1}}', "min_confirmed_distance_km belongs in speed_params, not in charge_params"),
    ('{"discharge_params": {"soc_event_spike_pct": 3}}', "soc_event_spike_pct belongs at the top level, not in discharge_params"),
    ('{"soc_event_spike_pct": ', "is no JSON"),
    ("[1, 2]", None),
    ('{"other": {"soc_event_spike_pct": "x"}}', None),
]
PIPELINE_SQL = "SELECT c_custkey AS name, CASE c_custkey % 11 " + " ".join(f"WHEN {i} THEN '{e}'" for i, (_, e) in enumerate(PIPELINES) if e) + " END AS error FROM customer WHERE c_custkey % 11 IN (" + ", ".join(str(i) for i, (_, e) in enumerate(PIPELINES) if e) + ")"


@query("f13_pipeline_errors", PIPELINE_SQL)
def _(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("name"))
    text = F.element_at(F.array(*(F.lit(t) for t, _ in PIPELINES)), (F.col("name") % 11 + 1).cast("int"))
    return settings.pipeline_errors(customers.withColumn("json", text)).select("name", "error")


@query("f13_override_errors", """SELECT c_custkey AS vehicle_id, CASE WHEN c_custkey % 5 = 1 THEN 1 ELSE 0 END AS place, CASE c_custkey % 5 WHEN 1 THEN 'overlaps override 0' WHEN 2 THEN '''to'' must be after ''from''' WHEN 3 THEN 'no such pipeline: p' || c_custkey ELSE '''set'' may not change nominal_kwh' END AS error FROM customer WHERE c_custkey % 5 > 0
    UNION ALL SELECT c_custkey, -1, 'period_overrides are not for diesel vehicles' FROM customer WHERE c_custkey % 7 = 0""")
def _(spark, d):
    k = F.col("c_custkey")
    customers = spark.read.parquet(f"{d}/customer.parquet")
    window = lambda a, b, what: F.concat(F.lit(f'{{"from": "{a}", "to": "{b}", "set": {{'), what, F.lit("}}"))
    good = F.lit('"split_by_mass": false')
    second = F.when(k % 5 == 1, window("2024-02-01", "2024-04-01", good)).otherwise(window("2024-03-01", "2024-04-01", good))
    first = F.when(k % 5 == 2, window("2024-03-01", "2024-03-01", good)).when(k % 5 == 3, window("2024-01-01", "2024-03-01", F.concat(F.lit('"pipeline": "p'), k.cast("string"), F.lit('"')))).when(k % 5 == 4, window("2024-01-01", "2024-03-01", F.lit('"nominal_kwh": 1'))).otherwise(window("2024-01-01", "2024-03-01", good))
    json = F.concat(F.when(k % 7 == 0, '{"fuel_type": "diesel", ').otherwise("{"), F.lit('"period_overrides": ['), first, F.lit(", "), second, F.lit("]}"))
    return settings.override_errors(customers.select(k.alias("vehicle_id"), json.alias("json")), customers.select(F.lit("default").alias("name")).distinct())
