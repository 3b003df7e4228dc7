"""Raw telematics by day: files found and their headers probed by path, positions cut out for trips."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import in_interval
from ..operators.sequence import downsample
from .pages import open_store
from .telematics import number

#: The name of a day's raw file, the time column, and the position columns, best first.
RAW_FILE = r"^raw_(\d{4}-\d{2}-\d{2})_\d+\.csv$"
TIME = "eventDatetime"
LATITUDES, LONGITUDES = ("gnss_latitude", "latitude"), ("gnss_longitude", "longitude")
#: The name of a report file, and what it is skipped for.
REPORT_FILE = r"^(?<registration>[A-Za-z0-9]+)_(?<start>\d{4}-\d{2}-\d{2})_(?<end>\d{4}-\d{2}-\d{2})\.(?:xlsx|parquet|csv)$"
SKIPPED = ("_finetuned", "dashboard")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, name, bytes, changed`` of the files below a folder; their contents aren't read, and
    empty files aren't listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, registration, start_day, end_day`` of report files by their strict names, whatever folders they lie in;
    fine-tuned ones, dashboards and names with impossible dates are no reports."""
    part = lambda i: F.regexp_extract("name", REPORT_FILE, i)
    found = list_files(spark, folder).where(F.col("name").rlike(REPORT_FILE))
    for word in SKIPPED:
        found = found.where(~F.lower("path").contains(word))
    day = lambda i: part(i).try_cast("date")
    found = found.select("path", F.upper(part(1)).alias("registration"), day(2).alias("start_day"), day(3).alias("end_day"))
    return found.where(F.col("start_day").isNotNull() & F.col("end_day").isNotNull() & (F.col("start_day") <= F.col("end_day")))


def file_headers(files: DataFrame, most_bytes: int = 1 << 20) -> DataFrame:
    """``path, columns`` of CSV files (``path``): only the first line of each is fetched; a blank one has no columns."""

    def probe(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            headers = []
            for path in paths:
                fs, at = open_store(path)
                with fs.open_input_stream(at) as f:
                    line = f.read(most_bytes).split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")
                headers.append(next(csv.reader(io.StringIO(line)), []) if line else [])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(headers, pa.list_(pa.string()))], names=["path", "columns"])

    return files.select("path").mapInArrow(probe, "path string, columns array<string>")


def _first_known(names: Sequence[str], columns: Sequence[str]) -> Column:
    there = [number(F.col(c)) for c in names if c in columns]
    return F.coalesce(*there) if there else F.lit(None).cast("double")


def positions(raw: DataFrame, keep: Sequence[str] = ("vehicle_id", "row_no")) -> DataFrame:
    """``keep, ts, lat, lon`` of raw text rows: the satellite's position if it is a number, else the plain one,
    for each of both; rows without time or place go."""
    found = raw.select(*keep, F.try_to_timestamp(F.col(TIME).cast("string")).alias("ts"), _first_known(LATITUDES, raw.columns).alias("lat"), _first_known(LONGITUDES, raw.columns).alias("lon"))
    return found.where(F.col("ts").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())


def read_raw_files(spark: SparkSession, folder: str, first_day: str, last_day: str) -> DataFrame:
    """Positions ``source_file, ts, lat, lon`` of the day files from first to last day, both included.

    Days are taken by the files' names, so no other file is opened. Files differ in their
    columns: those of one header are read together, and a header without time or place
    gives nothing. There are as many reads as there are headers, which are few.
    """
    day = F.regexp_extract("name", RAW_FILE, 1)
    files = list_files(spark, folder, "raw_*.csv").where(F.col("name").rlike(RAW_FILE) & day.between(first_day, last_day))
    headers = file_headers(files).groupBy("columns").agg(F.collect_list("path").alias("paths")).collect()
    found = spark.createDataFrame([], "source_file string, ts timestamp, lat double, lon double")
    for header in sorted(headers, key=lambda h: h["columns"]):
        columns = header["columns"]
        if TIME in columns and set(columns) & set(LATITUDES) and set(columns) & set(LONGITUDES):
            raw = spark.read.csv(header["paths"], header=True, inferSchema=False).withColumn("source_file", F.col("_metadata.file_name"))
            found = found.unionByName(positions(raw, ["source_file"]))
    return found


def write_daily(raw: DataFrame, path: str) -> None:
    """Raw text rows (vehicle_id, row_no, time, signals) as a table with a folder for each UTC day."""
    raw.withColumn("day", F.to_date(F.try_to_timestamp(F.col(TIME)))).where("day is not null").write.partitionBy("day").parquet(path)


def daily_positions(spark: SparkSession, path: str, first_day: str, last_day: str) -> DataFrame:
    """The positions of the days from first to last; the folders of other days aren't read."""
    days = F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return positions(spark.read.parquet(path).where(days))


def trip_positions(trips: DataFrame, places: DataFrame, least_seconds: float) -> DataFrame:
    """``vehicle_id, seg, row_no, ts, lat, lon``: the positions inside each trip (start_ts to end_ts), thinned out to one
    every ``least_seconds`` from the trip's first one on."""
    windows = trips.select("vehicle_id", F.col("seg").alias("leg_id"), "start_ts", "end_ts")
    samples = places.join(trips.select("vehicle_id").distinct(), "vehicle_id", "left_semi").withColumn("leg_id", F.lit(0))
    inside = in_interval(samples, windows.withColumn("seg", F.col("leg_id")).withColumn("leg_id", F.lit(0)), ["seg"])
    inside = inside.select("vehicle_id", F.col("seg").alias("leg_id"), "row_no", "ts", "lat", "lon")
    kept = downsample(inside, least_seconds)
    return inside.join(kept.select("vehicle_id", "leg_id", "row_no"), ["vehicle_id", "leg_id", "row_no"], "left_semi").withColumnRenamed("leg_id", "seg")
