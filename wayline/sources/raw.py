"""Raw payloads: put together from pieces, kept once in a table of their own, and dumped as numbers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import written
from .telematics import number

MOST_COLUMNS = 128


def assembled(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, payload, complete`` of pieces (keys, piece, text) put end to end by number, each once; not complete if a number is missing."""
    numbered = F.array_sort(F.collect_set(F.struct("piece", "text")))
    once = pieces.groupBy(*keys, "piece").agg(F.min("text").alias("text"))
    whole = once.groupBy(*keys).agg(numbered.alias("all"), (F.max("piece") - F.min("piece") + 1 == F.count("*")).alias("complete"))
    return whole.select(*keys, F.array_join(F.transform("all", lambda x: x["text"]), "").alias("payload"), "complete")


def csv_rows(payloads: DataFrame, keys: Sequence[str], columns: Sequence[str], most_columns: int = MOST_COLUMNS) -> DataFrame:
    """``keys, row_no`` and ``columns`` as text, of CSV payloads each with a header of its own; a column that a header lacks is null.

    Cells may be quoted but not hold line breaks. Rows are numbered from 0; blank lines don't count.
    """
    lines = F.filter(F.split(F.regexp_replace("payload", "^﻿", ""), "\r?\n"), lambda line: F.trim(line) != "")
    rows = payloads.select(*keys, lines.alias("lines")).where(F.size("lines") > 0).withColumn("header", F.get("lines", F.lit(0)))
    rows = rows.select(*keys, "header", F.posexplode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("row_no", "line"))
    parse = lambda c: F.from_csv(F.col(c), ", ".join(f"c{i} string" for i in range(most_columns)), {"escape": '"'})
    parsed = rows.withColumns({"h": parse("header"), "r": parse("line")})
    as_array = lambda c: F.array(*(F.col(f"{c}.c{i}") for i in range(most_columns)))
    parsed = parsed.select(*keys, "row_no", as_array("h").alias("h"), as_array("r").alias("r"))
    value = lambda name: F.get("r", F.nullif(F.array_position("h", F.lit(name)), F.lit(0).cast("long")).cast("int") - 1)
    return parsed.select(*keys, F.col("row_no").cast("long").alias("row_no"), *(value(c).alias(c) for c in columns))


def read_through(wanted: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame], keys: Sequence[str] = ("vehicle_id", "leg_id")) -> DataFrame:
    """The raw rows of the ``wanted`` keys from the table at ``path``; keys that it hasn't are fetched and appended first.

    ``fetch`` gets the missing keys and gives their rows. A key counts as kept once its batch is
    written, also if it has no rows; with nothing missing, nothing is fetched or written. If
    two writers fetch one key, the rows of the first batch by name count.
    """
    spark, keys = wanted.sparkSession, list(keys)
    asked = wanted.select(*keys).distinct()
    kept = _kept(spark, path, asked, keys)
    missing = written(asked.join(kept, keys, "left_anti"))
    if missing.limit(1).count():
        batch = uuid.uuid4().hex
        rows = fetch(missing).withColumn("batch", F.lit(batch))
        rows.write.mode("append").partitionBy("batch").parquet(f"{path}/rows")
        missing.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{path}/keys")
        kept = _kept(spark, path, asked, keys)
    return spark.read.parquet(f"{path}/rows").join(kept, [*keys, "batch"], "left_semi").drop("batch")


def _kept(spark: SparkSession, path: str, asked: DataFrame, keys: list[str]) -> DataFrame:
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/keys/_SUCCESS")
    if not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
        return asked.limit(0).withColumn("batch", F.lit(""))
    return spark.read.parquet(f"{path}/keys").join(asked, keys, "left_semi").groupBy(*keys).agg(F.min("batch").alias("batch"))


def logger_number(text: Column) -> Column:
    """A logger's text as a number: true is 1, false 0 (three spellings each); null if it is neither."""
    return F.when(text.isin("true", "True", "TRUE"), 1.0).when(text.isin("false", "False", "FALSE"), 0.0).otherwise(number(text))


def dump_folder(source: Column) -> Column:
    """``raw_logger`` with the version that a source's name ends in, in small letters."""
    version = F.lower(F.trim(F.replace(source, F.lit("SRFLOGGER"), F.lit("")), F.lit("_")))
    return F.when(version == "", "raw_logger").otherwise(F.concat(F.lit("raw_logger_"), version))


def dump_logger(rows: DataFrame, path: str, channels: Sequence[str]) -> None:
    """Logger rows (vehicle_id, leg_id, source, ts, channels as text) as numbers, in a folder for each version and leg date."""
    first = F.to_date(F.min("ts"))
    dates = rows.groupBy("vehicle_id", "leg_id", "source").agg(first.alias("leg_date"))
    ready = rows.join(dates, ["vehicle_id", "leg_id", "source"]).withColumn("version", dump_folder(F.col("source")))
    ready.select("vehicle_id", "leg_id", "ts", *(logger_number(F.col(c)).alias(c) for c in channels), "version", "leg_date").write.partitionBy("version", "leg_date").parquet(path)
