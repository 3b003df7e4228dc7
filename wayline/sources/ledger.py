"""The capacity ledger as a table of versions: writers can't lose each other's updates.

A version is a Parquet folder that is complete before it counts; it counts once a commit file
with its number exists, which names the folder. A commit file is made only if there is
none of that number, so of two writers that start from one version one succeeds and the
other is told, reads again and redoes its update. Readers take the largest commit.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.capacity import upsert_ledger

KEEP_TRYING = 20


class LedgerConflict(RuntimeError):
    """Another writer has committed this version."""


def _folder(spark: SparkSession, path: str):
    """The JVM's file system and the commit folder's path."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the last commit; 0 if there is no ledger."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)


def _commit(spark: SparkSession, path: str, version: int, content: str) -> None:
    fs, folder = _folder(spark, path)
    fs.mkdirs(folder)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{version:012d}.json")
    if fs.getScheme() == "file":
        try:  # the operating system makes a new file or fails, whoever else tries
            with open(os.open(target.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644), "w") as f:
                f.write(content)
        except FileExistsError:
            raise LedgerConflict(f"version {version} of {path} is there already") from None
        return
    try:
        out = fs.create(target, False)
    except Exception as error:
        if fs.exists(target):
            raise LedgerConflict(f"version {version} of {path} is there already") from error
        raise
    out.write(bytearray(content.encode()))
    out.close()


def _read_commit(spark: SparkSession, path: str, version: int) -> dict:
    text = "".join(r.value for r in spark.read.text(f"{path}/commits/{version:012d}.json").collect())
    return json.loads(text)


def ledger_schema(vehicle: T.DataType | None = None, period: T.DataType | None = None) -> T.StructType:
    return T.StructType([T.StructField("vehicle_id", vehicle or T.StringType()), T.StructField("period", period or T.StringType()), T.StructField("kwh", T.DoubleType()), T.StructField("n", T.LongType())])


def read_ledger(spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """The ledger's rows at a version, the last one if none is given. A ledger that isn't there or was committed
    empty has no rows; one of another shape is an error, as is an entry without vehicle or period, or two of one period."""
    schema = schema or ledger_schema()
    version = current_version(spark, path) if version is None else version
    if version == 0:
        return spark.createDataFrame([], schema)
    commit = _read_commit(spark, path, version)
    if commit.get("folder") is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(f"{path}/{commit['folder']}")
    found = {f.name: f.dataType for f in rows.schema}
    wanted = {f.name: f.dataType for f in schema}
    if found != wanted:
        raise ValueError(f"the ledger at {path} has the columns {found}, not {wanted}")
    return rows


def check_entries(rows: DataFrame) -> None:
    bad = rows.where("vehicle_id is null or period is null or n < 0 or kwh <= 0").limit(1).collect()
    if bad:
        raise ValueError(f"no ledger entry: {bad[0]}")
    twice = rows.groupBy("vehicle_id", "period").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two entries of one period: {twice[0]}")


def commit_ledger(rows: DataFrame, path: str, based_on: int) -> int:
    """``rows`` as the version after ``based_on``; a conflict if another writer was first. Gives the new number."""
    spark = rows.sparkSession
    rows = rows.select("vehicle_id", "period", rows["kwh"].cast("double").alias("kwh"), rows["n"].cast("long").alias("n"))
    folder = f"versions/{based_on + 1:012d}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    check_entries(spark.read.parquet(f"{path}/{folder}"))
    _commit(spark, path, based_on + 1, json.dumps({"folder": folder}))
    return based_on + 1


def update_ledger(spark: SparkSession, path: str, periods: DataFrame, schema: T.StructType | None = None, before_commit: Callable[[], None] = lambda: None) -> int:
    """Merge ``periods`` into the ledger; where another writer commits first, into what that one left."""
    for _ in range(KEEP_TRYING):
        version = current_version(spark, path)
        merged = upsert_ledger(read_ledger(spark, path, schema, version), periods)
        before_commit()
        try:
            return commit_ledger(merged, path, version)
        except LedgerConflict:
            continue
    raise LedgerConflict(f"{KEEP_TRYING} other writers were first at {path}")
