"""Tables that a long plan goes on from."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session that names none, as in tests, gets one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="wayline-checkpoint-"))
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so that what follows is a plan of its own."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder by columns, for what is read many times and mostly a few columns of."""
    if any(f.dataType.typeName() == "void" for f in df.schema):
        return written(df)  # a column of no type has no place in a file
    path = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
