"""Helpers that every training-data operator shares."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BROADCAST_ROWS = 500_000  # of a few numbers each


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``; a folder of its own
    only where a local session names none, as in tests. On a cluster one must be named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="wayline-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and go on from the copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later steps read only the columns they use."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a narrow table that is already written, to be broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finite(column: str = "embedding") -> Column:
    """Whether a vector is there and all its components are, and are finite."""
    return F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def floors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """floor(256 * x) of every component x of vectors of one width, as float64, which holds it exactly."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = len(column[0]) if len(column) else 0
    return np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(column), width)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, or with underscores before it one that no column has."""
    while name.lower() in (c.lower() for c in columns):
        name = "_" + name
    return name


def hex_sha256(column: Column) -> Column:
    return F.sha2(column, 256)


def scaled_partitions(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for ``rows`` rows: at least the session's, more when the data asks for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def giving_back(run: Callable) -> Callable:
    """``run``, a function of batches, that gives freed memory back to the system at its end: Python
    workers live on and serve later stages beside the executor's heap."""

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def map_texts(df: DataFrame, keep: Sequence[str], column: str, run: Callable[[list], list], schema: str) -> DataFrame:
    """The ``keep`` columns and those of ``schema``, which ``run`` makes, as one list each,
    from the values of ``column`` of each Arrow batch (None for null)."""
    kept = [df.schema[name] for name in keep]
    made = T._parse_datatype_string(schema).fields
    out = to_arrow_schema(T.StructType(made))

    def batches(rows):
        for batch in rows:
            values = run(batch.column(batch.num_columns - 1).to_pylist())
            arrays = [pa.array(v, out.field(i).type) for i, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *out.names])

    source = df.select(*keep, F.col(column).alias("__in"))
    return source.mapInArrow(giving_back(batches), T.StructType([*kept, *made]))
