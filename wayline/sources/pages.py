"""Records that a server hands out page by page, as a Spark data source: one partition a page.

A page folder holds one Parquet file for each page and, in ``index/``, what each page spans: the
least and largest value of the indexed columns. A reader prunes pages by the filters
that Spark pushes down, before any page is fetched; Spark applies the filters to the rows
again, so an index only ever saves work. Pages are fetched by the tasks, through
``pyarrow.fs``, which knows local paths and the common remote stores.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

FORMAT = "paged_records"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Page(InputPartition):
    file: str
    bounds: dict[str, tuple]

    def may_hold(self, asked: Filter) -> bool:
        """False only where no row of the page can pass the filter."""
        if len(asked.attribute) != 1 or asked.attribute[0] not in self.bounds:
            return True
        low, high = self.bounds[asked.attribute[0]]
        if low is None:
            return False  # all null, which no comparison lets through
        match asked:
            case EqualTo():
                return low <= asked.value <= high
            case In():
                return any(v is not None and low <= v <= high for v in asked.value)
            case GreaterThan():
                return high > asked.value
            case GreaterThanOrEqual():
                return high >= asked.value
            case LessThan():
                return low < asked.value
            case LessThanOrEqual():
                return low <= asked.value
        return True


def open_store(path: str):
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


class PageReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        fs, root = open_store(path)
        table = pq.read_table(f"{root}/index", filesystem=fs)
        names = [c.removeprefix("low_") for c in table.column_names if c.startswith("low_")]
        self.path, self.names, self.arrow = path, schema.fieldNames(), to_arrow_schema(schema)
        self.pages = [Page(row["file"], {c: (row[f"low_{c}"], row[f"high_{c}"]) for c in names}) for row in table.to_pylist()]

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for asked in filters:
            if isinstance(asked, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                asked = _plain(asked)
                self.pages = [page for page in self.pages if page.may_hold(asked)]
        return filters  # a page holds other rows as well

    def partitions(self) -> Sequence[InputPartition]:
        return self.pages or [Page("", {})]

    def read(self, page: Page) -> Iterator:
        if page.file:
            fs, root = open_store(self.path)
            file = pq.ParquetFile(fs.open_input_file(f"{root}/pages/{page.file}"), coerce_int96_timestamp_unit="us")
            for batch in file.iter_batches(columns=self.names):
                yield from pa.Table.from_batches([batch]).cast(self.arrow).to_batches()


def _plain(asked: Filter) -> Filter:
    """Times without a zone, as the index has them."""
    bare = lambda v: v.replace(tzinfo=None) if isinstance(v, datetime) else v
    value = tuple(map(bare, asked.value)) if isinstance(asked, In) else bare(asked.value)
    return type(asked)(asked.attribute, value)


class PagedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        fs, root = open_store(self.options["path"])
        with fs.open_input_file(f"{root}/schema.json") as f:
            return T.StructType.fromJson(json.loads(f.read()))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(self.options["path"], schema)


def write_pages(rows: DataFrame, path: str, page_rows: int, indexed: Sequence[str]) -> None:
    """``rows`` as pages of about ``page_rows`` in the order of ``indexed``, with the index over these columns."""
    pages = max(1, -(-rows.count() // page_rows))
    rows.repartitionByRange(pages, *indexed).sortWithinPartitions(*indexed).write.mode("overwrite").parquet(f"{path}/pages")
    written = rows.sparkSession.read.parquet(f"{path}/pages")
    bare = lambda c: F.col(c).cast("timestamp_ntz") if isinstance(rows.schema[c].dataType, T.TimestampType) else F.col(c)
    spans = [f(bare(c)).alias(f"{name}_{c}") for c in indexed for name, f in (("low", F.min), ("high", F.max))]
    index = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(*spans)
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")
    fs, root = open_store(path)
    with fs.open_output_stream(f"{root}/schema.json") as f:
        f.write(rows.schema.json().encode())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The records of a page folder; filters on indexed columns prune its pages."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(PagedRecords)
    return spark.read.format(FORMAT).option("path", path).load()


def fetch_legs(spark: SparkSession, path: str, vehicle_id, first_day: str, last_day: str) -> DataFrame:
    """A vehicle's legs that start on the days from first to last, both included, by start."""
    from .telematics import legs_between

    legs = read_pages(spark, path).where(F.col("vehicle_id") == vehicle_id)
    return legs_between(legs, first_day, last_day).orderBy("start_ts")
