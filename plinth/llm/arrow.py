"""Arrow batches in and out of Python functions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


#: Bytes of a batch, unless the session names its own; Spark's are 64 MB, and the JVM's buffers double until they hold them.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def struct_of(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some rows, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def given_back() -> None:
    """Returns to the system what this process has freed; else each worker that waits for a task holds the most that any of its tasks took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """`df.mapInArrow(run, schema)` by batches of bounded size, after which a task gives back its memory."""
    if df.sparkSession.conf.get(BATCH[0], None) is None:
        df.sparkSession.conf.set(*BATCH)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        given_back()

    return df.mapInArrow(whole, schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[[list], list]], schema: str) -> DataFrame:
    """`df` through a function from a batch's columns (lists) to the result's columns, made once in each task by `make`."""
    target = struct_of(schema)
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in sliced(batches):
            columns = work([c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return map_batches(df, run, target)
