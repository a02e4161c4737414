"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from catalogflow.session import shared_dir

# Set while a table is written: shuffle files go when the write ends, and batches for Python are small, since the JVM and the Python
# worker of each task hold one of them several times over.
_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **_BATCH}
SLICE = 256  # rows that are Python objects at the same time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that the driver and all executors can reach."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later stages read the files, so a lost executor costs no recomputation, and Spark knows the
    table's size when it chooses a join. The shuffle files of the write are of no use once it has ended, so
    Spark is told to remove them then, and a job of many steps holds those of one step at a time.
    """
    path, conf = folder(df.sparkSession, purpose), df.sparkSession.conf
    before = {key: conf.get(key) for key in _WRITING}
    for key, value in _WRITING.items():
        conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """For the rest of the session rows go to Python in batches as small as in ``stored``."""
    for key, value in _BATCH.items():
        spark.conf.set(key, value)


def by_batch(df: DataFrame, schema: str, arrow: pa.Schema, rows: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """Run ``rows`` over the rows of each partition, which are Python objects only a slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    yield from zip(*(column.to_pylist() for column in part.columns))

        out: list[tuple] = []
        for row in rows(incoming()):
            out.append(row)
            if len(out) >= 2048:
                yield to_batch(out, arrow)
                out = []
        if out:
            yield to_batch(out, arrow)
        out = []
        given_back(None)

    return df.mapInArrow(run, schema)


def given_back(result):
    """``result``, after memory freed while it was made has gone back to the system: the worker process lives on and serves later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass
    return result


def to_batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
