"""Incremental jobs on Structured Streaming.

Each job reads new files only (``availableNow``), keeps its progress in a checkpoint folder,
and can be started again at any time. Batches are written under their batch number, so a batch
that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.functions.keys import identity_columns
from catalogflow.operators.logs import ledger_latest
from catalogflow.operators.ordering import first_occurrence


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def incremental_intake(stream: DataFrame, accepted: str, checkpoint: str, mode: str = "mpn_brand", ord: str = "ord", **cols: str):
    """Rows whose identity was not accepted before, first occurrence kept.

    The accepted table itself is the memory (one folder per batch), not operator state, so the
    job is exact over any time span and a batch that runs twice leaves the same rows.
    """
    keys = identity_columns(mode, **cols)
    names = [f"_k{i}" for i in range(len(keys))]

    def accept(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumns(dict(zip(names, keys)))
        fresh = first_occurrence(rows, names, ord)
        if _exists(spark, accepted):
            known = spark.read.parquet(accepted).where(F.col("batch") != number).withColumns(dict(zip(names, keys))).select(*names).distinct()
            fresh = fresh.join(known, names, "left_anti")
        fresh.drop(*names).withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(accepted)

    return stream.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def intake_bounded(stream: DataFrame, keys: list[str], ts: str, delay: str = "7 days") -> DataFrame:
    """T1 with bounded state: repeats within ``delay`` are dropped, later ones pass."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def run_monitor(stream: DataFrame, ts: str = "at", status: str = "status", width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Outcomes per time bucket; rows later than ``delay`` are left out."""
    return (
        stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), F.col(status).alias("status"))
        .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("bucket"), "status", "n"))


def start_monitor(counts: DataFrame, out: str, checkpoint: str):
    return counts.writeStream.outputMode("append").format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_upsert(stream: DataFrame, table: str, checkpoint: str, key: str = "asset", order: tuple[str, ...] = ("at", "ord")):
    """Latest record per asset. Each batch writes a new version of the table from the version
    before it and its own rows; the highest complete version is current."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = ledger_latest(batch, key, list(order))
        before = f"{table}/v={number - 1}"
        if number > 0 and _exists(spark, before):
            rows = ledger_latest(spark.read.parquet(before).unionByName(rows), key, list(order))
        rows.write.mode("overwrite").parquet(f"{table}/v={number}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_version(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the highest version of a ``latest_upsert`` table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = [int(s.getPath().getName()[2:]) for s in fs.listStatus(path)  # folder names only
                if s.getPath().getName().startswith("v=") and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))]
    return spark.read.parquet(f"{table}/v={max(versions)}")
