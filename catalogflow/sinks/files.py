"""Writers (K1s-K10s).

Every table write goes to a new folder and is checked by reading it back before it counts;
earlier snapshots stay as they are, so going back is a matter of naming the earlier one.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions.keys import text
from catalogflow.operators.aggregates import table_fingerprint
from catalogflow.operators.gates import missing_required
from catalogflow.operators.ordering import global_rank
from catalogflow.schemas import MASTER_COLUMNS, REQUIRED_COLUMNS
from catalogflow.sources.files import SHARD

SHARD_SIZE = 5000
URL_SHARD_SIZE = 45000


@dataclass
class AppendResult:
    ok: bool
    problems: list[str]
    rows: int
    path: str | None


def append_problems(
    old: DataFrame, projected: DataFrame, new: DataFrame, columns: Sequence[str] = MASTER_COLUMNS, allow_updates: DataFrame | None = None, appended: bool = False
) -> DataFrame:
    """K1s checks as one table (problem, n): old rows changed, rows lost, repeated identities,
    new rows with a blank required column. Empty when the append is clean.

    ``appended``: ``projected`` is the stored rows of ``old`` and those of ``new``, so that none of ``old`` can be changed or lost; only the other two are looked for."""
    identity = [text("mpn").alias("mpn"), text("manufacturer").alias("manufacturer")]
    problems = [
        projected.groupBy(*identity).agg(F.count(F.lit(1)).alias("c")).where("c > 1").agg(
            F.lit("duplicate identity").alias("problem"), F.count(F.lit(1)).alias("n")),
        new.where(missing_required(REQUIRED_COLUMNS).isNotNull()).agg(
            F.lit("new row lacks a required column").alias("problem"), F.count(F.lit(1)).alias("n")),
    ]
    if appended:
        return reduce(DataFrame.unionByName, problems).where("n > 0")
    row = F.sha2(F.concat_ws("\x1f", *[text(F.col(c)) for c in columns]), 256)
    before = old.select(*identity, row.alias("h"))
    if allow_updates is not None:
        allowed = allow_updates.select(F.upper(F.trim("mpn")).alias("_a")).distinct()
        before = before.join(allowed, F.upper("mpn") == F.col("_a"), "left_anti")
    # Bag comparison: a row that occurs twice in MASTER has to occur twice afterwards.
    b = before.groupBy("h").agg(F.count(F.lit(1)).alias("nb"))
    a = projected.groupBy(row.alias("h")).agg(F.count(F.lit(1)).alias("na"))
    changed = b.join(a, "h", "left").where(F.col("nb") > F.coalesce("na", F.lit(0)))
    problems = [
        changed.agg(F.lit("pre-existing rows modified").alias("problem"), F.count(F.lit(1)).alias("n")),
        *problems,
        old.agg(F.count(F.lit(1)).alias("o")).crossJoin(projected.agg(F.count(F.lit(1)).alias("p"))).select(  # one row each
            F.lit("row count shrank").alias("problem"), F.greatest(F.col("o") - F.col("p"), F.lit(0)).alias("n")),
    ]
    return reduce(DataFrame.unionByName, problems).where("n > 0")


def append_validated(
    spark: SparkSession, old: DataFrame, new: DataFrame, target: str, columns: Sequence[str] = MASTER_COLUMNS, updated: DataFrame | None = None,
    allow_updates: DataFrame | None = None,
) -> AppendResult:
    """K1s: old rows and new rows as a new snapshot in ``target``; nothing is written on a problem."""
    if list(new.columns) != list(columns) or list(old.columns) != list(columns):
        return AppendResult(False, ["columns differ from MASTER"], 0, None)
    projected = (old if updated is None else updated).unionByName(new)
    found = [f"{r['problem']}: {r['n']}" for r in append_problems(old, projected, new, columns, allow_updates).collect()]  # at most four rows
    if found:
        return AppendResult(False, found, 0, None)
    projected.write.mode("errorifexists").parquet(target)
    written = spark.read.parquet(target)
    want, got = table_fingerprint(projected, columns).first(), table_fingerprint(written, columns).first()
    if want != got:
        return AppendResult(False, ["written table differs from the plan"], got["rows"], None)
    return AppendResult(True, [], got["rows"], target)


def write_candidates(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """K2s: candidates by batch; writing a batch again replaces that batch only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)


def write_slices(sliced: DataFrame, path: str) -> None:
    """K3s."""
    sliced.repartition("slice_idx").write.mode("overwrite").partitionBy("slice_idx").parquet(path)


def write_catalog(df: DataFrame, path: str, fmt: str = "json") -> None:
    """K4s: null fields are left out of JSON records."""
    df.write.mode("overwrite").format(fmt).save(path)


def search_shards(entries: DataFrame, order: Sequence[str], size: int = SHARD_SIZE) -> DataFrame:
    """K5s: entries with their shard number in sort order."""
    ranked = global_rank(entries, order, "_r")
    return ranked.withColumn("shard", F.floor((F.col("_r") - 1) / F.lit(size)).cast("long")).drop("_r")


def shard_manifest(sharded: DataFrame, key: str) -> DataFrame:
    """K5s: entries, first and last key of each shard."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("from"), F.max(key).alias("to"))


def write_search_shards(sharded: DataFrame, path: str, order: Sequence[str]) -> None:
    sharded.repartitionByRange("shard", *order).sortWithinPartitions("shard", *order).write.mode("overwrite").partitionBy("shard").json(path)


def url_shards(urls: DataFrame, order: Sequence[str], base: str = "sitemap_parts", size: int = URL_SHARD_SIZE) -> DataFrame:
    """K6s: URL lines with the name of their file; one shard has the plain name, several are numbered."""
    ranked = global_rank(urls, order, "_r")
    total = ranked.agg(F.count(F.lit(1)).alias("_total"))
    idx = F.floor((F.col("_r") - 1) / F.lit(size)).cast("long") + 1
    name = F.when(F.col("_total") <= size, F.lit(base)).otherwise(F.concat(F.lit(base + "_"), idx.cast("string")))
    # one row on the right
    return ranked.crossJoin(F.broadcast(total)).withColumn("file", name).withColumn("shard", idx).drop("_r", "_total")


def url_xml(url) -> Column:
    from catalogflow.functions.text import escape_html

    return F.concat(F.lit("  <url><loc>"), escape_html(url), F.lit("</loc></url>"))


def url_index(sharded: DataFrame) -> DataFrame:
    return sharded.groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def write_url_shards(sharded: DataFrame, path: str, url: str = "url") -> None:
    sharded.select("file", url_xml(F.col(url)).alias("value")).repartition("file").write.mode("overwrite").partitionBy("file").text(path)


def write_review_queue(review: DataFrame, path: str) -> None:
    """K7s."""
    review.dropDuplicates(["mpn", "reason", "detail"]).write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """K8s."""
    df.write.mode("append").json(path)


def page_manifest(pages: DataFrame, version: str) -> DataFrame:
    """K9s: pages in (top, slug) order with version; the order is a global sort."""
    return pages.select("top", "slug", "n").withColumn("version", F.lit(version)).orderBy("top", "slug")


def write_page_manifest(pages: DataFrame, path: str, version: str) -> None:
    page_manifest(pages, version).write.mode("overwrite").json(path)


def write_plan(summary: DataFrame, findings: DataFrame, path: str) -> None:
    """K10s: the one-row summary and the findings table side by side; findings may be many, so they
    are rows of their own folder and never one array."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    findings.write.mode("overwrite").json(f"{path}/findings")


# ---- documents as files (B12) --------------------------------------------------------

def write_documents(df: DataFrame, folder: str, name: str = "name", content: str = "content", shards: int = 0) -> DataFrame:
    """(name, size) of the files written: tasks put each row's binary content below ``folder`` under its name.

    A name is one of a file, without folders; any other is an error. A file gets its name when it is complete, so a task that runs again replaces its files and readers never see a part of one. The
    folder has to be one that all executors reach; a batch of rows is in memory at a time, not a partition. With ``shards`` the files are dealt out by
    name to so many subfolders, which ``list_files`` lists in tasks of their own.
    """
    has_scheme = bool(urlsplit(folder).scheme)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder) if has_scheme else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            for key, data in zip(batch.column(0), batch.column(1)):
                if not key.is_valid or "/" in key.as_py() or key.as_py() in ("", ".", ".."):
                    raise ValueError(f"not a file name: {key}")
                own = f"{base}/{SHARD}{zlib.crc32(key.as_py().encode()) % shards:05d}" if shards else base
                if shards and own not in made:
                    store.create_dir(own, recursive=True)
                    made.add(own)
                part = f"{own}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(data.as_buffer())
                store.move(part, f"{own}/{key.as_py()}")
                sizes.append(data.as_buffer().size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["name", "size"])

    rows = df.select(F.col(name).cast("string").alias("name"), F.coalesce(F.col(content), F.lit(b"")).cast("binary").alias("content"))
    return rows.mapInArrow(write, "name string, size long")


# ---- versions of a table (B5) --------------------------------------------------------

class Versions:
    """Snapshots of one table in a folder, and a log of commits that says which one is current.

    A version is written to a folder of its own and becomes current by one small commit file, made only if no other has its
    number. Whatever stops before that file is there leaves the earlier version current, and a folder without a commit is
    never read. Going back is a commit too, so the log tells what was current when.
    """

    _LOG = "commit long, action string, release string, version string, rows long"

    def __init__(self, spark: SparkSession, store: str):
        self._spark, self._store = spark, store.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self._store).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _entries(self) -> DataFrame:
        folder = f"{self._store}/commits"
        if not self._fs.exists(self._path(folder)):
            return self._spark.createDataFrame([], self._LOG)
        return self._spark.read.schema(self._LOG).json(folder).where("version IS NOT NULL")

    def log(self) -> DataFrame:
        """The commits, oldest first; one row for each release."""
        return self._entries().orderBy("commit")

    def standing(self, release: str | None = None, before: int | None = None) -> tuple:
        """The last commit, the last one that names ``release`` and the last one before number ``before``; None for each that is not there. One job without a shuffle of the log."""
        entries = self._entries()
        entry, number = F.struct(*entries.columns), F.col("commit")
        own, earlier = F.when(F.col("release") == F.lit(release), number), F.when(number < F.lit(before), number)
        return tuple(entries.agg(F.max_by(entry, number).alias("last"), F.max_by(entry, own).alias("own"), F.max_by(entry, earlier).alias("earlier")).first())

    def current(self) -> DataFrame | None:
        """The current rows; None before the first commit."""
        last, *_ = self.standing()
        return None if last is None else self.staged(last["version"])

    def stage(self, rows: DataFrame) -> str:
        """Write ``rows`` as a version that is not current yet."""
        version = uuid.uuid4().hex
        rows.write.mode("errorifexists").parquet(f"{self._store}/data/{version}")
        return version

    def stage_observed(self, rows: DataFrame, metrics: Sequence[Column]) -> tuple[dict, str]:
        """``metrics`` of the rows that the writer was given, told in the same pass, and the version it wrote."""
        handed = Observation()
        version = self.stage(rows.observe(handed, *metrics))
        return handed.get, version

    def discard(self, version: str | None) -> None:
        """Take away a version that was staged and will not be committed."""
        if version is not None:
            self._fs.delete(self._path(f"{self._store}/data/{version}"), True)

    def staged(self, version: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._store}/data/{version}")

    def commit(self, action: str, release: str, version: str, after: int, rows: int | None = None) -> int:
        """Make ``version`` current as the commit after number ``after``; an error if that number is taken, and then nothing changes. Its rows are counted where the caller has not."""
        entry = {"commit": after + 1, "action": action, "release": release, "version": version, "rows": self.staged(version).count() if rows is None else rows}
        out = self._fs.create(self._path(f"{self._store}/commits/{after + 1:08d}.json"), False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        return after + 1

    def number(self) -> int:
        """Number of the last commit, 0 before the first."""
        last, *_ = self.standing()
        return 0 if last is None else last["commit"]

    def released(self, release: str) -> bool:
        """Whether a release is in effect: the last commit that names it applied it."""
        own = self.standing(release)[1]
        return own is not None and own["action"] == "apply"

    def rollback(self, release: str) -> int:
        """Make the version before the last ``apply`` of ``release`` current again; nothing happens when the release is not in effect."""
        last, own, _ = self.standing(release)
        if own is None or own["action"] != "apply":
            return 0 if last is None else last["commit"]
        before = self.standing(before=own["commit"])[2]
        if before is None:
            raise ValueError(f"{release} is the first release")
        return self.commit("rollback", release, before["version"], last["commit"], before["rows"])
