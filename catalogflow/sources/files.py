"""Readers (S1-S6, S8-S13, S15-S16). Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.functions import attrs
from catalogflow.functions.keys import _col, nonblank, text
from catalogflow.functions.text import keyword_category, normalize_text
from catalogflow.operators.ordering import last_occurrence
from catalogflow.schemas import ENVELOPE, LEDGER, MASTER_COLUMNS, NUMERIC_MASTER_COLUMNS, RAW_FLAT, TAXONOMY, strings


class SchemaMismatch(ValueError):
    """The file does not carry the columns it must carry."""


def _csv(spark: SparkSession, path, **options: str):
    return spark.read.options(header=True, multiLine=True, escape='"', encoding="UTF-8", **options)


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names in the file, byte order mark taken off; reads the first line only."""
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    return [n.lstrip("﻿") for n in names]


def read_master(spark: SparkSession, path: str, expected: Sequence[str] = MASTER_COLUMNS) -> DataFrame:
    """MASTER as text columns; the header must be the expected list in the expected order."""
    found = header_of(spark, path)
    if found != list(expected):
        raise SchemaMismatch(f"header is {found}, expected {list(expected)}")
    return _csv(spark, path, enforceSchema="true").schema(strings(*expected)).csv(path)


def typed_master(df: DataFrame) -> DataFrame:
    """The numeric columns of MASTER as longs; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("long") for c in NUMERIC_MASTER_COLUMNS})


def read_raw_flat(spark: SparkSession, path: str) -> DataFrame:
    """D2."""
    return _csv(spark, path, enforceSchema="false").schema(RAW_FLAT).csv(path)


def scan_keys(df: DataFrame, key: str = "mpn") -> DataFrame:
    """One column, blanks dropped; the scan reads that column only."""
    return df.where(nonblank(key)).select(F.trim(key).alias(key))


def _parsed(lines: DataFrame, schema: T.StructType, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``value`` is JSON of the schema, and the damaged rows as text."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = lines.where("trim(value) <> ''").withColumn("_r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = rows.where("_r._corrupt is null").select("_r.*", *keep).drop("_corrupt")
    return good, rows.where("_r._corrupt is not null").select(*keep, F.col("value").alias("damaged"))


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S3: good lines, and the damaged ones as text. Damaged lines are counted, not lost."""
    return _parsed(spark.read.text(path), schema)


def read_envelopes(spark: SparkSession, path: str, pattern: str = "C*.json") -> tuple[DataFrame, DataFrame]:
    """One JSON document per file; key = file stem. Returns (envelopes, unreadable files)."""
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return _parsed(files.select("value", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("key")), ENVELOPE, "key")


SHARD = "shard="  # subfolders that ``write_documents`` deals files out to
_LISTED = "path string, name string, modified timestamp, folder boolean"
_READ_BYTES, _READ_FILES = 8 << 20, 1024  # of a batch of files


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, modified) of the files in a folder and its shards whose name fits a shell pattern; names with a dot or underscore in front are left out.

    Tasks list the folders, so that the driver holds no list of files, however many there are.
    """
    has_scheme = bool(urlsplit(path).scheme)
    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("folder", pa.bool_())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path) if has_scheme else (fs.LocalFileSystem(), path)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(base if folder is None else folder))
                kept = [f for f in found if (f.base_name.startswith(SHARD) if f.type == fs.FileType.Directory else fnmatchcase(f.base_name, pattern) and f.base_name[0] not in "._")]
                for at in range(0, len(kept), 4096):
                    part = kept[at : at + 4096]
                    times = pa.array([f.mtime_ns // 1_000_000 * 1000 for f in part], pa.int64()).cast(schema.field("modified").type)
                    yield pa.RecordBatch.from_arrays([pa.array([f.path for f in part]), pa.array([f.base_name for f in part]), times, pa.array([f.type == fs.FileType.Directory for f in part])], schema=schema)

    n = 4 * spark.sparkContext.defaultParallelism
    top = spark.range(1, numPartitions=1).select(F.lit(None).cast("string").alias("path")).mapInArrow(listed, _LISTED)
    below = top.where("folder").select("path").repartition(n, "path").mapInArrow(listed, _LISTED)
    return top.unionByName(below).where("NOT folder").select("path", "name", "modified")


def read_listed(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """``listed`` files of ``path`` with ``value``, the whole text of each; files are dealt out to tasks, which hold a batch of a few at a time."""
    has_scheme = bool(urlsplit(path).scheme)
    schema = pa.schema([("name", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("value", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(path)[0] if has_scheme else fs.LocalFileSystem()
        for batch in batches:
            start, size, bodies = 0, 0, []
            for i, p in enumerate(batch.column(0).to_pylist()):
                with store.open_input_stream(p) as f:
                    bodies.append(f.read())
                size += len(bodies[-1])
                if size >= _READ_BYTES or len(bodies) >= _READ_FILES or i + 1 == batch.num_rows:
                    own = batch.slice(start, len(bodies))
                    yield pa.RecordBatch.from_arrays([own.column(1), own.column(2).cast(schema.field("modified").type), pa.array(bodies, pa.binary())], schema=schema)
                    start, size, bodies = i + 1, 0, []

    dealt = listed.select("path", "name", "modified").repartition(4 * spark.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(read, "name string, modified timestamp, value binary").withColumn("value", F.col("value").cast("string"))


def scan_envelopes(spark: SparkSession, path: str, pattern: str = "C*.json", names: str | None = None, since=None) -> DataFrame:
    """S4 in one pass: (key, modified, envelope columns, damaged); ``damaged`` is the text of a file that is no envelope, else null.

    ``names`` (a pattern for file names) and ``since`` (a time) are conditions on file metadata, so files that fail them are dropped
    once files are listed and never opened.
    """
    files = list_files(spark, path, pattern)
    if names is not None:
        files = files.where(F.col("name").rlike(names))
    if since is not None:
        files = files.where(F.col("modified") >= F.lit(since))
    full = T.StructType([*ENVELOPE.fields, T.StructField("_corrupt", T.StringType())])
    read = read_listed(spark, path, files).withColumn("_r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull() | (F.trim("value") == "")
    columns = [F.when(~bad, F.col(f"_r.{f.name}")).alias(f.name) for f in ENVELOPE.fields]
    return read.select(F.regexp_replace("name", r"\.json$", "").alias("key"), "modified", *columns, F.when(bad, F.col("value")).alias("damaged"))


def flatten_envelope(env: DataFrame) -> DataFrame:
    """envelope to a flat record with canonical and unmapped attributes."""
    mp, od = F.col("source_raw.main_product"), F.col("source_raw.overviewData")
    rows = env.withColumn("_entries", attrs.parameter_entries(mp["paramVOList"]))
    rows = rows.withColumn("_canon", attrs.canonical_attributes("_entries")).withColumn("_unmapped", attrs.unmapped_attributes("_entries"))
    rows = rows.withColumn("_alts", F.coalesce(attrs.replay_alternates("source_raw.alternatePartList"), F.array().cast("array<struct<mpn:string,manufacturer:string,lcsc:string,type:string,package:string>>")))
    rows = rows.withColumn("_chain", attrs.parent_chain(mp["parentCatalogList"], mp["catalogName"], mp["catalogId"]))
    intro = F.coalesce(F.nullif(text(od["productIntroEn"]), F.lit("")), text(mp["productIntroEn"]))
    name = text(mp["productNameEn"])
    described = F.when(intro != "", F.regexp_replace(F.concat(name, F.lit(" - "), intro), r"^[ \-]+|[ \-]+$", "")).otherwise(name)
    chain = lambda f, out: F.coalesce(F.col(f"_chain.{f}").cast("string"), F.lit("")).alias(out)
    keep = [c for c in ("key", "ord") if c in env.columns]
    return rows.select(
        *keep, text(mp["productModel"]).alias("mpn"), text(mp["brandNameEn"]).alias("manufacturer_raw"),
        text(mp["wmCatalogNameEn"]).alias("catalogName"), text(mp["parentCatalogName"]).alias("parentCatalogName"),
        F.lit("").alias("category"), normalize_text(described).alias("description"), intro.alias("introduction"),
        F.to_json("_canon").alias("attributes_json"), F.to_json("_unmapped").alias("attributes_json_unmapped"),
        text(mp["pdfUrl"]).alias("source_datasheet_url"), attrs.first_image(mp).alias("source_image_url"),
        text(mp["productCode"]).alias("supplier_sku"),
        F.array_join(F.transform("_alts", lambda a: a["mpn"]), "; ").alias("alternative_parts"),
        F.to_json("_alts").alias("alternative_parts_detail"),
        normalize_text(od["pdfApplicationAreasEn"]).alias("applications_en"), F.lit("lcsc_http_json").alias("source_kind"),
        F.to_json(F.coalesce(mp["htsMap"], F.create_map().cast("map<string,string>"))).alias("hts_map"), text(mp["eccn"]).alias("eccn"),
        F.to_json(F.coalesce(mp["faqs"], F.array().cast("array<struct<question:string,answer:string>>"))).alias("faqs_raw"),
        chain("parent_chain", "lcsc_parent_chain"), chain("leaf_id", "lcsc_leaf_id"), chain("leaf_name", "lcsc_leaf_name"),
        chain("parent_id", "lcsc_parent_id"), chain("parent_name", "lcsc_parent_name"), chain("depth", "lcsc_depth"),
    )


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """Tab separated raw and canonical names; key lower case, last row wins, blanks skipped."""
    rows = (
        spark.read.schema(strings("raw", "canonical")).option("sep", "\t").csv(path)
        .select("raw", "canonical", F.col("_metadata.file_path").alias("_f"), F.monotonically_increasing_id().alias("_o"))
    )
    good = rows.where(nonblank("raw") & nonblank("canonical")).withColumn("_k", F.lower(F.trim("raw")))
    return good.groupBy("_k").agg(F.max_by(F.trim("canonical"), F.struct("_f", "_o")).alias("canonical")).withColumnRenamed("_k", "raw")


def read_lexicon(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """JSON dictionary to (key, value); ``field`` names the object that holds it, where a list
    of {zh, en} pairs is accepted too."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value").alias("j"))
    body = F.get_json_object("j", f"$.{field}") if field else F.col("j")
    pairs = F.transform(F.from_json(body, T.ArrayType(strings("zh", "en"))), lambda p: F.struct(p["zh"].alias("key"), p["en"].alias("value")))
    entries = F.when(F.trim(body).startswith("["), pairs).otherwise(F.map_entries(F.from_json(body, "map<string,string>")))
    return whole.select(F.inline(entries))


def read_taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Top scopes and level-1 categories, status lower case, active when missing."""
    raw = spark.read.schema(TAXONOMY).option("multiLine", True).json(path)
    status = lambda d: d.withColumn("publish_status", F.lower(F.coalesce(F.nullif(F.trim("publish_status"), F.lit("")), F.lit("active"))))
    return status(raw.select(F.inline("top_scopes"))), status(raw.select(F.inline("l1_categories")))


def latest_snapshot(spark: SparkSession, path: str, pattern: str, schema: T.StructType, key: str = "mpn") -> DataFrame:
    """The last file of a dated family, last row per key (trim, upper) wins."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")
    newest = listed.agg(F.max("path")).first()[0]  # one value: the greatest path
    if newest is None:
        return spark.createDataFrame([], schema)
    rows = _csv(spark, newest, enforceSchema="false").schema(schema).csv(newest).withColumn("_o", F.monotonically_increasing_id())
    return last_occurrence(rows.where(nonblank(key)), [F.upper(F.trim(key))], "_o").drop("_o")


def newest_of_family(spark: SparkSession, path: str, date: str, schema: T.StructType, key: str = "mpn") -> DataFrame:
    """S9 for snapshots of many files: of the CSV files below ``path`` those with the last date, last row per key (trim, upper) wins.

    ``date`` is a pattern whose first group is the date in a file's path; files without one are left out. Names are listed first, without opening a file;
    the scan then has a condition on the path, so only the files of that date are read. Rows come in the order of paths and of places in a file.
    """
    of = lambda c: F.regexp_extract(c, date, 1)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(path).select(of(F.col("path")).alias("d"))
    newest = listed.where("d <> ''").agg(F.max("d")).first()[0]
    if newest is None:
        return spark.createDataFrame([], schema)
    rows = _csv(spark, path, enforceSchema="false", recursiveFileLookup="true", pathGlobFilter="*.csv").schema(schema).csv(path)
    meta = F.col("_metadata")
    placed = rows.select("*", meta["file_path"].alias("_f"), meta["file_block_start"].alias("_b"), F.monotonically_increasing_id().alias("_i"))
    return last_occurrence(placed.where((of(F.col("_f")) == newest) & nonblank(key)).withColumn("_o", F.struct("_f", "_b", "_i")), [F.upper(F.trim(key))], "_o").drop("_o", "_f", "_b", "_i")


def index_documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Path, stem, id after ``__``, size and SHA-256 of every document below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    return files.select(
        "path", stem.alias("stem"), F.when(stem.contains("__"), F.substring_index(stem, "__", -1)).otherwise(stem).alias("doc_id"),
        F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("content"))


def read_patch(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Patch table; required columns are checked by name, order is free."""
    names = header_of(spark, path)
    missing = [c for c in required if c not in names]
    if missing:
        raise SchemaMismatch(f"patch lacks {missing}")
    return _csv(spark, path).csv(path).toDF(*names)


def read_overrides(spark: SparkSession, path: str, cols: Sequence[str] = ("slug", "url")) -> DataFrame:
    """Frozen table; a missing file is an empty one."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], strings(*cols))
    return _csv(spark, path, enforceSchema="false").schema(strings(*cols)).csv(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Asset ledger; a list, or an object that wraps the list in ``records``."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value").alias("j"))
    bare = F.from_json("j", T.ArrayType(LEDGER))
    wrapped = F.from_json(F.get_json_object("j", "$.records"), T.ArrayType(LEDGER))
    return whole.select(F.inline(F.when(F.trim("j").startswith("["), bare).otherwise(wrapped)))


def flatten_ranked_feed(pages: DataFrame, products: str = "products", page: str = "page", page_size: int = 100) -> DataFrame:
    """Paged product arrays to ranked rows: attributes of filled parameters, mapped category,
    first picture without query, document URL."""
    p = lambda f: F.col(f"p.{f}")
    rows = pages.select(F.col(page).alias("_page"), F.posexplode(products).alias("pos", "p"))
    entries = F.filter(p("paramVOList"), lambda x: (text(x["paramName"]) != "") & (text(x["paramValue"]) != ""))
    attributes = F.map_from_entries(attrs.keep_last(F.transform(entries, lambda x: F.struct(
        F.trim(x["paramName"]).alias("key"), F.trim(x["paramValue"]).alias("value")))))
    clean = lambda u: F.substring_index(F.coalesce(u, F.lit("")), "?", 1)
    return rows.select(
        ((F.col("_page") - 1) * page_size + F.col("pos") + 1).cast("int").alias("rank"), text(p("productCode")).alias("supplier_sku"),
        text(p("productModel")).alias("mpn"), text(p("brandNameEn")).alias("manufacturer_raw"), text(p("catalogName")).alias("catalogName"),
        keyword_category(p("catalogName")).alias("category"), F.to_json(attributes).alias("attributes_json"),
        clean(F.try_element_at(p("productImages"), F.lit(1))).alias("source_image_url"), clean(p("pdfUrl")).alias("source_datasheet_url"))


def read_enrichment(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Side files ``<name>.content.json`` with a content hash; (valid, skipped with reason)."""
    rows = (
        read_listed(spark, path, list_files(spark, path, "*.content.json"))
        .select(F.col("value").alias("body"), F.regexp_replace("name", r"\.content\.json$", "").alias("name"))
        .withColumn("fingerprint", F.sha2("body", 256)).withColumn("_v", F.try_parse_json("body"))
    )
    version = F.try_variant_get("_v", "$.schema_version", "string")
    reason = F.when(F.col("_v").isNull(), "invalid JSON").when(version.isNull(), "no schema_version")
    tagged = rows.withColumn("reason", reason)
    return tagged.where("reason is null").select("name", "body", "fingerprint"), tagged.where("reason is not null").select("name", "reason")


def attach_enrichment(df: DataFrame, enrichment: DataFrame, slug: str = "url_slug", mpn: str = "mpn") -> DataFrame:
    """By slug first, then by part number; ``enrich_fp`` is NO_ENRICH where there is none."""
    e = enrichment.groupBy(F.upper("name").alias("_n")).agg(F.min(F.struct("name", "fingerprint", "body")).alias("_e"))
    by_slug = e.select(F.col("_n").alias("_sn"), F.col("_e").alias("_se"))
    by_mpn = e.select(F.col("_n").alias("_mn"), F.col("_e").alias("_me"))
    hit = F.coalesce("_se", "_me")
    return (
        df.join(by_slug, F.upper(text(slug)) == F.col("_sn"), "left").join(by_mpn, F.upper(text(mpn)) == F.col("_mn"), "left")
        .withColumn("enrich_body", hit["body"]).withColumn("enrich_fp", F.coalesce(hit["fingerprint"], F.lit("NO_ENRICH")))
        .drop("_sn", "_se", "_mn", "_me")
    )


def document_error(content, content_type=None) -> Column:
    """why a document is not accepted; blank when it is."""
    body = _col(content)
    size = F.length(body)
    tail = F.when(size > 2048, F.substring(body, -2048, 2048)).otherwise(body)
    wrong_type = (~F.lower(F.coalesce(_col(content_type), F.lit(""))).rlike("pdf|octet-stream")) if content_type is not None else F.lit(False)
    # Size limits and markers of a document.
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "EMPTY").when(size < 1024, "TOO_SMALL").when(size > 100 * 1024 * 1024, "TOO_LARGE")
        .when(wrong_type, "WRONG_TYPE").when(F.substring(body, 1, 4) != F.lit(b"%PDF"), "NO_PDF_MARK")
        .when(~F.contains(tail, F.lit(b"%%EOF")), "NO_END_MARK").otherwise(""))
