"""Documents of parts: discovery, validation, content dedup, map, apply."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions.keys import content_key, key_filesafe, key_upper, nonblank, text
from catalogflow.operators.gates import asset_invariants
from catalogflow.operators.identity import lookup_with_fallback, match_documents
from catalogflow.session import cut
from catalogflow.sources.files import document_error, index_documents

# Ledger states after which an asset needs no more work.
DONE = ("VERIFIED", "DUPLICATE", "UPLOADED")


def discover(parts: DataFrame, ledger: DataFrame | None = None, mpn: str = "mpn", url: str = "source_datasheet_url", keep: Sequence[str] = ()) -> DataFrame:
    """Ledger of a batch: finished records stay as they are, the others start at DISCOVERED, or
    SKIPPED when there is no link. ``keep`` names columns of the parts to carry along."""
    fresh = parts.select(*keep, F.col(mpn).alias("mpn"), text(url).alias("source_url")).withColumn(
        "status", F.when(F.col("source_url") == "", "SKIPPED").otherwise("DISCOVERED")).withColumn(
        "error_code", F.when(F.col("source_url") == "", "NO_URL"))
    if ledger is None:
        return fresh
    done = ledger.where(F.col("status").isin(*DONE)).groupBy(key_upper("mpn").alias("_m")).agg(F.min(F.struct("status", "source_url")).alias("d"))
    j = fresh.join(done, key_upper("mpn") == F.col("_m"), "left")
    return j.select(*keep, "mpn", F.coalesce("d.source_url", "source_url").alias("source_url"), F.coalesce("d.status", "status").alias("status"),
                    F.when(F.col("d").isNull(), F.col("error_code")).alias("error_code"))


def validate_documents(docs: DataFrame, content_type: str | None = None) -> DataFrame:
    """F69 on every document, and content dedup: the first path of a hash is VERIFIED, the others
    DUPLICATE, broken ones FAILED. Hashes are compared, contents are not collected."""
    rows = docs.withColumn("error_code", document_error("content", content_type)).drop("content")
    first = rows.where("error_code = ''").groupBy("sha256").agg(F.min("path").alias("_first"))
    return rows.join(first, "sha256", "left").withColumn(
        "status", F.when(F.col("error_code") != "", "FAILED").when(F.col("path") == F.col("_first"), "VERIFIED").otherwise("DUPLICATE")
    ).withColumn("storage_key", F.when(F.col("error_code") == "", content_key("datasheets/pdf", "sha256"))).drop("_first")


def document_map(parts: DataFrame, docs: DataFrame, base_url: str) -> DataFrame:
    """J11 with the published address: kept, else made from the supplier code."""
    rows = match_documents(parts, docs)
    fresh = F.concat(F.lit(base_url + "/datasheets/"), key_filesafe(F.when(nonblank("code"), F.col("code")).otherwise(F.col("mpn"))), F.lit(".pdf"))
    return rows.withColumn("published_url", F.when(F.col("method") == "preserved", F.col("url")).when(F.col("method") != "missing", fresh).otherwise("")).withColumn(
        "status", F.when(F.col("method") == "missing", "missing").otherwise("mapped"))


def apply_map(master: DataFrame, mapping: DataFrame, prune: bool = False, url: str = "datasheet_url") -> DataFrame:
    """Mapped address by code, else part number. A covered part with a blank address becomes blank;
    an uncovered part keeps its address unless ``prune``. Adds ``map_result``."""
    m = mapping.where("status = 'mapped'")
    last = lambda key: m.where(key != "").groupBy(key.alias("key")).agg(F.max_by("url", "ord").alias("value"))
    rows = lookup_with_fallback(master, last(key_upper("supplier_reference")), last(key_upper("mpn")), "supplier_reference", "mpn", "_new")
    covered = F.col("_new").isNotNull()
    value = F.when(covered, F.col("_new")).otherwise(F.lit("") if prune else text(url))
    result = (
        F.when(covered & (F.col("_new") != ""), "set").when(covered, "empty")
        .when(nonblank(url), F.lit("pruned" if prune else "preserved")).otherwise("empty"))
    return rows.withColumn("map_result", result).withColumn(url, value).drop("_new", "_new_path")


def pre_upload_problems(docs: DataFrame) -> DataFrame:
    """Documents that may not be uploaded: broken, or a key that several contents claim."""
    broken = docs.where("error_code <> ''").select("path", F.col("error_code").alias("problem"))
    claimed = docs.groupBy(key_filesafe("doc_id").alias("_k")).agg(F.countDistinct("sha256").alias("_n")).where("_n > 1")
    clash = docs.join(claimed, key_filesafe("doc_id") == F.col("_k"), "left_semi").select("path", F.lit("KEY_COLLISION").alias("problem"))
    return broken.unionByName(clash)


def outcome_totals(ledger: DataFrame) -> DataFrame:
    """Uploaded, new, existing, failed and total from upload outcomes."""
    n = lambda *s: F.coalesce(F.sum(F.when(F.col("outcome").isin(*s), 1).otherwise(0)), F.lit(0))
    return ledger.agg(n("NEW", "EXISTS").alias("uploaded"), n("NEW").alias("new_objects"), n("EXISTS").alias("already_exists"),
                      n("FAILED").alias("failed"), F.count(F.lit(1)).alias("total"))


def is_done(status: Column) -> Column:
    return status.isin(*DONE)


# ---- the job (B12) ---------------------------------------------------------------------

@dataclass
class AssetRun:
    documents: DataFrame  # path, stem, doc_id, size, sha256, error_code, status, storage_key
    ledger: DataFrame     # part_id, mpn, source_url, status, error_code, sha256, storage_key
    mapping: DataFrame    # document_map of all parts
    master: DataFrame     # with mapped addresses and map_result
    problems: DataFrame   # path, problem: what may not be uploaded
    uploads: DataFrame    # storage_key, path, outcome
    totals: DataFrame     # one row, with the invariants


def asset_pipeline(
    spark: SparkSession, folder: str, parts: DataFrame, base_url: str, ledger: DataFrame | None = None, stored_keys: DataFrame | None = None, prune: bool = False,
) -> AssetRun:
    """B12 as one job over a folder of delivered documents and the parts they belong to.

    ``parts``: part_id, code, mpn, clean_mpn, url (address already published), source_url, ord. ``ledger``: earlier records (mpn, source_url,
    status). ``stored_keys``: storage_key of documents the store has.

    The folder is read once: hashes, checks and names are taken where the bytes are and kept, contents go no further. Spark passes over
    files without a byte, so an empty file counts as not delivered. A part's record moves
    from DISCOVERED to VERIFIED, DUPLICATE (another file has the same content) or FAILED with the reason; without a document it stays
    DISCOVERED, without a link it is SKIPPED, and a finished record is not touched. Verified documents that no problem holds back
    are uploads: NEW, or EXISTS when the store has the key; the others FAILED. The totals have to add up (A22).
    """
    docs = cut(validate_documents(index_documents(spark, folder)))
    known = cut(parts.select("part_id", "code", "mpn", "clean_mpn", "url", "source_url", "ord"))
    good, bad = docs.where("error_code = ''"), docs.where("error_code <> ''")
    mapping = cut(document_map(known, good, base_url))
    started = discover(known, ledger, url="source_url", keep=["part_id"]).select("part_id", "mpn", F.col("source_url").alias("_url"), F.col("status").alias("_status"), F.col("error_code").alias("_error"))
    broken = match_documents(known.withColumn("url", F.lit("")), bad).where("method <> 'missing'").select(F.col("part_id").alias("_bp"), F.col("path").alias("_bpath"))
    found = match_documents(known.withColumn("url", F.lit("")), good).where("method <> 'missing'").select(F.col("part_id").alias("_gp"), F.col("path").alias("_gpath"))
    facts = docs.select(F.col("path").alias("_path"), "error_code", "status", "sha256", "storage_key")
    # a sound document of a part counts before a broken one
    placed = (
        started.join(found, F.col("part_id") == F.col("_gp"), "left").join(broken, F.col("part_id") == F.col("_bp"), "left")
        .withColumn("_any", F.coalesce("_gpath", "_bpath")).join(facts, F.col("_any") == F.col("_path"), "left"))
    open_ = F.col("_status") == "DISCOVERED"
    met = open_ & F.col("_path").isNotNull()
    moved = placed.select(
        "part_id", "mpn", F.col("_url").alias("source_url"), F.when(met, F.col("status")).otherwise(F.col("_status")).alias("status"),
        F.when(met, F.nullif("error_code", F.lit(""))).otherwise(F.col("_error")).alias("error_code"),
        F.when(met, F.col("sha256")).alias("sha256"), F.when(met, F.col("storage_key")).alias("storage_key"))
    problems = cut(pre_upload_problems(docs))
    held = problems.select(F.col("path").alias("_p")).distinct()
    keys = spark.createDataFrame([], "storage_key string") if stored_keys is None else stored_keys
    have = keys.select(F.col("storage_key").alias("_k")).distinct()
    tried = docs.where("status <> 'DUPLICATE'").join(held, F.col("path") == F.col("_p"), "left").join(have, F.col("storage_key") == F.col("_k"), "left")
    uploads = cut(tried.select("storage_key", "path", F.when(F.col("_p").isNotNull(), "FAILED").when(F.col("_k").isNotNull(), "EXISTS").otherwise("NEW").alias("outcome")))
    changed = mapping.select("ord", F.col("code").alias("supplier_reference"), "mpn", F.col("published_url").alias("url"), "status")
    before = known.select("part_id", F.col("code").alias("supplier_reference"), "mpn", F.col("url").alias("datasheet_url"))
    return AssetRun(docs, moved, mapping, apply_map(before, changed, prune), problems, uploads, asset_invariants(outcome_totals(uploads)))
