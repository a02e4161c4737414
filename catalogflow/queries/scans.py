"""Queries over folders of many files: envelopes, dated snapshots, side files of pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.queries.registry import query
from catalogflow.schemas import strings
from catalogflow.session import shared_dir
from catalogflow.sinks.files import write_documents
from catalogflow.sources import files


def _fresh_dir(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _delivered(spark, rows, name):
    """The folder with the files of ``rows`` (name, content as text), written by many tasks into many shards."""
    folder = _fresh_dir(spark, name)
    n = b.tasks_for(rows)
    dealt = b.dealt(rows.select("name", F.encode("content", "UTF-8").alias("content")), "name", n=n)
    write_documents(dealt, folder, shards=n).write.format("noop").mode("overwrite").save()
    return folder


# ---- envelopes (S4, F47) -----------------------------------------------------------------

def _envelopes(spark, sf):
    """A file per part. Every tenth is cut short, every eleventh has another name, every thirteenth is no object."""
    p, t = b.parts(spark, sf), lambda c: F.col(c).cast("string")
    product = F.struct(
        F.concat(F.lit(" "), "cid").alias("productCode"), F.col("mpn").alias("productModel"), F.col("manufacturer").alias("brandNameEn"), F.col("category").alias("wmCatalogNameEn"),
        F.col("parent_catalog").alias("parentCatalogName"), F.col("description").alias("productNameEn"), F.when(F.col("size") % 2 == 0, F.concat(F.lit("size "), t("size"))).alias("productIntroEn"),
        F.col("catalog_name").alias("catalogName"), F.col("size").cast("long").alias("catalogId"), F.array(F.struct(F.lit(7).alias("catalogId"), F.lit("Root").alias("catalogNameEn"))).alias("parentCatalogList"),
        F.lit("EAR99").alias("eccn"), F.array(F.lit(" "), F.concat(F.lit("https://i/"), "cid")).alias("productImages"))
    other = F.when(F.col("ord") % 4 == 0, F.array(F.struct(F.concat(F.lit("ALT-"), t("ord")).alias("productModel"), F.lit("B").alias("brandNameEn")), F.struct(F.lit("Z9").alias("productModel"), F.lit("B").alias("brandNameEn"))))
    text = F.to_json(F.struct(F.col("cid").alias("c_number"), F.struct(product.alias("main_product"), other.alias("alternatePartList")).alias("source_raw")))
    body = F.when(F.col("ord") % 10 == 3, F.substring(text, 1, 40)).when(F.col("ord") % 13 == 5, F.lit("[1]")).otherwise(text)
    return p.select(F.concat(F.when(F.col("ord") % 11 == 2, "X").otherwise(""), F.col("cid"), F.lit(".json")).alias("name"), body.alias("content"))


@query(b.sql("""SELECT cid AS key, mpn, manufacturer AS manufacturer_raw, category AS "catalogName", parent_catalog AS "parentCatalogName", CASE WHEN size%2=0 THEN description||' - size '||size ELSE description END AS description,
  CASE WHEN size%2=0 THEN 'size '||size ELSE '' END AS introduction, cid AS supplier_sku, 'https://i/'||cid AS source_image_url, CASE WHEN ord%4=0 THEN 'ALT-'||ord||'; Z9' ELSE '' END AS alternative_parts, 'EAR99' AS eccn,
  catalog_name AS lcsc_leaf_name, CAST(size AS VARCHAR) AS lcsc_leaf_id, 'Root' AS lcsc_parent_name, '2' AS lcsc_depth FROM parts_v WHERE ord%10<>3 AND ord%13<>5 AND ord%11<>2""", "parts_v"))
def envelopes_flat(spark, sf):
    read = files.scan_envelopes(spark, _delivered(spark, _envelopes(spark, sf), "envelopes"))
    flat = files.flatten_envelope(read.where("damaged IS NULL"))
    return flat.select("key", "mpn", "manufacturer_raw", "catalogName", "parentCatalogName", "description", "introduction", "supplier_sku", "source_image_url", "alternative_parts", "eccn",
                       "lcsc_leaf_name", "lcsc_leaf_id", "lcsc_parent_name", "lcsc_depth")


@query(b.sql("""SELECT cid AS key, CASE WHEN ord%10=3 THEN 40 ELSE 3 END AS n FROM parts_v WHERE (ord%10=3 OR ord%13=5) AND ord%11<>2""", "parts_v"))
def envelopes_damaged(spark, sf):
    read = files.scan_envelopes(spark, _delivered(spark, _envelopes(spark, sf), "envelopes"))
    return read.where("damaged IS NOT NULL").select("key", F.length("damaged").alias("n"))


# ---- dated snapshots (S9) -----------------------------------------------------------------

@query(b.sql("""SELECT mpn, CAST(ord AS VARCHAR) AS ord, category FROM parts_v WHERE ord%3<>0 QUALIFY row_number() OVER (PARTITION BY mpn ORDER BY ord DESC)=1""", "parts_v"))
def newest_snapshot(spark, sf):
    """Three dated snapshots; the last has the fewest rows, and each part number in it many times."""
    folder, p = _fresh_dir(spark, "snapshots"), b.parts(spark, sf).select("mpn", F.col("ord").cast("string").alias("ord"), "category")
    for date, rows in (("2025-03-01", p.where("ord % 3 <> 0")), ("2025-01-31", p), ("2025-02-15", p.where("ord % 2 = 0"))):
        rows.orderBy(F.col("ord").cast("long")).write.option("header", True).csv(f"{folder}/catalog_{date}")
    return files.newest_of_family(spark, folder, r"catalog_(\d{4}-\d{2}-\d{2})", strings("mpn", "ord", "category"))


# ---- side files (S16) ---------------------------------------------------------------------

def _side_files(spark, sf):
    """A file for every third part by slug, one for some part numbers, some damaged, some without a version."""
    p = b.parts(spark, sf)
    body = F.when(F.col("ord") % 5 == 0, F.lit('{"schema_version"')).when(F.col("ord") % 5 == 1, F.concat(F.lit('{"n":'), F.col("ord").cast("string"), F.lit("}"))).otherwise(
        F.concat(F.lit('{"schema_version":"1","n":'), F.col("ord").cast("string"), F.lit("}")))
    by_slug = p.where("ord % 3 = 0").select(F.concat(F.lit("s"), F.col("ord").cast("string")).alias("n"), body.alias("content"))
    by_mpn = p.where("mpn < 'M'").select("mpn").distinct().select(F.lower("mpn").alias("n"), F.concat(F.lit('{"schema_version":2,"mpn":"'), "mpn", F.lit('"}')).alias("content"))
    rows = by_slug.unionByName(by_mpn).select(F.concat("n", F.lit(".content.json")).alias("name"), "content")
    return p.select("ord", F.concat(F.lit("s"), F.col("ord").cast("string")).alias("url_slug"), "mpn"), _delivered(spark, rows, "side-files")


@query(b.sql("""SELECT ord, CASE WHEN ord%3=0 AND ord%5>1 THEN sha256('{"schema_version":"1","n":'||ord||'}') WHEN mpn<'M' THEN sha256('{"schema_version":2,"mpn":"'||mpn||'"}') ELSE 'NO_ENRICH' END AS enrich_fp FROM parts_v""", "parts_v"))
def enrichment_attached(spark, sf):
    p, folder = _side_files(spark, sf)
    return files.attach_enrichment(p, files.read_enrichment(spark, folder)[0]).select("ord", "enrich_fp")


@query(b.sql("""SELECT 's'||ord AS name, CASE WHEN ord%5=0 THEN 'invalid JSON' ELSE 'no schema_version' END AS reason FROM parts_v WHERE ord%3=0 AND ord%5<2""", "parts_v"))
def enrichment_skipped(spark, sf):
    return files.read_enrichment(spark, _side_files(spark, sf)[1])[1]
