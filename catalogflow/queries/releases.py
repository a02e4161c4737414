"""Queries over the jobs that write: documents of parts, and releases with versions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions.keys import content_key
from catalogflow.operators import gates
from catalogflow.plans import assets, release
from catalogflow.queries.registry import query
from catalogflow.session import cut, shared_dir
from catalogflow.sinks.files import Versions, write_documents


def _fresh_dir(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- documents of parts (B12) ---------------------------------------------------------

# Of five pages two deliver the same document, one delivers a page, one a document without an end, one nothing. Files are named by
# code or by part number.
_ASSETS_SQL = """p AS (SELECT page_id AS i, page_id%5 AS k, page_id-page_id%5 AS g, 'C'||page_id AS code, 'PG-'||page_id AS mpn, url, coalesce(html,'') AS html FROM pages),
 f AS (SELECT i, k, CASE WHEN i%2=0 THEN code ELSE mpn END||'.pdf' AS name, CASE WHEN k<2 THEN '%PDF-1.7 '||g||' '||repeat('x',1100)||' %%EOF' WHEN k=2 THEN html||repeat(' ',1100) ELSE '%PDF-1.7 '||html||repeat('y',2100) END AS content,
   CASE k WHEN 2 THEN 'NO_PDF_MARK' WHEN 3 THEN 'NO_END_MARK' END AS error FROM p WHERE k<4),
 d AS (SELECT *, sha256(content) AS sha, CASE WHEN error IS NOT NULL THEN 'FAILED' WHEN name=min(name) OVER (PARTITION BY sha256(content)) THEN 'VERIFIED' ELSE 'DUPLICATE' END AS status FROM f)"""


def _asset_run(spark, sf):
    i = F.col("page_id")
    k, n, html = i % 5, i.cast("string"), F.coalesce("html", F.lit(""))
    pages = b.read(spark, sf, "pages").select(
        i.alias("part_id"), F.concat(F.lit("C"), n).alias("code"), F.concat(F.lit("PG-"), n).alias("mpn"), F.concat(F.lit("pg"), n).alias("clean_mpn"),
        F.when(i % 11 == 5, F.concat(F.lit("https://files.r2.dev/old/"), n, F.lit(".pdf"))).otherwise("").alias("url"), F.when(i % 7 == 3, "").otherwise(F.col("url")).alias("source_url"), i.alias("ord"),
        k.alias("k"), F.when(k < 2, F.concat(F.lit("%PDF-1.7 "), (i - k).cast("string"), F.lit(" " + "x" * 1100 + " %%EOF"))).when(k == 2, F.concat(html, F.lit(" " * 1100)))
        .when(k == 3, F.concat(F.lit("%PDF-1.7 "), html, F.lit("y" * 2100))).alias("content"))
    folder = _fresh_dir(spark, "documents")
    files = pages.where("content IS NOT NULL").select(F.concat(F.when(F.col("part_id") % 2 == 0, F.col("code")).otherwise(F.col("mpn")), F.lit(".pdf")).alias("name"), F.encode("content", "UTF-8").alias("content"))
    write_documents(files, folder).write.format("noop").mode("overwrite").save()
    earlier = pages.where("part_id % 10 = 4").select(F.lower("mpn").alias("mpn"), F.lit("https://x/done").alias("source_url"), F.lit("VERIFIED").alias("status"))
    have = pages.where("k = 0 AND part_id % 20 = 0").select(content_key("datasheets/pdf", F.sha2("content", 256)).alias("storage_key"))
    return assets.asset_pipeline(spark, folder, pages.drop("k", "content"), "https://files.r2.dev", earlier, have)


@query(f"""WITH {_ASSETS_SQL} SELECT p.i AS part_id, p.mpn, CASE WHEN p.i%10=4 THEN 'https://x/done' WHEN p.i%7=3 THEN '' ELSE p.url END AS source_url,
  CASE WHEN p.i%10=4 THEN 'VERIFIED' WHEN p.i%7=3 THEN 'SKIPPED' ELSE coalesce(d.status,'DISCOVERED') END AS status, CASE WHEN p.i%10=4 THEN NULL WHEN p.i%7=3 THEN 'NO_URL' ELSE d.error END AS error_code,
  CASE WHEN p.i%10<>4 AND p.i%7<>3 THEN d.sha END AS sha256, CASE WHEN p.i%10<>4 AND p.i%7<>3 AND d.error IS NULL THEN 'datasheets/pdf/'||d.sha[1:2]||'/'||d.sha||'.pdf' END AS storage_key,
  CASE WHEN p.i%11=5 THEN 'https://files.r2.dev/old/'||p.i||'.pdf' WHEN p.k<2 THEN 'https://files.r2.dev/datasheets/'||lower(p.code)||'.pdf' ELSE '' END AS datasheet_url, CASE WHEN p.i%11=5 OR p.k<2 THEN 'set' ELSE 'empty' END AS map_result
  FROM p LEFT JOIN d ON d.i=p.i""")
def asset_ledger(spark, sf):
    run = _asset_run(spark, sf)
    return run.ledger.join(run.master.select("part_id", "datasheet_url", "map_result"), "part_id").select(
        "part_id", "mpn", "source_url", "status", "error_code", "sha256", "storage_key", "datasheet_url", "map_result")


@query(f"""WITH {_ASSETS_SQL}, u AS (SELECT CASE WHEN status='FAILED' THEN 'FAILED' WHEN (i-k)%20=0 THEN 'EXISTS' ELSE 'NEW' END AS o FROM d WHERE status<>'DUPLICATE')
  SELECT count(*) FILTER (WHERE o<>'FAILED') AS uploaded, count(*) FILTER (WHERE o='NEW') AS new_objects, count(*) FILTER (WHERE o='EXISTS') AS already_exists, count(*) FILTER (WHERE o='FAILED') AS failed, count(*) AS total, true AS valid FROM u""")
def asset_totals(spark, sf):
    return _asset_run(spark, sf).totals.select("uploaded", "new_objects", "already_exists", "failed", "total", "valid")


# ---- releases (B5) -------------------------------------------------------------------

def _rows(df):
    return df.groupBy("mpn", "manufacturer").agg(*[F.min(c).alias(c) for c in ("supplier_reference", "category", "description")])


def _projected(rows):
    return gates.project_master(rows.withColumn("native_l1", F.lower("category")))


def _released(spark, sf):
    """A first table, a release, the same one again, two bad ones, and one that is taken back."""
    versions = Versions(spark, _fresh_dir(spark, "master"))
    known = cut(_rows(b.master(spark, sf)))  # both go into several releases, without the columns that are blank
    first = _projected(known)
    new = _projected(cut(_rows(b.batch(spark, sf)).join(known.select("mpn", "manufacturer"), ["mpn", "manufacturer"], "left_anti")))
    assert release.release_version(versions, "start", first).ok
    assert release.release_version(versions, "wave-1", new).ok
    assert release.release_version(versions, "wave-1", new).problems == ["already released"]
    assert not release.release_version(versions, "repeated", new).ok
    assert not release.release_version(versions, "blank", new.withColumns({"mpn": F.concat("mpn", F.lit("-Z")), "description": F.lit("")})).ok
    assert release.release_version(versions, "wave-2", new.withColumn("mpn", F.concat("mpn", F.lit("-Y")))).ok
    versions.rollback("wave-2")
    versions.rollback("wave-2")
    return versions


_RELEASED_SQL = """m AS (SELECT mpn, manufacturer, min(supplier_reference) AS supplier_reference FROM master_v GROUP BY 1,2),
 n AS (SELECT mpn, manufacturer, min(supplier_reference) AS supplier_reference FROM batch_v WHERE (mpn, manufacturer) NOT IN (SELECT (mpn, manufacturer) FROM m) GROUP BY 1,2)"""


@query(b.sql(f"WITH {_RELEASED_SQL} SELECT * FROM m UNION ALL SELECT * FROM n", "master_v", "batch_v"))
def release_current(spark, sf):
    return _released(spark, sf).current().select("mpn", "manufacturer", "supplier_reference")


@query(b.sql(f"""WITH {_RELEASED_SQL}, c AS (SELECT (SELECT count(*) FROM m) AS m, (SELECT count(*) FROM n) AS n)
  SELECT 1 AS "commit", 'apply' AS action, 'start' AS release, m AS rows FROM c UNION ALL SELECT 2, 'apply', 'wave-1', m+n FROM c UNION ALL SELECT 3, 'apply', 'wave-2', m+n+n FROM c UNION ALL SELECT 4, 'rollback', 'wave-2', m+n FROM c""", "master_v", "batch_v"))
def release_log(spark, sf):
    return _released(spark, sf).log().select("commit", "action", "release", "rows")
