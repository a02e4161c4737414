"""Small files and logs: written from the given tables, read by the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.plans import audit
from catalogflow.queries.registry import query
from catalogflow.session import shared_dir
from catalogflow.sinks import files as sinks
from catalogflow.sources import files as sources


def _fresh_dir(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _one_document(spark, rows, name):
    """A folder with one text file that holds the only row of ``rows``."""
    path = _fresh_dir(spark, name)
    rows.write.text(path)
    return path


def _brands(spark, sf):
    """One row per brand: the dictionaries here have an entry for each."""
    return b.parts(spark, sf).groupBy("manufacturer").agg(F.min("ord").alias("first"))


# ---- dictionaries (S6, S8, S12, S13) -----------------------------------------------------

@query(b.sql("""WITH m AS (SELECT manufacturer, min(ord) AS f FROM parts_v GROUP BY 1) SELECT 'keys' AS field, manufacturer AS key, 'B'||f AS value FROM m UNION ALL SELECT 'pairs', manufacturer, 'Z'||f FROM m
  UNION ALL SELECT 'all', manufacturer, 'A'||f FROM m""", "parts_v"))
def lexicons(spark, sf):
    """An object in a field, a list of pairs in a field, and a whole file."""
    m = _brands(spark, sf)
    entry = lambda mark: F.map_from_entries(F.collect_list(F.struct("manufacturer", F.concat(F.lit(mark), F.col("first").cast("string")))))
    pair = F.collect_list(F.struct(F.col("manufacturer").alias("zh"), F.concat(F.lit("Z"), F.col("first").cast("string")).alias("en")))
    both = _one_document(spark, m.agg(F.to_json(F.struct(entry("B").alias("keys"), pair.alias("pairs"))).alias("value")), "lexicon")
    whole = _one_document(spark, m.agg(F.to_json(entry("A")).alias("value")), "lexicon")
    read = lambda path, field, name: sources.read_lexicon(spark, path, field).select(F.lit(name).alias("field"), "key", "value")
    return read(both, "keys", "keys").unionByName(read(both, "pairs", "pairs")).unionByName(read(whole, None, "all"))


@query(b.sql("""WITH m AS (SELECT manufacturer, min(ord) AS f FROM parts_v GROUP BY 1) SELECT 'top' AS kind, lower(manufacturer) AS slug, manufacturer AS name, CASE f%3 WHEN 0 THEN 'review' WHEN 1 THEN 'active' ELSE 'hidden' END AS status FROM m
  UNION ALL SELECT 'l1', 'l-'||lower(manufacturer), lower(manufacturer), 'active' FROM m""", "parts_v"))
def taxonomy_read(spark, sf):
    """States in another letter case and missing ones."""
    m, slug = _brands(spark, sf), F.lower("manufacturer")
    state = F.when(F.col("first") % 3 == 0, " Review ").when(F.col("first") % 3 == 2, "HIDDEN")
    tops = F.collect_list(F.struct(slug.alias("slug"), F.col("manufacturer").alias("name"), state.alias("publish_status")))
    l1 = F.collect_list(F.struct(F.concat(F.lit("l-"), slug).alias("slug"), slug.alias("top_scope"), F.lit(" ").alias("publish_status")))
    t, l = sources.read_taxonomy(spark, _one_document(spark, m.agg(F.to_json(F.struct(tops.alias("top_scopes"), l1.alias("l1_categories"))).alias("value")), "taxonomy"))
    return t.select(F.lit("top").alias("kind"), "slug", "name", F.col("publish_status").alias("status")).unionByName(l.select(F.lit("l1").alias("kind"), "slug", F.col("top_scope").alias("name"), F.col("publish_status").alias("status")))


@query("""SELECT 'u'||user_id AS mpn, event_type AS status, CAST(event_id AS BIGINT) AS file_size, wrapped FROM events, (SELECT unnest([true, false]) AS wrapped)""")
def ledgers_read(spark, sf):
    """A ledger file per user, as a list and as an object around it."""
    e = b.read(spark, sf, "events").groupBy("user_id").agg(F.collect_list(F.struct(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("mpn"), F.col("event_type").alias("status"), F.col("event_id").alias("file_size"))).alias("records"))
    out = None
    for wrapped, body in ((True, F.to_json(F.struct("records"))), (False, F.to_json("records"))):
        path = _fresh_dir(spark, "ledger")
        files = e.select(F.concat(F.col("user_id").cast("string"), F.lit(".json")).alias("name"), F.encode(body, "UTF-8").alias("content"))
        sinks.write_documents(files, path).write.format("noop").mode("overwrite").save()
        one = sources.read_ledger(spark, path).select("mpn", "status", "file_size", F.lit(wrapped).alias("wrapped"))
        out = one if out is None else out.unionByName(one)
    return out


@query(b.sql("""SELECT 'patch' AS kind, cid AS key, description||', "q"' AS value FROM parts_v UNION ALL SELECT 'frozen', cid, 'https://x/'||ord FROM parts_v""", "parts_v"))
def patches_and_overrides(spark, sf):
    """Columns in another order, one more than required, quotes; S12: a frozen table, and none."""
    p, patch, frozen = b.parts(spark, sf), _fresh_dir(spark, "patch"), _fresh_dir(spark, "frozen")
    p.select(F.concat("description", F.lit(', "q"')).alias("description"), F.lit("x").alias("other"), F.col("cid").alias("code")).write.option("header", True).option("escape", '"').csv(patch)
    p.select(F.col("cid").alias("slug"), F.concat(F.lit("https://x/"), F.col("ord").cast("string")).alias("url")).write.option("header", True).csv(frozen)
    read = sources.read_patch(spark, patch, ["code", "description"]).select(F.lit("patch").alias("kind"), F.col("code").alias("key"), F.col("description").alias("value"))
    kept = sources.read_overrides(spark, frozen).unionByName(sources.read_overrides(spark, _fresh_dir(spark, "none")))
    return read.unionByName(kept.select(F.lit("frozen").alias("kind"), F.col("slug").alias("key"), F.col("url").alias("value")))


# ---- ranked feed (S15) ------------------------------------------------------------------

@query(b.sql("""WITH r AS (SELECT *, ord//10+1 AS page, ord%10+1 AS pos FROM parts_v)
  SELECT CAST((page-1)*100+pos AS INTEGER) AS rank, cid AS supplier_sku, mpn, manufacturer AS manufacturer_raw, CASE WHEN ord%2=0 THEN 'Power MOSFET' ELSE 'Odd' END AS "catalogName", CASE WHEN ord%2=0 THEN 'MOSFET' ELSE '' END AS category,
  CASE WHEN ord%3=0 THEN '{"a":"'||ord||'","b":"2"}' ELSE '{}' END AS attributes_json, CASE WHEN ord%5=0 THEN 'https://i/'||ord||'.jpg' ELSE '' END AS source_image_url, 'https://d/'||ord||'.pdf' AS source_datasheet_url FROM r""", "parts_v"))
def ranked_feed(spark, sf):
    """Pages of ten products; blank parameters and repeated ones, of which the last counts."""
    p, n = b.parts(spark, sf), F.col("ord").cast("string")
    param = lambda k, v: F.struct(F.lit(k).alias("paramName"), v.alias("paramValue"))
    params = F.when(F.col("ord") % 3 == 0, F.array(param(" a", F.lit("1")), param("", F.lit("9")), param("a", n), param("b", F.lit(" 2 ")), param("c", F.lit(" ")))).otherwise(F.array(param("x", F.lit(""))))
    product = F.struct(
        F.col("cid").alias("productCode"), F.concat(F.lit(" "), "mpn").alias("productModel"), F.col("manufacturer").alias("brandNameEn"), F.when(F.col("ord") % 2 == 0, "Power MOSFET").otherwise("Odd").alias("catalogName"),
        F.concat(F.lit("https://d/"), n, F.lit(".pdf?x=1")).alias("pdfUrl"), F.when(F.col("ord") % 5 == 0, F.array(F.concat(F.lit("https://i/"), n, F.lit(".jpg?w=2")))).alias("productImages"), params.alias("paramVOList"))
    pages = p.groupBy((F.floor(F.col("ord") / 10) + 1).alias("page")).agg(F.array_sort(F.collect_list(F.struct("ord", product.alias("p")))).alias("l"))
    return sources.flatten_ranked_feed(pages.select("page", F.transform("l", lambda x: x["p"]).alias("products")))


# ---- writers (K4s, K8s, K9s) -------------------------------------------------------------

@query(b.sql("""SELECT ord, CASE WHEN size>25 THEN '{"ord":'||ord||',"mpn":"'||mpn||'"}' ELSE '{"ord":'||ord||'}' END AS line FROM parts_v""", "parts_v"))
def catalog_lines(spark, sf):
    """K4s: null fields are left out of the record."""
    path = _fresh_dir(spark, "catalog")
    sinks.write_catalog(b.parts(spark, sf).select("ord", F.when(F.col("size") > 25, F.col("mpn")).alias("mpn")), path)
    return spark.read.text(path).select(F.get_json_object("value", "$.ord").cast("long").alias("ord"), F.col("value").alias("line"))


@query("""SELECT user_id, event_id FROM events UNION ALL SELECT user_id, event_id FROM events WHERE event_type='error'""")
def log_appended(spark, sf):
    """K8s: a second write adds to the first."""
    path, e = _fresh_dir(spark, "log"), b.read(spark, sf, "events")
    sinks.append_log(e.select("user_id", "event_id"), path)
    sinks.append_log(e.where("event_type = 'error'").select("user_id", "event_id"), path)
    return spark.read.schema("user_id long, event_id long").json(path)


@query(b.sql("""SELECT category AS top, lower(manufacturer) AS slug, count(*) AS n, 'v7' AS version, row_number() OVER (ORDER BY category, lower(manufacturer)) AS pos FROM parts_v GROUP BY 1,2""", "parts_v"))
def page_manifest(spark, sf):
    """K9s: the order of the lines is part of the result."""
    path = _fresh_dir(spark, "manifest")
    groups = b.parts(spark, sf).groupBy(F.col("category").alias("top"), F.lower("manufacturer").alias("slug")).agg(F.count(F.lit(1)).alias("n"))
    sinks.write_page_manifest(groups, path, "v7")
    lines = spark.read.schema("top string, slug string, n long, version string").json(path).select("*", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("o"))
    listed = lines.agg(F.array_sort(F.collect_list(F.struct("o", "top", "slug", "n", "version"))).alias("l"))
    return listed.select(F.posexplode("l").alias("p", "x")).select("x.top", "x.slug", "x.n", "x.version", (F.col("p") + 1).alias("pos"))


# ---- dictionaries from pages, patch from pages (B13, B19) ----------------------------------

def _listing(page, k, mark, name):
    return F.concat(F.lit('<a href="https://www.example.com/catalog/'), (page * 10 + k).cast("string"), F.lit(f'.html{mark}">'), name, F.lit("</a>"))


@query("""SELECT 'CAT-'||format('{:04d}', (page_id-first)*3+k+1) AS cat_id, k+1 AS level, CASE k WHEN 0 THEN 'Top '||page_id WHEN 1 THEN 'Middle' ELSE 'Leaf' END AS name,
  CASE k WHEN 1 THEN CAST(page_id*10 AS VARCHAR) WHEN 2 THEN CAST(page_id*10+1 AS VARCHAR) END AS parent_id FROM (SELECT page_id, (SELECT min(page_id) FROM pages) AS first FROM pages), range(3) r(k)""")
def category_dictionary(spark, sf):
    """A tree of three levels on every page."""
    i = F.col("page_id")
    html = F.concat(_listing(i, 0, "?.ls.ca.", F.concat(F.lit("Top "), i.cast("string"), F.lit(" (12)"))), _listing(i, 1, "?.ca.cal.", F.lit("Middle")), _listing(i, 2, "?.cal.ke.", F.lit("Leaf")), F.coalesce("html", F.lit("")))
    return audit.category_dictionary(b.read(spark, sf, "pages").select("page_id", html.alias("html"))).select("cat_id", "level", "name", "parent_id")


@query("""SELECT page_id AS ord, 'C'||page_id AS supplier_reference, CASE WHEN page_id%3=2 THEN '{"Volts":"5"}' ELSE '{"Volts":"5","Package":"SOT-'||page_id||'"}' END AS attributes_json,
  CASE WHEN page_id%3=2 THEN 'own' ELSE 'own; Motors; Lamps' END AS applications, CASE WHEN page_id%3=2 THEN 'A1' ELSE 'A1; ALT'||page_id END AS alternative_parts, CASE WHEN page_id%2=0 THEN 'curated' WHEN page_id%3=2 THEN '' ELSE 'Part '||page_id||' of '||url END AS description,
  CASE WHEN page_id%3=2 THEN '' ELSE 'Q: Why '||page_id||'??A: Because' END AS faq FROM pages""")
def pages_to_patch(spark, sf):
    """Facts of a page with data, lists and an alternates table, in a patch beside curated values; every third page has none."""
    i = F.col("page_id").cast("string")
    data = F.concat(
        F.lit('<script type="application/ld+json">{"@graph":[{"@type":"Product","description":"Part '), i, F.lit(" of "), F.col("url"), F.lit(', 1,234 in stock","additionalProperty":[{"@type":"PropertyValue","name":"volts","value":"9"},{"@type":"PropertyValue","name":"Package","value":"SOT-'), i,
        F.lit('"}]},{"@type":"FAQPage","mainEntity":[{"name":"Why '), i, F.lit('?","acceptedAnswer":{"text":"<b>Because</b>"}}]}]}</script><section><h2>Applications</h2><ul><li>Motors</li><li> <i>Lamps</i></li></ul></section><h2>Alternative Parts</h2><table><a href="/product-detail/C'), i,
        F.lit('.html">self</a><a href="/product-detail/C0'), i, F.lit('.html"><b>ALT'), i, F.lit("</b></a></table>"))
    pages = b.read(spark, sf, "pages").select(F.col("page_id").alias("ord"), F.concat(F.lit("C"), i).alias("code"), F.concat(F.lit("M"), i).alias("mpn"), F.concat(F.lit("<body>"), F.when(F.col("page_id") % 3 != 2, data).otherwise(""), F.lit("</body>")).alias("html"))
    master = b.read(spark, sf, "pages").select(
        F.col("page_id").alias("ord"), F.concat(F.lit("M"), i).alias("mpn"), F.concat(F.lit("C"), i).alias("supplier_reference"), F.lit('{"Volts":"5"}').alias("attributes_json"), F.lit("own").alias("applications"), F.lit("A1").alias("alternative_parts"),
        F.when(F.col("page_id") % 2 == 0, "curated").otherwise("").alias("description"))
    return audit.enrich(master, pages).select("ord", "supplier_reference", "attributes_json", "applications", "alternative_parts", "description", "faq")
