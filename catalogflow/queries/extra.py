"""Operators that the larger jobs contain, each on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import attrs, classify, keys, text
from catalogflow.operators import gates, identity, json_tree, merge, ordering
from catalogflow.plans import assets, release
from catalogflow.queries.registry import query


@query(b.sql("""SELECT ord, CASE WHEN category='LARGE' THEN '' WHEN mpn IN (SELECT mpn FROM parts_v WHERE size>48) THEN 'verified' WHEN size>25 THEN 'sourced' ELSE 'fabricated' END AS faq_status FROM parts_v""", "parts_v"))
def faq_provenance(spark, sf):
    p = b.parts(spark, sf).withColumn("faq", F.when(F.col("category") == "LARGE", "").otherwise("Q: a?A: b")).withColumn("supplier_reference", F.col("cid"))
    raw = p.where("size > 25").select(F.col("cid").alias("code"), F.array("description").alias("faqs"))
    return gates.faq_provenance(p, raw, p.where("size > 48").select("mpn")).select("ord", "faq_status")


@query(b.sql("""SELECT ord, CASE WHEN category='SMALL' THEN 'WARN' WHEN category='LARGE' THEN 'FAIL' ELSE 'ok' END AS alternates_status FROM parts_v""", "parts_v"))
def alternates_as_is(spark, sf):
    alt = lambda m: F.struct(m.alias("productModel"), F.lit("").alias("brandNameEn"), F.lit("").alias("productCode"), F.lit("").alias("type"), F.lit("").alias("encapStandard"))
    p = b.parts(spark, sf).withColumn("supplier_reference", F.col("cid"))
    raw = p.where("category <> 'SMALL'").select("ord", F.col("cid").alias("code"), F.array(alt(F.col("mpn")), alt(F.lit(" ")), alt(F.col("description"))).alias("alternates"))
    # an earlier row of each code in the other letter case does not count
    raw = raw.unionByName(raw.select((-1 - F.col("ord")).alias("ord"), F.lower("code").alias("code"), F.array(alt(F.lit("old"))).alias("alternates")))
    listed = F.when(F.col("category") == "LARGE", F.col("mpn")).otherwise(F.concat_ws("; ", "mpn", "description"))
    return gates.alternates_as_is(p.withColumn("alternative_parts", listed), raw).select("ord", "alternates_status")


@query(b.sql("""SELECT ord, CASE WHEN size>25 THEN 'About '||description END AS introduction FROM parts_v""", "parts_v"))
def own_introduction(spark, sf):
    p = b.parts(spark, sf)
    words = F.when(F.col("size") > 25, F.concat(F.lit("About "), F.col("description"))).otherwise(F.concat(F.lit("关于 "), F.col("description")))
    raw = p.select("ord", F.col("cid").alias("key"), words.alias("introduction"))
    raw = raw.unionByName(raw.select((-1 - F.col("ord")).alias("ord"), F.lower("key").alias("key"), F.lit("Old").alias("introduction")))
    return identity.own_introduction(p, raw, "cid", "mpn").select("ord", "introduction")


@query("""SELECT event_id AS ord, CASE event_type WHEN 'error' THEN 'DISCOVERED' WHEN 'click' THEN 'VERIFIED' ELSE 'VERIFIED' END AS status, CASE WHEN event_type IN ('error','click') THEN 0 ELSE 3 END AS retry_count FROM events""")
def ledger_rearmed(spark, sf):
    status = F.when(F.col("status") == "error", "FAILED").when(F.col("status") == "click", "UPLOADING").otherwise("VERIFIED")
    log = b.ledger(spark, sf).select("ord", status.alias("status"), F.lit(3).alias("retry_count"), F.lit("X").alias("error_code"))
    return gates.rearm_failed(log).select("ord", "status", "retry_count")


@query(b.sql("""SELECT category, count(*) AS total, array_to_string(list_slice(list_sort(list(DISTINCT mpn)),1,5),', ') AS examples FROM parts_v GROUP BY 1""", "parts_v"))
def first_reports(spark, sf):
    return ordering.first_reports(b.parts(spark, sf), ["category"], "mpn", 5)


@query("""SELECT count(*) FILTER (WHERE event_type IN ('view','click')) AS uploaded, count(*) FILTER (WHERE event_type='view') AS new_objects, count(*) FILTER (WHERE event_type='click') AS already_exists,
  count(*) FILTER (WHERE event_type NOT IN ('view','click')) AS failed, count(*) AS total, true AS valid FROM events""")
def asset_invariants(spark, sf):
    outcome = F.when(F.col("status") == "view", "NEW").when(F.col("status") == "click", "EXISTS").otherwise("FAILED")
    totals = assets.outcome_totals(b.ledger(spark, sf).select(outcome.alias("outcome")))
    return gates.asset_invariants(totals).select("uploaded", "new_objects", "already_exists", "failed", "total", "valid")


@query(b.sql("""SELECT ord, CASE WHEN size>25 THEN 'cost' ELSE '' END AS leaked, CASE WHEN size>25 THEN 'x.costPrice' ELSE '' END AS isolated, 'a' AS stable, 'stockNumber' AS volatile FROM parts_v""", "parts_v"))
def commercial_keys(spark, sf):
    n = F.col("size").cast("string")
    body = F.when(F.col("size") > 25, F.concat(F.lit('{"a":1,"x":{"cost":'), n, F.lit(',"costPrice":'), n, F.lit("}}"))).otherwise('{"a":1}')
    p = b.parts(spark, sf).withColumn("j", body)
    split = attrs.split_volatile(F.create_map(F.lit("a"), n, F.lit("stockNumber"), n))
    deep = F.col("deep")
    return json_tree.isolate_keys_in(p, "j", "deep").select("ord", F.array_join(attrs.leaked_keys("j"), ",").alias("leaked"), F.array_join(F.transform(deep["isolated"], lambda x: x["path"]), ",").alias("isolated"),
                    F.array_join(F.map_keys(split["stable"]), ",").alias("stable"), F.array_join(F.map_keys(split["volatile"]), ",").alias("volatile"))


@query(b.sql("""SELECT ord, CASE category WHEN 'PROMO' THEN mpn||';Z9;'||description ELSE mpn||';Z9' END AS alternates, mpn||'; Z9' AS merged FROM parts_v""", "parts_v"))
def alternates_union(spark, sf):
    p = b.parts(spark, sf)
    more = F.when(F.col("category") == "PROMO", F.concat_ws("; ", F.lit("Z9"), "description")).otherwise(F.concat_ws(";", F.lit("Z9"), "mpn"))
    return p.select("ord", merge.union_alternates(F.col("mpn"), more).alias("alternates"), keys.merge_semicolon(F.col("mpn"), F.concat_ws(";", F.lower("mpn"), F.lit("Z9"))).alias("merged"))


@query(b.sql("""SELECT ord, CASE WHEN parent_catalog=catalog_name THEN 1 ELSE 2 END AS depth, catalog_name AS leaf_name, parent_catalog AS parent_name, ord AS leaf_id FROM parts_v""", "parts_v"))
def parent_chain(spark, sf):
    node = lambda i, n: F.struct(i.cast("long").alias("catalogId"), F.lit("").alias("catalogName"), n.alias("catalogNameEn"))
    chain = attrs.parent_chain(F.array(node(F.col("size"), F.col("parent_catalog")), node(F.col("ord"), F.col("catalog_name"))), F.col("catalog_name"), F.col("ord"))
    return b.parts(spark, sf).withColumn("c", chain).select("ord", "c.depth", "c.leaf_name", "c.parent_name", "c.leaf_id")


@query(b.sql("""SELECT ord, CASE WHEN mpn IN (SELECT mpn FROM parts_v WHERE size>40) THEN '/products/'||replace(lower(mpn),'-','')||'/' ELSE '/request/?pn='||mpn END AS href FROM parts_v""", "parts_v"))
def canonical_href(spark, sf):
    p = b.parts(spark, sf)
    pages = p.where("size > 40").select(keys.slug_alnum("mpn").alias("slug"))
    return identity.canonical_href(p, pages, "mpn", "/products/", "/request/?pn=").select("ord", "href")


@query(b.sql("""SELECT DISTINCT mpn AS slug FROM parts_v WHERE mpn NOT IN (SELECT mpn FROM parts_v WHERE size>30)""", "parts_v"))
def page_missing(spark, sf):
    p = b.parts(spark, sf).select(F.col("mpn").alias("slug"), "size")
    return gates.page_missing(p.select("slug").distinct(), p.where("size > 30"))


@query(b.sql("""SELECT ord, CASE WHEN rn=1 THEN description ELSE description||'-'||ord END AS seo_slug FROM (SELECT *, row_number() OVER (PARTITION BY description ORDER BY ord) AS rn FROM parts_v)""", "parts_v"))
def unique_seo_slugs(spark, sf):
    p = b.parts(spark, sf).select("ord", F.col("description").alias("base"), F.col("ord").alias("id"))
    return ordering.unique_seo_slugs(p).select("ord", "seo_slug")


@query(b.sql("""WITH p AS (SELECT ord, description AS base, size%7 AS id, row_number() OVER (PARTITION BY description ORDER BY ord) AS n FROM parts_v), l AS (SELECT *, row_number() OVER (PARTITION BY base, id ORDER BY ord) AS m FROM p WHERE n>1),
  c AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY ord) AS k FROM l WHERE m>1), t AS (SELECT base, id FROM l WHERE m=1 AND id>=3),
  free AS (SELECT base, x, row_number() OVER (PARTITION BY base ORDER BY x) AS k FROM (SELECT base, unnest(range(3, max(k)+20)) AS x FROM c GROUP BY base) WHERE (base, x) NOT IN (SELECT (base, id) FROM t))
  SELECT ord, base AS seo_slug FROM p WHERE n=1 UNION ALL SELECT ord, base||'-'||id FROM l WHERE m=1 UNION ALL SELECT c.ord, c.base||'-'||free.x FROM c JOIN free ON free.base=c.base AND free.k=c.k""", "parts_v"))
def unique_seo_slugs_repeated(spark, sf):
    """Seven ids under each base, so most rows take a counter that passes over the ids."""
    p = b.parts(spark, sf).select("ord", F.col("description").alias("base"), (F.col("size") % 7).alias("id"))
    return ordering.unique_seo_slugs(p).select("ord", "seo_slug")


@query(b.sql("""SELECT ord, description='' AS blank_description, CASE WHEN description='' THEN 'description' END AS first_missing FROM (SELECT ord, CASE category WHEN 'SMALL' THEN '' ELSE description END AS description FROM parts_v)""", "parts_v"))
def missing_required(spark, sf):
    p = b.parts(spark, sf).withColumn("description", F.when(F.col("category") == "SMALL", "").otherwise(F.col("description")))
    return p.select("ord", (F.col("description") == "").alias("blank_description"), gates.missing_required().alias("first_missing"))


@query(b.sql("""SELECT b.ord, CASE WHEN l='STOP' THEN 'no' ELSE 'yes' END AS shippable FROM (SELECT ord, CASE category WHEN 'PROMO' THEN 'OK' ELSE 'STOP' END AS l FROM parts_v) b""", "parts_v"))
def supplier_documents(spark, sf):
    url = F.when(F.col("category") == "PROMO", F.concat(F.lit("https://datasheet.lcsc.com/"), F.col("cid"))).otherwise(F.concat(F.lit("https://www.ti.com/"), F.col("cid")))
    return b.parts(spark, sf).select("ord", F.when(gates.supplier_document_url(url) == "", "no").otherwise("yes").alias("shippable"))


@query("""SELECT conv_id, turn, list_aggregate(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text),'[^a-z0-9 ]',' ','g'),'\\s+',' ','g')),' '), lambda x: x<>'' AND x NOT IN ('operational','operation','temp','temps','spec','specs','params','param','pkg','packaging','ic','mcu','max','min','vol','curr','freq')))),'string_agg',' ') AS words FROM conversations""")
def question_words(spark, sf):
    """Word sets of questions; the words that have synonyms are left out on both sides."""
    c = b.read(spark, sf, "conversations")
    replaced = set(text.FAQ_SYNONYMS)
    words = text.question_key(F.regexp_replace(F.lower("text"), r"(?<![a-z0-9])(" + "|".join(sorted(replaced)) + r")(?![a-z0-9])", " "))
    return c.select("conv_id", "turn", F.nullif(F.array_join(words, " "), F.lit("")).alias("words"))


@query(b.sql("""SELECT mpn, manufacturer, status FROM (SELECT coalesce(m.mpn,s.mpn) AS mpn, coalesce(m.manufacturer,s.manufacturer) AS manufacturer, CASE WHEN s.mpn IS NULL THEN 'missing' WHEN m.mpn IS NULL THEN 'extra' WHEN m.d<>s.d THEN 'mismatch' ELSE 'equal' END AS status
  FROM (SELECT mpn, manufacturer, min(last_ship) AS d FROM master_v GROUP BY 1,2) m FULL JOIN (SELECT mpn, manufacturer, min(last_ship) AS d FROM snap_v GROUP BY 1,2) s USING (mpn, manufacturer)) WHERE status<>'equal'""", "master_v", "snap_v"))
def release_verified(spark, sf):
    one = lambda d: d.groupBy("mpn", "manufacturer").agg(F.min("last_ship").alias("description"))
    return release.verify_release(one(b.snapshot_new(spark, sf)), one(b.master(spark, sf)), ("description",)).select("mpn", "manufacturer", "status")


@query(b.sql("""SELECT value, count(*) AS n FROM (SELECT CASE WHEN description LIKE '%plate%' THEN 'unclear / no high-confidence 11-family signal' WHEN description LIKE '%gear%' THEN 'unclear / no high-confidence 11-family signal' ELSE 'unclear / no high-confidence 11-family signal' END AS value FROM parts_v) GROUP BY 1""", "parts_v"))
def inferred_types(spark, sf):
    return b.parts(spark, sf).groupBy(classify.inferred_type("description").alias("value")).agg(F.count(F.lit(1)).alias("n"))
