"""Identity, duplicate, slug, clone and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import keys as k
from catalogflow.operators import gates, identity, ordering
from catalogflow.queries.registry import query

_NORM = "lower(regexp_replace(mpn,'[^A-Za-z0-9]','','g'))"


@query(b.sql("""SELECT b.ord, b.mpn, b.manufacturer FROM batch_v b
  WHERE NOT EXISTS (SELECT 1 FROM master_v m WHERE upper(trim(m.mpn))=upper(trim(b.mpn)) AND trim(m.manufacturer)=trim(b.manufacturer))""", "batch_v", "master_v"))
def exclude_known(spark, sf):
    return identity.exclude_known(b.batch(spark, sf), b.master(spark, sf)).select("ord", "mpn", "manufacturer")


@query(b.sql("""SELECT ord, mpn, manufacturer, CASE WHEN row_number() OVER (PARTITION BY mpn, manufacturer ORDER BY ord)>1 THEN 'self_duplicate'
  WHEN (mpn, manufacturer) IN (SELECT (mpn, manufacturer) FROM master_v) THEN 'duplicate' ELSE 'new' END AS status FROM batch_v""", "batch_v", "master_v"))
def dedup_new(spark, sf):
    return identity.dedup_guard(b.batch(spark, sf), b.master(spark, sf)).rows.select("ord", "mpn", "manufacturer", "status")


@query(b.sql("""SELECT total, new, duplicates, self_duplicates, duplicates/total AS duplicate_rate,
  CASE WHEN self_duplicates>0 THEN 'BATCH_SELF_DUPLICATE' WHEN duplicates>=5 AND duplicates/total>0.2 THEN 'MASS_DUPLICATE' ELSE '' END AS stop_code,
  self_duplicates>0 OR (duplicates>=5 AND duplicates/total>0.2) AS stop FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE s='new') AS new, count(*) FILTER (WHERE s='duplicate') AS duplicates, count(*) FILTER (WHERE s='self') AS self_duplicates
  FROM (SELECT CASE WHEN row_number() OVER (PARTITION BY mpn, manufacturer ORDER BY ord)>1 THEN 'self'
  WHEN (mpn, manufacturer) IN (SELECT (mpn, manufacturer) FROM master_v) THEN 'duplicate' ELSE 'new' END AS s FROM batch_v))""", "batch_v", "master_v"))
def dedup_decision(spark, sf):
    return identity.dedup_guard(b.batch(spark, sf), b.master(spark, sf)).decision


@query(b.sql("""SELECT lower(mpn) AS key, mpn, ord+2 AS line, count(*) OVER k AS n, ord > min(ord) OVER k AS duplicate
  FROM parts_v WINDOW k AS (PARTITION BY mpn) QUALIFY n > 1""", "parts_v"))
def duplicate_mpns(spark, sf):
    return identity.duplicate_mpns(b.parts(spark, sf).withColumn("line", F.col("ord") + 2))


@query(b.sql("""SELECT slug, count(DISTINCT m) AS mpns, min(m) AS first_mpn, max(m) AS last_mpn FROM (
  SELECT split_part(lower(mpn),'-',2) AS slug, lower(mpn) AS m FROM parts_v) GROUP BY 1 HAVING count(DISTINCT m)>1""", "parts_v"))
def slug_collisions(spark, sf):
    p = b.parts(spark, sf).withColumn("slug", F.substring_index(F.lower("mpn"), "-", -1))
    return identity.slug_collisions(p)


@query(b.sql("""SELECT ord, mpn, CASE WHEN row_number() OVER w=1 THEN lower(mpn) ELSE lower(mpn)||'-'||row_number() OVER w END AS url_slug
  FROM parts_v WINDOW w AS (PARTITION BY lower(mpn) ORDER BY ord)""", "parts_v"))
def slugs_assigned(spark, sf):
    return identity.assign_slugs(b.parts(spark, sf), "mpn").select("ord", "mpn", "url_slug")


@query(b.sql("""WITH RECURSIVE x AS (SELECT ord, mpn, CASE WHEN size>25 THEN lower(mpn) ELSE lower(mpn)||'-'||size END AS base, row_number() OVER (PARTITION BY mpn ORDER BY ord) AS i, count(*) OVER (PARTITION BY mpn) AS n FROM parts_v),
  r AS (SELECT DISTINCT mpn, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS used, '' AS slug FROM x UNION ALL
   SELECT mpn, i, list_append(used, slug), slug FROM (SELECT x.mpn, x.i, r.used, list_filter(list_concat([x.base], list_transform(range(2, x.n+3), lambda k: x.base||'-'||k)), lambda c: NOT list_contains(r.used, c))[1] AS slug FROM r JOIN x ON x.mpn=r.mpn AND x.i=r.i+1))
  SELECT x.ord, x.base, r.slug AS url_slug FROM x JOIN r USING (mpn, i)""", "parts_v").replace("WITH parts_v", "WITH RECURSIVE parts_v").replace("), RECURSIVE x AS", "), x AS"))
def slugs_numbered_bases(spark, sf):
    """Bases that look numbered themselves; in SQL one by one within each part number, since only bases of one can meet."""
    p = b.parts(spark, sf).withColumn("base", F.when(F.col("size") > 25, F.lower("mpn")).otherwise(
        F.concat_ws("-", F.lower("mpn"), F.col("size").cast("string"))))
    return identity.assign_slugs(p, "base").select("ord", "base", "url_slug")


@query(b.sql("""SELECT ord, mpn, manufacturer, CASE WHEN rn=1 THEN seed ELSE seed||'-'||rn END AS url_slug FROM (
  SELECT *, row_number() OVER (PARTITION BY seed ORDER BY ord) AS rn FROM (
   SELECT *, CASE WHEN ord=min(ord) OVER (PARTITION BY cm) THEN cm ELSE cm||'-'||trim(regexp_replace(lower(manufacturer),'[^a-z0-9]+','-','g'),'-') END AS seed
   FROM (SELECT *, regexp_replace(lower(mpn),'[^a-z0-9]','','g') AS cm FROM parts_v)))""", "parts_v"))
def slugs_stable_fresh(spark, sf):
    p = b.parts(spark, sf).withColumn("supplier_reference", F.col("cid"))
    none = p.limit(0).select(F.col("cid").alias("code"), "mpn", "manufacturer", F.lit("").alias("slug"))
    return identity.assign_stable_slugs(p, none).select("ord", "mpn", "manufacturer", "url_slug")


@query(b.sql("""WITH p AS (SELECT *, regexp_replace(lower(mpn),'[^a-z0-9]','','g') AS cm, lower(manufacturer) AS k, ord%5=0 AS dep FROM parts_v),
  pr AS (SELECT cm, k, min('old-'||ord) AS slug FROM p WHERE dep GROUP BY 1,2 HAVING count(*)=1),
  s AS (SELECT p.*, CASE WHEN dep THEN 0 ELSE 1000000000000 END+ord AS pos, CASE WHEN dep THEN 'old-'||ord ELSE pr.slug END AS fixed FROM p LEFT JOIN pr USING (cm, k)),
  f AS (SELECT coalesce(fixed, cm) AS claim, min(pos) AS pos FROM s GROUP BY 1),
  e AS (SELECT s.*, coalesce(fixed, CASE WHEN f.pos<s.pos THEN s.cm||'-'||trim(regexp_replace(k,'[^a-z0-9]+','-','g'),'-') ELSE s.cm END) AS seed FROM s LEFT JOIN f ON f.claim=s.cm)
  SELECT ord, mpn, manufacturer, CASE WHEN rn=1 THEN seed ELSE seed||'-'||rn END AS url_slug FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY pos) AS rn FROM e)""", "parts_v"))
def slugs_stable_deployed(spark, sf):
    """Every fifth part is published already; parts of the same number and maker as one of them, of several, and of none."""
    p = b.parts(spark, sf).withColumn("supplier_reference", F.col("cid"))
    deployed = p.where("ord % 5 = 0").select(F.col("cid").alias("code"), "mpn", "manufacturer", F.concat(F.lit("old-"), F.col("ord").cast("string")).alias("slug"))
    return identity.assign_stable_slugs(p, deployed).select("ord", "mpn", "manufacturer", "url_slug")


@query(b.sql(f"""SELECT key, array_to_string(list_sort(list(DISTINCT maker)),',') AS makers, sum(n) AS codes FROM (
  SELECT {_NORM} AS key, lower(regexp_replace(manufacturer,'[^A-Za-z0-9]','','g')) AS maker, count(DISTINCT cid) AS n FROM parts_v GROUP BY 1,2) GROUP BY 1""", "parts_v"))
def clone_families(spark, sf):
    return identity.clone_index(b.parts(spark, sf)).select("key", F.array_join("makers", ",").alias("makers"), "codes")


def _linked(spark, sf):
    """Parts with a document link: stored under the part number, under the code, or at a maker."""
    url = (
        F.when(F.col("category") == "PROMO", F.concat(F.lit("https://www.ti.com/"), F.lower("mpn"), F.lit(".pdf")))
        .when(F.col("category") == "ECONOMY", F.concat(F.lit("https://datasheet.lcsc.com/"), F.col("cid"), F.lit(".pdf")))
        .when(F.col("category") == "LARGE", F.lit(""))
        .when((F.col("category") == "SMALL") & (F.col("size") > 25), F.concat(F.lit("https://files.r2.dev/d/"), F.replace(F.lower("mpn"), F.lit("-"), F.lit("_")), F.lit(".pdf")))
        .when(F.col("category") == "SMALL", F.concat(F.lit("https://files.r2.dev/d/"), F.lower("mpn"), F.lit(".pdf")))
        .when(F.col("category") == "MEDIUM", F.concat(F.lit("http://mirror.notti.com/"), F.col("cid"), F.lit(".pdf")))
        .otherwise(F.concat(F.lit("https://files.r2.dev/d/"), F.col("cid"), F.lit(".pdf"))))
    return b.parts(spark, sf).withColumn("datasheet_url", url).withColumn("supplier_reference", F.col("cid"))


_LINKED = """linked AS (SELECT *, cid AS supplier_reference, CASE category WHEN 'PROMO' THEN 'https://www.ti.com/'||lower(mpn)||'.pdf'
 WHEN 'ECONOMY' THEN 'https://datasheet.lcsc.com/'||cid||'.pdf' WHEN 'LARGE' THEN '' WHEN 'SMALL' THEN 'https://files.r2.dev/d/'||CASE WHEN size>25 THEN replace(lower(mpn),'-','_') ELSE lower(mpn) END||'.pdf'
 WHEN 'MEDIUM' THEN 'http://mirror.notti.com/'||cid||'.pdf' ELSE 'https://files.r2.dev/d/'||cid||'.pdf' END AS datasheet_url FROM parts_v),
 hosted AS (SELECT *, CASE category WHEN 'PROMO' THEN 'OK_OEM' WHEN 'ECONOMY' THEN 'BAD_SUPPLIER' WHEN 'LARGE' THEN '' WHEN 'MEDIUM' THEN 'BAD_SHAPE' ELSE 'OK_STORAGE' END AS verdict,
  CASE category WHEN 'PROMO' THEN 'www.ti.com' WHEN 'ECONOMY' THEN 'datasheet.lcsc.com' WHEN 'LARGE' THEN '' WHEN 'MEDIUM' THEN 'mirror.notti.com' ELSE 'files.r2.dev' END AS host FROM linked)"""


@query(b.sql(f"""WITH {_LINKED} SELECT ord, mpn, n AS clone_makers, n>1 AND category='SMALL' AND size<=25 AS clone_stop
  FROM linked JOIN (SELECT mpn AS m, count(DISTINCT manufacturer) AS n FROM parts_v GROUP BY 1) ON m=mpn""", "parts_v"))
def clone_gate(spark, sf):
    idx = identity.clone_index(b.parts(spark, sf))
    return identity.clone_key_flag(_linked(spark, sf), idx, gates.OEM_HOSTS).select("ord", "mpn", "clone_makers", "clone_stop")


@query(b.sql(f"""WITH {_LINKED} SELECT ord, CASE WHEN n>1 AND category='SMALL' AND size<=25 THEN '' ELSE datasheet_url END AS datasheet_url, CASE WHEN n>1 AND category='SMALL' AND size<=25 AND size%2=0 THEN '' WHEN size%2=0 THEN datasheet_url ELSE 'other.pdf' END AS document, n>1 AND category='SMALL' AND size<=25 AS scrubbed
  FROM linked JOIN (SELECT mpn AS m, count(DISTINCT manufacturer) AS n FROM parts_v GROUP BY 1) ON m=mpn""", "parts_v"))
def clone_keys_scrubbed(spark, sf):
    idx = identity.clone_index(b.parts(spark, sf))
    rows = _linked(spark, sf).withColumn("document", F.when(F.col("size") % 2 == 0, F.col("datasheet_url")).otherwise("other.pdf"))
    return identity.scrub_clone_keys(rows, idx, gates.OEM_HOSTS, others=["document"]).select("ord", "datasheet_url", "document", "scrubbed")


@query(b.sql(f"""WITH {_LINKED}, d AS (SELECT DISTINCT lower(mpn) AS mpn, lower(regexp_replace(manufacturer,'[^A-Za-z0-9]','','g')) AS maker, datasheet_url AS ref FROM linked),
 pm AS (SELECT mpn, maker, count(*) FILTER (WHERE ref<>'') AS refs FROM d GROUP BY 1,2),
 f AS (SELECT mpn, count(*) AS makers FROM pm GROUP BY 1), s AS (SELECT mpn, count(DISTINCT ref) AS all_refs FROM d WHERE ref<>'' GROUP BY 1)
 SELECT 'STOP' AS level, 'DATASHEET_IDENTITY_FAIL' AS kind, mpn, maker FROM pm JOIN f USING (mpn) WHERE makers=1 AND refs>1
 UNION ALL SELECT CASE WHEN all_refs=1 THEN 'STOP' ELSE 'WARN' END, CASE WHEN all_refs=1 THEN 'DATASHEET_IDENTITY_FAIL' ELSE 'DATASHEET_CLONE_MPN' END, mpn, '' FROM f LEFT JOIN s USING (mpn) WHERE makers>1
 UNION ALL SELECT 'WARN','DATASHEET_CLONE_MPN', mpn, maker FROM pm JOIN f USING (mpn) WHERE makers>1 AND refs>1""", "parts_v"))
def document_identity(spark, sf):
    return gates.document_identity(_linked(spark, sf), "datasheet_url")


@query(b.sql(f"""WITH {_LINKED} SELECT ord, verdict, host FROM hosted""", "parts_v"))
def host_verdicts(spark, sf):
    h = gates.classify_host("datasheet_url")
    return _linked(spark, sf).select("ord", h["verdict"].alias("verdict"), h["host"].alias("host"))


@query(b.sql(f"""WITH {_LINKED} SELECT verdict, host, count(*) AS n FROM hosted GROUP BY 1,2""", "parts_v"))
def host_histogram(spark, sf):
    return gates.host_histogram(_linked(spark, sf))


@query("""SELECT CASE WHEN url LIKE '%example.com%' OR url NOT LIKE 'https://%' OR regexp_matches(url,'#$') THEN 'BAD_SHAPE' ELSE 'BAD_UNKNOWN' END AS verdict,
  lower(regexp_extract(url,'^[a-z]+://([^/?#]+)',1)) AS host, count(*) AS n FROM pages GROUP BY 1,2""")
def page_host_histogram(spark, sf):
    return gates.host_histogram(b.read(spark, sf, "pages"), "url")


@query(b.sql(f"""WITH {_LINKED}, st AS (SELECT * FROM hosted WHERE verdict='OK_STORAGE'),
 bm AS (SELECT mpn AS m, arg_min(datasheet_url, ord) AS u FROM st GROUP BY 1)
 SELECT ord, CASE WHEN verdict='' THEN 'NODATA' WHEN verdict IN ('OK_STORAGE','OK_OEM') THEN 'SHIP' WHEN verdict='BAD_SUPPLIER' AND u IS NOT NULL THEN 'REWRITE' ELSE 'STOP' END AS action,
  CASE WHEN verdict='BAD_SUPPLIER' AND u IS NOT NULL THEN 'mpn' ELSE '' END AS rewrite_path,
  CASE WHEN verdict='BAD_SUPPLIER' AND u IS NOT NULL THEN u ELSE datasheet_url END AS datasheet_url FROM hosted LEFT JOIN bm ON m=mpn""", "parts_v"))
def host_actions(spark, sf):
    linked = _linked(spark, sf)
    by_code, by_mpn = gates.storage_index(linked)
    return gates.host_actions(linked, by_code, by_mpn).select("ord", "action", "rewrite_path", "datasheet_url")


@query(b.sql("""SELECT ord, lower(mpn)||'-'||ord AS slug, arg_min(lower(mpn)||'-'||ord, CASE WHEN brand=manufacturer THEN (0, ord, '', '', '') ELSE (1, 0, lower(category), lower(manufacturer), lower(mpn)||'-'||ord) END)
   OVER (PARTITION BY replace(lower(mpn),'-','')) AS primary_slug, count(*) OVER (PARTITION BY replace(lower(mpn),'-','')) AS group_size
  FROM (SELECT *, CASE WHEN size>45 THEN manufacturer ELSE 'other' END AS brand FROM parts_v)""", "parts_v"))
def duplicate_primary(spark, sf):
    return identity.duplicate_primary(_sluggish(spark, sf)).select("ord", "slug", "primary_slug", "group_size")


def _sluggish(spark, sf):
    return (
        b.parts(spark, sf).withColumn("slug", F.concat_ws("-", F.lower("mpn"), F.col("ord").cast("string")))
        .withColumn("brand", F.when(F.col("size") > 45, F.col("manufacturer")).otherwise("other")))


@query(b.sql("""SELECT coalesce(m.mpn,s.mpn) AS mpn, coalesce(m.manufacturer,s.manufacturer) AS manufacturer,
  CASE WHEN s.mpn IS NULL THEN 'missing' WHEN m.mpn IS NULL THEN 'extra' WHEN m.qty<>s.qty OR m.lines<>s.lines THEN 'mismatch' ELSE 'equal' END AS status,
  CASE WHEN m.mpn IS NULL OR s.mpn IS NULL THEN '' ELSE concat_ws(',', CASE WHEN m.lines<>s.lines THEN 'lines' END, CASE WHEN m.qty<>s.qty THEN 'qty' END) END AS fields
  FROM (SELECT mpn, manufacturer, sum(lines) AS lines, sum(qty) AS qty FROM master_v GROUP BY 1,2) m
  FULL JOIN (SELECT mpn, manufacturer, sum(lines) AS lines, sum(qty) AS qty FROM snap_v GROUP BY 1,2) s ON m.mpn=s.mpn AND m.manufacturer=s.manufacturer""", "master_v", "snap_v"))
def reconcile_master(spark, sf):
    unique = lambda d: d.groupBy("mpn", "manufacturer").agg(F.sum("lines").alias("lines"), F.sum("qty").alias("qty"))
    return identity.reconcile(unique(b.master(spark, sf)), unique(b.snapshot_new(spark, sf)), ["mpn", "manufacturer"], ["lines", "qty"])


@query(b.sql("""WITH a AS (SELECT DISTINCT mpn, manufacturer FROM master_v), c AS (SELECT DISTINCT mpn, manufacturer FROM batch_v)
  SELECT 'both' AS side, * FROM (SELECT * FROM a INTERSECT SELECT * FROM c) UNION ALL SELECT 'left_only', * FROM (SELECT * FROM a EXCEPT SELECT * FROM c)
  UNION ALL SELECT 'right_only', * FROM (SELECT * FROM c EXCEPT SELECT * FROM a)""", "master_v", "batch_v"))
def set_differences(spark, sf):
    pair = lambda d: d.select("mpn", "manufacturer")
    return identity.set_differences(pair(b.master(spark, sf)), pair(b.batch(spark, sf)))


@query(b.sql("""SELECT DISTINCT mpn, manufacturer FROM (SELECT mpn, manufacturer FROM master_v UNION ALL SELECT mpn, manufacturer FROM batch_v)""", "master_v", "batch_v"))
def union_of_sources(spark, sf):
    pair = lambda d: d.select("mpn", "manufacturer")
    return identity.union_distinct(pair(b.master(spark, sf)), pair(b.batch(spark, sf)))


@query(b.sql("""SELECT category, count(*) AS n, sum(qty) AS qty FROM (SELECT * FROM master_v UNION ALL SELECT * FROM batch_v) GROUP BY 1""", "master_v", "batch_v"))
def bag_union(spark, sf):
    both = identity.bag_union(b.master(spark, sf), b.batch(spark, sf))
    return both.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@query(b.sql("""SELECT mpn, manufacturer FROM batch_v EXCEPT SELECT mpn, manufacturer FROM master_v EXCEPT SELECT mpn, manufacturer FROM snap_v""", "batch_v", "master_v", "snap_v"))
def scope_violations(spark, sf):
    pair = lambda d: d.select("mpn", "manufacturer")
    return identity.scope_violations(pair(b.batch(spark, sf)), pair(b.master(spark, sf)), pair(b.snapshot_new(spark, sf)))


@query(b.sql("SELECT mpn, manufacturer FROM snap_v EXCEPT SELECT mpn, manufacturer FROM master_v", "snap_v", "master_v"))
def new_fine_keys(spark, sf):
    pair = lambda d: d.select("mpn", "manufacturer")
    return identity.new_keys(pair(b.snapshot_new(spark, sf)), pair(b.master(spark, sf)))


@query(b.sql("""SELECT m.ord, m.mpn, CASE WHEN m.ord=f.o AND p.description<>'' AND p.description<>m.description THEN p.description ELSE m.description END AS description,
  CASE WHEN m.ord=f.o AND p.description<>'' AND p.description<>m.description THEN 'description' ELSE '' END AS changed
  FROM master_v m JOIN (SELECT mpn, min(ord) AS o FROM master_v GROUP BY 1) f ON f.mpn=m.mpn
  LEFT JOIN (SELECT mpn, arg_max(concat(description,' ',last_ship), ord) AS description FROM batch_v GROUP BY 1) p ON p.mpn=m.mpn""", "master_v", "batch_v"))
def patch_applied(spark, sf):
    patch = b.batch(spark, sf).select("mpn", "ord", F.concat_ws(" ", "description", "last_ship").alias("description"))
    out, _ = identity.apply_patch(b.master(spark, sf), patch)
    return out.select("ord", "mpn", "description", F.array_join("changed_columns", ",").alias("changed"))


@query(b.sql("""SELECT m.ord, coalesce(nullif(CASE WHEN m.qty>20 THEN m.last_ship ELSE '' END,''), o.last_ship, '') AS last_ship
  FROM snap_v m LEFT JOIN master_v o ON o.ord=m.ord""", "snap_v", "master_v"))
def carry_forward(spark, sf):
    new = b.snapshot_new(spark, sf).withColumn("last_ship", F.when(F.col("qty") > 20, F.col("last_ship")).otherwise(""))
    return identity.carry_forward(new, b.master(spark, sf), "ord", "last_ship").select("ord", "last_ship")


@query(b.sql("""SELECT s.ord, coalesce(m.last_ship, s.last_ship) AS last_ship FROM snap_v s LEFT JOIN master_v m ON m.ord=s.ord""", "snap_v", "master_v"))
def overrides(spark, sf):
    return identity.override(b.snapshot_new(spark, sf), b.master(spark, sf), "ord", "last_ship").select("ord", "last_ship")


@query(b.sql("""SELECT mpn, CASE WHEN count(DISTINCT supplier_reference)=1 THEN min(supplier_reference) END AS code,
  CASE WHEN count(DISTINCT supplier_reference)=0 THEN 'NO_CODE' WHEN count(DISTINCT supplier_reference)=1 THEN 'OK' ELSE 'AMBIGUOUS' END AS status
  FROM (SELECT b.mpn, m.supplier_reference FROM (SELECT DISTINCT mpn FROM batch_v) b LEFT JOIN master_v m ON m.mpn=b.mpn) GROUP BY 1""", "batch_v", "master_v"))
def resolve_code(spark, sf):
    return identity.resolve_code(b.batch(spark, sf), b.master(spark, sf))


@query(b.sql("""WITH idx AS (SELECT mpn, min(last_ship) AS v FROM master_v GROUP BY 1 HAVING count(DISTINCT supplier_reference)=1)
  SELECT b.ord, coalesce(c.last_ship, idx.v) AS value, CASE WHEN c.last_ship IS NOT NULL THEN 'code' WHEN idx.v IS NOT NULL THEN 'mpn' ELSE '' END AS value_path
  FROM batch_v b LEFT JOIN master_v c ON c.supplier_reference=b.supplier_reference LEFT JOIN idx ON idx.mpn=b.mpn""", "batch_v", "master_v"))
def lookup_with_fallback(spark, sf):
    m = b.master(spark, sf)
    by_code = m.select(k.key_upper("supplier_reference").alias("key"), F.col("last_ship").alias("value"))
    by_mpn = identity.safe_fallback_index(m, "mpn", "supplier_reference", "last_ship")
    return identity.lookup_with_fallback(b.batch(spark, sf), by_code, by_mpn, "supplier_reference", "mpn").select("ord", "value", "value_path")


@query(b.sql("SELECT b.ord, m.lines AS known_lines FROM batch_v b LEFT JOIN master_v m ON m.supplier_reference=b.supplier_reference", "batch_v", "master_v"))
def enrich_by_code(spark, sf):
    raw = b.master(spark, sf).select("ord", F.col("supplier_reference").alias("rc"), F.col("lines").alias("known_lines"))
    # each code twice, in the other letter case and later with another count
    raw = raw.unionByName(raw.select(F.col("ord") + 10**12, F.lower("rc"), F.col("known_lines") + 1).toDF("ord", "rc", "known_lines"))
    return identity.enrich_by_code(b.batch(spark, sf), raw, "supplier_reference", "rc", ["known_lines"], partitions=b.listing_tasks(spark, sf)).select("ord", "known_lines")


@query(b.sql("SELECT ord, mpn FROM batch_v WHERE mpn IN (SELECT mpn FROM master_v WHERE qty>40)", "batch_v", "master_v"))
def select_subset(spark, sf):
    return identity.select_subset(b.batch(spark, sf), b.master(spark, sf).where("qty > 40")).select("ord", "mpn")


@query(b.sql("""SELECT s.slug AS source, x.ms AS target FROM (SELECT 'p'||ord AS slug, mpn FROM parts_v) s
  JOIN (SELECT mpn, min('p'||ord) AS ms FROM parts_v GROUP BY 1) x ON x.mpn=s.mpn WHERE x.ms<>s.slug""", "parts_v"))
def alternate_edges(spark, sf):
    """Every part names its own part number and an unknown one; clones resolve to the first."""
    p = b.parts(spark, sf).select(F.concat(F.lit("p"), F.col("ord").cast("string")).alias("slug"), "mpn")
    return identity.alternate_edges(p.withColumn("alternates", F.array("mpn", F.lit("NO SUCH PART"))), p)


@query(b.sql("""WITH pool AS (SELECT category AS g, mpn, 's'||ord AS slug, row_number() OVER (PARTITION BY category ORDER BY ord)-1 AS pos, count(*) OVER (PARTITION BY category) AS n FROM parts_v)
  SELECT a.g AS "group", a.slug, o.step AS rank, c.slug AS neighbour, c.mpn AS neighbour_mpn FROM pool a, (SELECT unnest(range(1,7)) AS step) o JOIN pool c ON c.g=a.g AND c.pos=(a.pos+o.step)%a.n""", "parts_v"))
def related_neighbours(spark, sf):
    p = b.parts(spark, sf).withColumn("slug", F.concat(F.lit("s"), F.col("ord").cast("string")))
    return identity.related_neighbours(p, "category", "slug")


@query(b.sql(f"""WITH {_LINKED}, docs AS (SELECT regexp_extract(datasheet_url,'([^/]+)\\.pdf$',1) AS stem, datasheet_url AS path FROM linked WHERE datasheet_url<>''),
  kd AS (SELECT lower(stem) AS k, min(path) AS path FROM docs GROUP BY 1), ad AS (SELECT regexp_replace(lower(stem),'[^a-z0-9]','','g') AS k, min(path) AS path FROM docs GROUP BY 1)
  SELECT ord AS part_id, CASE WHEN a.path IS NOT NULL THEN 'cid' WHEN c.path IS NOT NULL THEN 'mpn' WHEN d.path IS NOT NULL THEN 'alnum_mpn' ELSE 'missing' END AS method,
  coalesce(a.path, c.path, d.path) AS path FROM parts_v p LEFT JOIN kd a ON a.k=lower(cid) LEFT JOIN kd c ON c.k=lower(mpn) LEFT JOIN ad d ON d.k=regexp_replace(lower(mpn),'[^a-z0-9]','','g')""", "parts_v"))
def match_documents(spark, sf):
    linked = _linked(spark, sf)
    docs = linked.where("datasheet_url <> ''").select(
        F.col("datasheet_url").alias("path"), F.regexp_replace(F.substring_index("datasheet_url", "/", -1), r"\.pdf$", "").alias("stem"))
    p = linked.select(F.col("ord").alias("part_id"), F.col("cid").alias("code"), "mpn", F.lit("").alias("clean_mpn"), F.lit("").alias("url"))
    return identity.match_documents(p, docs).select("part_id", "method", "path")


@query(b.sql("""SELECT ord, page, pages, prev_page, next_page, category FROM (SELECT ord, category, (rn-1)//50+1 AS page, (n+49)//50 AS pages,
   CASE WHEN (rn-1)//50+1>1 THEN (rn-1)//50 END AS prev_page, CASE WHEN (rn-1)//50+1<(n+49)//50 THEN (rn-1)//50+2 END AS next_page
   FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY mpn, ord) AS rn, count(*) OVER (PARTITION BY category) AS n FROM parts_v))""", "parts_v"))
def pages_50(spark, sf):
    return ordering.paginate(b.parts(spark, sf), ["category"], ["mpn", "ord"]).select("ord", "category", "page", "pages", "prev_page", "next_page")


@query(b.sql("""SELECT ord, category FROM (SELECT *, row_number() OVER (ORDER BY ord) AS r FROM (
   SELECT *, row_number() OVER (PARTITION BY category ORDER BY ord) AS rn FROM parts_v WHERE category IN ('PROMO','LARGE','SMALL'))
   WHERE rn<=CASE category WHEN 'PROMO' THEN 40 WHEN 'LARGE' THEN 25 ELSE 100 END) WHERE r<=120""", "parts_v"))
def cap_per_category(spark, sf):
    return ordering.cap_per_group(b.parts(spark, sf), "category", {"PROMO": 40, "LARGE": 25, "SMALL": 100}, total=120).select("ord", "category")


@query(b.sql("""SELECT ord, mpn FROM (SELECT *, row_number() OVER (ORDER BY ord) AS r FROM (SELECT * FROM parts_v QUALIFY row_number() OVER (PARTITION BY mpn ORDER BY ord)=1)) WHERE r<=50""", "parts_v"))
def streamed_limit(spark, sf):
    return ordering.streamed_limit(b.parts(spark, sf), ["mpn"], 50).select("ord", "mpn")


@query(b.sql("SELECT cid, mpn FROM parts_v ORDER BY sha256('42:'||cid), cid LIMIT 30", "parts_v"))
def spot_sample(spark, sf):
    return ordering.spot_sample(b.parts(spark, sf), "cid", 30).select("cid", "mpn")


@query(b.sql("SELECT category, cid FROM parts_v QUALIFY row_number() OVER (PARTITION BY category ORDER BY sha256('42:'||cid), cid) <= 5", "parts_v"))
def stratified(spark, sf):
    return ordering.stratified_sample(b.parts(spark, sf), ["category"], "cid", 5).select("category", "cid")
