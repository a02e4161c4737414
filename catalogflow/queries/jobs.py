"""Composite jobs over the derived catalog: intake, release, publishing, search, logs, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import attrs, classify, keys
from catalogflow.functions.text import MOJIBAKE
from catalogflow.operators import aggregates, gates, identity, logs, merge
from catalogflow.plans import assets, audit, intake, publish, release, search
from catalogflow.queries.functions import _FAMILY_SQL, _L1_SQL, _params, attribute_json
from catalogflow.queries.identity import _LINKED, _linked
from catalogflow.queries.registry import query
from catalogflow.session import shared_dir
from catalogflow.sinks import files as sinks
from catalogflow.streaming import jobs


def _fresh_dir(spark, name):
    """A new folder below the session's shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- intake ---------------------------------------------------------------------------

def _raw(spark, sf):
    p = b.parts(spark, sf)
    return p.select(
        "ord", "mpn", F.col("manufacturer").alias("manufacturer_raw"), F.col("catalog_name").alias("catalogName"), F.col("parent_catalog").alias("parentCatalogName"),
        "category", "description", F.to_json(F.create_map(F.lit("输出电压"), F.col("quantity"), F.lit("容值"), F.concat(F.col("size").cast("string"), F.lit("nF")))).alias("attributes_json"),
        F.when(F.col("size") > 20, F.concat(F.lit("https://d/"), F.col("cid"))).otherwise("").alias("source_datasheet_url"), F.col("cid").alias("supplier_sku"))


def _known(spark, sf):
    return b.parts(spark, sf).where("size > 40").select("mpn")


@query(b.sql("""SELECT ord, mpn, manufacturer FROM parts_v WHERE size>20 AND mpn NOT IN (SELECT mpn FROM parts_v WHERE manufacturer='Brand#7')
  QUALIFY row_number() OVER (PARTITION BY mpn ORDER BY ord)=1""", "parts_v"))
def intake_kept(spark, sf):
    out = b.parts(spark, sf).where("manufacturer = 'Brand#7'").select("mpn")
    kept = intake.intake(_raw(spark, sf), exclude=out, require_document=True).kept
    return kept.select("ord", "mpn", F.col("manufacturer_raw").alias("manufacturer"))


@query(b.sql("""WITH f AS (SELECT *, CASE WHEN mpn IN (SELECT mpn FROM parts_v WHERE manufacturer='Brand#7') THEN 'excluded' WHEN category<>'PROMO' THEN 'other_category' WHEN size<=20 THEN 'no_document' ELSE '' END AS r FROM parts_v)
  SELECT r AS counter, count(*) AS n FROM f WHERE r<>'' GROUP BY 1 UNION ALL SELECT 'repeated_in_source', count(*)-count(DISTINCT mpn) FROM f WHERE r='' UNION ALL SELECT 'kept', count(DISTINCT mpn) FROM f WHERE r=''""", "parts_v"))
def intake_counters(spark, sf):
    out = b.parts(spark, sf).where("manufacturer = 'Brand#7'").select("mpn")
    return intake.intake(_raw(spark, sf), exclude=out, category="promo", require_document=True).counters


@query(b.sql("""SELECT ord, mpn, (row_number() OVER (ORDER BY ord)-1)//500+1 AS slice_idx FROM (SELECT ord, mpn FROM batch_v WHERE mpn NOT IN (SELECT mpn FROM master_v)
  QUALIFY row_number() OVER (PARTITION BY mpn ORDER BY ord)=1)""", "batch_v", "master_v"))
def wave_slices(spark, sf):
    raw = b.batch(spark, sf).withColumn("source_datasheet_url", F.lit(""))
    out, _ = intake.ingest_wave(raw, b.master(spark, sf))
    return out.select("ord", "mpn", "slice_idx")


@query(b.sql(f"""WITH r AS (SELECT *, {_FAMILY_SQL} AS family, {_L1_SQL} AS l1 FROM parts_v)
  SELECT ord, coalesce(a.canonical, manufacturer) AS brand, l1 AS category, family,
  CASE WHEN family='Microcontroller' THEN 'warn' WHEN family IN ('Capacitor','Voltage Regulator') THEN 'ok' ELSE 'warn' END AS verdict,
  CASE WHEN family IN ('Capacitor','Voltage Regulator') THEN '' ELSE 'SPEC_THIN' END AS code
  FROM r LEFT JOIN alias_v a ON a.raw=lower(manufacturer)""", "parts_v", "alias_v"))
def normalised_rows(spark, sf):
    none = b.parts(spark, sf).limit(0).select("mpn", "manufacturer")
    known = b.aliases(spark, sf).unionByName(b.aliases(spark, sf).select(F.lower("canonical").alias("raw"), "canonical"))
    n = intake.normalize(_raw(spark, sf), none, known)
    return n.rows.select("ord", "brand", "category", "family", "verdict", "code")


@query(b.sql("""SELECT mpn||'-'||ord AS mpn, a.canonical AS manufacturer FROM parts_v p JOIN alias_v a ON a.raw=lower(manufacturer) WHERE ord%50<>0 AND ord%20<>1 AND ord%3<>0""", "parts_v", "alias_v"))
def normalised_candidates(spark, sf):
    """B2 against a MASTER that has every third part, with made-up part numbers, rows without one, and rows that come twice."""
    o = F.col("ord")
    raw = _raw(spark, sf).withColumn("mpn", F.when(o % 50 == 0, F.concat(F.lit("MCU"), (o + 100000).cast("string"))).when(o % 20 == 1, " ").otherwise(F.concat_ws("-", "mpn", o.cast("string"))))
    twice = raw.unionByName(raw.where("ord % 7 = 0").withColumn("ord", o + 10**9))
    known = b.aliases(spark, sf)
    master = raw.where("ord % 3 = 0").join(known, F.lower("manufacturer_raw") == F.col("raw")).select(F.lower("mpn").alias("mpn"), F.col("canonical").alias("manufacturer"))
    return intake.normalize(twice, master, known).candidates.select("mpn", "manufacturer")


# ---- gates and release -------------------------------------------------------------------

@query(b.sql("""SELECT ord, CASE WHEN regexp_matches(mpn,'(?i)^(MCU|MOS|RES|CAP|IND|DIO|CON|XTAL|MEM|WIFI|MOD|REG|AMP|OP|LED|PWR|IC)\\d{6}') THEN 'pattern 1' WHEN regexp_matches(mpn,'100000\\d{3}') THEN 'pattern 2'
   WHEN regexp_matches(mpn,'^\\d{6,}$') THEN 'pattern 3' WHEN regexp_matches(mpn,'(?i)PLACEHOLDER') THEN 'pattern 4' WHEN regexp_matches(mpn,'(?i)XXX$') THEN 'pattern 5' WHEN regexp_matches(mpn,'(?i)_(TEST|SAMPLE|MOCK)$') THEN 'pattern 6'
   WHEN manufacturer='Nova' THEN 'fake brand' ELSE '' END AS reason FROM (
   SELECT ord, CASE category WHEN 'PROMO' THEN 'MCU'||(ord+100000) WHEN 'SMALL' THEN mpn||'-XXX' WHEN 'LARGE' THEN mpn||'_TEST' WHEN 'MEDIUM' THEN CAST(ord+1000000 AS VARCHAR) ELSE mpn END AS mpn,
   CASE category WHEN 'ECONOMY' THEN 'Nova' ELSE manufacturer END AS manufacturer FROM parts_v)""", "parts_v"))
def synthetic_screen(spark, sf):
    c = F.col("category")
    n = F.col("ord")
    mpn = (F.when(c == "PROMO", F.concat(F.lit("MCU"), (n + 100000).cast("string"))).when(c == "SMALL", F.concat("mpn", F.lit("-XXX")))
           .when(c == "LARGE", F.concat("mpn", F.lit("_TEST"))).when(c == "MEDIUM", (n + 1000000).cast("string")).otherwise(F.col("mpn")))
    maker = F.when(c == "ECONOMY", "Nova").otherwise(F.col("manufacturer"))
    return b.parts(spark, sf).select("ord", gates.synthetic_reason(mpn, maker).alias("reason"))


def _candidates(spark, sf):
    """Arriving listings in MASTER shape plus the pool columns a plan needs."""
    rows = b.batch(spark, sf)
    l1 = F.when(F.col("category") == "SMALL", "").otherwise(F.lower("category"))
    link = F.when(F.col("category") == "PROMO", F.concat(F.lit("https://datasheet.lcsc.com/"), F.col("supplier_reference"))).otherwise("")
    full = rows.withColumns({"native_l1": l1, "datasheet_url": link, "attributes_json": F.lit('{"a":1,"b":2}')})
    return gates.project_master(full, keep=("ord",)).withColumn("spec_keys", F.lit(2))


def _master_rows(spark, sf):
    return gates.project_master(b.master(spark, sf).withColumn("native_l1", F.lower("category")), keep=("ord",))


@query(b.sql("""WITH c AS (SELECT *, category='SMALL' AS unmapped FROM batch_v), good AS (SELECT * FROM c WHERE NOT unmapped),
  s AS (SELECT CASE WHEN row_number() OVER (PARTITION BY mpn, manufacturer ORDER BY ord)>1 THEN 'self' WHEN (mpn, manufacturer) IN (SELECT (mpn, manufacturer) FROM master_v) THEN 'dup' ELSE 'new' END AS st FROM good),
  n AS (SELECT count(*) FILTER (WHERE st='new') AS new, count(*) FILTER (WHERE st='dup') AS duplicates, count(*) FILTER (WHERE st='self') AS self_duplicates, count(*) AS t FROM s)
  SELECT (SELECT count(*) FROM c WHERE unmapped) + (SELECT count(*) FROM c WHERE category='PROMO') + CASE WHEN self_duplicates>0 OR (duplicates>=5 AND duplicates/t>0.2) THEN 1 ELSE 0 END
   + (SELECT count(*) FROM (SELECT mpn FROM (SELECT mpn, manufacturer FROM c GROUP BY 1,2) GROUP BY 1 HAVING count(*)>1) WHERE mpn IN (SELECT mpn FROM c WHERE category='PROMO' GROUP BY 1 HAVING count(DISTINCT supplier_reference)=1))
   + (SELECT count(*) FROM (SELECT mpn FROM c GROUP BY 1 HAVING count(DISTINCT manufacturer)=1) x JOIN (SELECT mpn, manufacturer FROM c WHERE category='PROMO' GROUP BY 1,2 HAVING count(DISTINCT supplier_reference)>1) y USING (mpn)) AS stops,
  (SELECT count(*) FROM c) AS candidates, new, duplicates, self_duplicates, (SELECT count(*) FROM master_v) AS before_count, (SELECT count(*) FROM master_v)+new AS after_count FROM n""", "batch_v", "master_v"))
def master_append_plan(spark, sf):
    p = release.plan_release(_master_rows(spark, sf), _candidates(spark, sf))
    return p.summary.select("stops", "candidates", "new", "duplicates", "self_duplicates", "before_count", "after_count")


@query(b.sql("""SELECT code, param, count(*) AS n FROM (SELECT 'COLLISION' AS code, 'channels' AS param FROM parts_v UNION ALL
   SELECT 'MULTIVALUE','输出电压' FROM parts_v WHERE false) GROUP BY 1,2""", "parts_v"))
def spec_integrity(spark, sf):
    p = b.parts(spark, sf).withColumn("params", _params()).withColumn("entries", attrs.parameter_entries("params"))
    canon = attrs.canonical_attributes("entries")
    rows = p.withColumn("final", attrs.forward_unmapped(canon, attrs.unmapped_attributes("entries")))
    problems = rows.select(F.explode(release._spec_problems(F.col("params"), F.col("final"))).alias("p"))
    return problems.groupBy(F.col("p.code").alias("code"), F.col("p.param").alias("param")).agg(F.count(F.lit(1)).alias("n"))


@query(b.sql("""SELECT count(*) AS total, 0 AS stop, count(*) FILTER (WHERE event_type IN ('error','view')) AS warning, count(*) FILTER (WHERE event_type='click') AS skip, true AS "continue", 0 AS exit_code FROM events"""))
def gate_decision(spark, sf):
    code = F.when(F.col("event_type") == "error", "SPEC_THIN").when(F.col("event_type") == "view", "BRAND_UNMAPPED").when(F.col("event_type") == "click", "DUPLICATE_SKIP").otherwise("R2_OBJECT_EXISTS")
    e = b.read(spark, sf, "events").select(code.alias("code"), F.col("user_id").cast("string").alias("mpn"), F.lit("").alias("message"))
    return gates.gate_decision(e)


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE event_type='error') AS failed, count(*) FILTER (WHERE event_type='error')/count(*) AS failure_rate, count(*) FILTER (WHERE event_type='error')/count(*)>0.1 AS stop FROM events""")
def mass_failure(spark, sf):
    return gates.mass_failure(b.ledger(spark, sf), F.col("status") == "error")


# ---- change plan -------------------------------------------------------------------------

_DATA = ["mpn", "manufacturer", "category", "lines", "qty", "last_ship"]


def _pages(df):
    return df.withColumn("slug", F.lower("supplier_reference"))


@query(b.sql("""WITH d AS (SELECT lower(supplier_reference) AS slug, mpn, sha256(concat_ws('|', mpn, manufacturer, category, lines, qty, last_ship)) AS fp FROM snap_v),
  o AS (SELECT lower(supplier_reference) AS slug, sha256(concat_ws('|', mpn, manufacturer, category, lines, qty, last_ship)) AS fp FROM master_v),
  p AS (SELECT d.slug, d.mpn, CASE WHEN o.slug IS NULL THEN 'CREATE' WHEN o.fp<>d.fp THEN 'UPDATE' ELSE 'SKIP' END AS action FROM d LEFT JOIN o USING (slug)),
  t AS (SELECT mpn, min(slug) AS target FROM d GROUP BY 1)
  SELECT slug, mpn, CASE WHEN action='SKIP' AND hit THEN 'UPDATE' ELSE action END AS action, CASE WHEN action='SKIP' AND hit THEN 'dependency-induced' WHEN action='UPDATE' THEN 'direct' ELSE '' END AS kind
  FROM (SELECT p.*, t.target<>p.slug AND t.target IN (SELECT slug FROM p WHERE action<>'SKIP') AS hit FROM p JOIN t USING (mpn))""", "snap_v", "master_v"))
def change_plan(spark, sf):
    new, old = _pages(b.snapshot_new(spark, sf)), _pages(b.master(spark, sf))
    first = new.groupBy(F.col("mpn").alias("_m")).agg(F.min("slug").alias("target"))
    edges = new.select("mpn", F.col("slug").alias("source")).join(first, F.col("mpn") == F.col("_m")).where("source <> target").select("source", "target")
    return publish.change_plan(publish.build_keys(new, _DATA), publish.build_keys(old, _DATA), edges)


@query(b.sql("""WITH d AS (SELECT lower(supplier_reference) AS slug, sha256(concat_ws('|', mpn, manufacturer, category, lines, qty, last_ship)) AS fp FROM snap_v),
  o AS (SELECT lower(supplier_reference) AS slug, sha256(concat_ws('|', mpn, manufacturer, category, lines, qty, last_ship)) AS fp FROM master_v),
  p AS (SELECT CASE WHEN o.slug IS NULL THEN 'CREATE' WHEN o.fp<>d.fp THEN 'UPDATE' ELSE 'SKIP' END AS a FROM d LEFT JOIN o USING (slug))
  SELECT count(*) FILTER (WHERE a='CREATE') AS "create", count(*) FILTER (WHERE a='UPDATE') AS "update", count(*) FILTER (WHERE a='SKIP') AS skip, count(*) FILTER (WHERE a='UPDATE') AS direct, 0 AS dependency_induced FROM p""", "snap_v", "master_v"))
def change_summary(spark, sf):
    new, old = _pages(b.snapshot_new(spark, sf)), _pages(b.master(spark, sf))
    return publish.change_summary(publish.change_plan(publish.build_keys(new, _DATA), publish.build_keys(old, _DATA)))


def _grouped_pages(spark, sf, new):
    """Pages in ten groups. Since the recorded build pages came, went or were renamed in five groups, and prices changed in all."""
    p = b.parts(spark, sf).withColumns({"slug": F.concat(F.lit("s"), F.col("ord").cast("string")), "grp": F.col("size") % 10})
    o, g = F.col("ord"), F.col("grp")
    came, went = (o % 97 == 0) & (g < 3), (o % 101 == 0) & (g == 3)
    if not new:
        return p.where(~came).select("slug", "mpn", "grp", "ord", F.col("price").cast("long").alias("price"))
    renamed = F.when((o % 89 == 0) & (g == 4), F.concat("mpn", F.lit("-R"))).otherwise(F.col("mpn"))
    return p.where(~went).select("slug", renamed.alias("mpn"), "grp", "ord", (F.col("price").cast("long") + F.when(o % 53 == 0, 1).otherwise(0)).alias("price"))


@query(b.sql("""WITH x AS (SELECT 's'||ord AS slug, ord, mpn, size%10 AS g, CAST(trunc(price) AS BIGINT) AS price FROM parts_v),
  o AS (SELECT * FROM x WHERE NOT (ord%97=0 AND g<3)),
  n AS (SELECT slug, ord, CASE WHEN ord%89=0 AND g=4 THEN mpn||'-R' ELSE mpn END AS mpn, g, price+CASE WHEN ord%53=0 THEN 1 ELSE 0 END AS price FROM x WHERE NOT (ord%101=0 AND g=3)),
  ro AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY ord)-1 AS pos, count(*) OVER (PARTITION BY g) AS c FROM o), rn AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY ord)-1 AS pos, count(*) OVER (PARTITION BY g) AS c FROM n),
  fo AS (SELECT a.slug, string_agg(z.slug||'|'||z.mpn, ',' ORDER BY s) AS dep FROM ro a, range(1,7) r(s) JOIN ro z ON z.g=a.g AND z.pos=(a.pos+s)%a.c GROUP BY 1),
  fn AS (SELECT a.slug, string_agg(z.slug||'|'||z.mpn, ',' ORDER BY s) AS dep FROM rn a, range(1,7) r(s) JOIN rn z ON z.g=a.g AND z.pos=(a.pos+s)%a.c GROUP BY 1)
  SELECT slug, CASE WHEN o.slug IS NULL THEN 'CREATE' WHEN o.mpn<>n.mpn OR o.price<>n.price OR fo.dep<>fn.dep THEN 'UPDATE' ELSE 'SKIP' END AS action,
   CASE WHEN o.slug IS NULL THEN '' WHEN o.mpn<>n.mpn OR o.price<>n.price THEN 'direct' WHEN fo.dep<>fn.dep THEN 'dependency-induced' ELSE '' END AS kind
  FROM n LEFT JOIN o USING (slug) LEFT JOIN fo USING (slug) LEFT JOIN fn USING (slug)""", "parts_v"))
def change_plan_neighbours(spark, sf):
    old, new = _grouped_pages(spark, sf, False), _grouped_pages(spark, sf, True)
    recorded = publish.build_keys(old, ["mpn", "price"], identity.related_neighbours(old, "grp", "slug"))
    desired = publish.incremental_keys(new, recorded, publish.places(old, "grp", "ord"), ["mpn", "price"], "grp", "ord")
    return publish.change_plan(desired, recorded).select("slug", "action", "kind")


@query(b.sql("""SELECT ord, sha256(concat_ws('|', mpn, manufacturer, category, lines, qty, last_ship)) AS fingerprint FROM snap_v""", "snap_v"))
def row_fingerprints(spark, sf):
    return b.snapshot_new(spark, sf).select("ord", aggregates.row_fingerprint(_DATA).alias("fingerprint"))


@query("SELECT count(*) AS rows, true AS same_in_other_order, false AS same_after_a_change, false AS same_with_a_row_twice FROM lineitem")
def table_fingerprint(spark, sf):
    """A fingerprint against those of the same rows in another order, with one value changed, and with one row more."""
    li = b.read(spark, sf, "lineitem")
    first = li.agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("x")).select("x.*").toDF("_o", "_n")
    marked = li.join(F.broadcast(first), (F.col("l_orderkey") == F.col("_o")) & (F.col("l_linenumber") == F.col("_n")), "left")  # one row on the right
    changed = marked.withColumn("l_quantity", F.when(F.col("_o").isNotNull(), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).drop("_o", "_n")
    twice = li.unionByName(marked.where("_o is not null").drop("_o", "_n"))
    a, other, new, more = (aggregates.table_fingerprint(d).select(F.struct("*").alias(n)) for d, n in (
        (li, "a"), (li.repartition("l_partkey"), "other"), (changed, "new"), (twice, "more")))
    both = a.crossJoin(other).crossJoin(new).crossJoin(more)  # one row each
    return both.select("a.rows", (F.col("a") == F.col("other")).alias("same_in_other_order"), (F.col("a") == F.col("new")).alias("same_after_a_change"), (F.col("a") == F.col("more")).alias("same_with_a_row_twice"))


# ---- policy, URLs, facets, pages ------------------------------------------------------------

def _policy_parts(spark, sf):
    p = b.parts(spark, sf)
    return p.withColumn("slug", F.concat_ws("-", F.lower("mpn"), F.col("ord").cast("string"))).withColumn(
        "brand", F.when(F.col("size") > 45, F.col("manufacturer")).otherwise("other")).withColumn(
        "mpn", F.when(F.col("size") == 1, F.concat(F.col("mpn"), F.col("ord").cast("string"), F.lit("_TEST"))).otherwise(F.concat_ws("-", "mpn", F.col("size").cast("string")))).withColumn(
        "category", F.when(F.col("category") == "SMALL", "unknown").otherwise(F.col("category")))


_POLICY_SQL = """pp AS (SELECT ord, lower(mpn)||'-'||ord AS slug, CASE WHEN size>45 THEN manufacturer ELSE 'other' END AS brand, manufacturer,
  CASE WHEN size=1 THEN mpn||ord||'_TEST' ELSE mpn||'-'||size END AS mpn, CASE category WHEN 'SMALL' THEN 'unknown' ELSE category END AS category FROM parts_v),
 pk AS (SELECT *, replace(lower(mpn),'-','') AS k FROM pp),
 pr AS (SELECT *, count(*) OVER (PARTITION BY k) AS gs, first_value(slug) OVER (PARTITION BY k ORDER BY CASE WHEN lower(brand)=lower(manufacturer) THEN 0 ELSE 1 END, CASE WHEN lower(brand)=lower(manufacturer) THEN ord ELSE 0 END, lower(category), lower(manufacturer), lower(slug), ord) AS ps FROM pk),
 pol AS (SELECT ord, slug, CASE WHEN gs>1 AND ps<>slug THEN 'DUPLICATE' WHEN category='unknown' THEN 'UNKNOWN_CATEGORY' WHEN mpn LIKE '%\\_TEST' ESCAPE '\\' THEN 'SYNTHETIC_MPN' ELSE 'INDEX' END AS reason,
  CASE WHEN gs>1 AND ps<>slug THEN ps ELSE '' END AS canonical_to FROM pr)"""


@query(b.sql(f"WITH {_POLICY_SQL} SELECT ord, slug, reason, reason='INDEX' AS indexable, canonical_to FROM pol", "parts_v"))
def index_policy(spark, sf):
    return publish.index_policy(_policy_parts(spark, sf)).select("ord", "slug", "reason", "indexable", "canonical_to")


def _url_list(spark, sf):
    return _policy_parts(spark, sf).select(F.concat(F.lit("https://catalog.invalid/products/"), F.col("slug"), F.lit("/")).alias("url"), "slug")


@query(b.sql(f"""WITH {_POLICY_SQL} SELECT 'https://catalog.invalid/products/'||slug||'/' AS url FROM pol WHERE reason='INDEX' UNION ALL SELECT 'https://catalog.invalid/'||lower(r_name)||'/' FROM region""", "parts_v"))
def urls_pruned(spark, sf):
    static = b.read(spark, sf, "region").select(F.concat(F.lit("https://catalog.invalid/"), F.lower("r_name"), F.lit("/")).alias("url"), F.lit("").alias("slug"))
    return publish.prune_urls(_url_list(spark, sf), publish.index_policy(_policy_parts(spark, sf)), static).select("url")


@query(b.sql(f"WITH {_POLICY_SQL} SELECT count(*) AS violations FROM (SELECT 1 WHERE false)", "parts_v"))
def url_disjoint(spark, sf):
    policy = publish.index_policy(_policy_parts(spark, sf))
    static = b.read(spark, sf, "region").select(F.lower("r_name").alias("url"), F.lit("").alias("slug"))
    return publish.policy_violations(publish.prune_urls(_url_list(spark, sf), policy, static), policy).agg(F.count(F.lit(1)).alias("violations"))


@query("""SELECT CASE WHEN t<=45000 THEN 'sitemap_parts' ELSE 'sitemap_parts_'||((rn-1)//45000+1) END AS file, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
  FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS t FROM orders) GROUP BY 1""")
def url_shards(spark, sf):
    u = b.read(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("https://catalog.invalid/o/"), F.col("o_orderkey").cast("string")).alias("url"))
    return sinks.url_shards(u, ["o_orderkey"]).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query(b.sql("""SELECT (rn-1)//5000 AS shard, count(*) AS n, min(k) AS "from", max(k) AS "to" FROM (SELECT lower(c_name) AS k, row_number() OVER (ORDER BY lower(c_name), c_custkey) AS rn FROM customer) GROUP BY 1"""))
def search_shards(spark, sf):
    e = b.read(spark, sf, "customer").select(F.lower("c_name").alias("k"), "c_custkey")
    return sinks.shard_manifest(sinks.search_shards(e, ["k", "c_custkey"]), "k")


def _taxonomy(spark, sf):
    status = lambda k: F.when(F.col(k) % 5 == 3, "hidden").when(F.col(k) % 5 == 4, "review").otherwise("active")
    tops = b.read(spark, sf, "region").select(F.lower("r_name").alias("slug"), F.col("r_name").alias("name"), status("r_regionkey").alias("publish_status"), "r_regionkey")
    l1 = b.read(spark, sf, "nation").join(tops, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("slug"), F.col("slug").alias("top_scope"), F.col("n_name").alias("en_display"), status("n_nationkey").alias("publish_status"))
    return tops.drop("r_regionkey"), l1


_TAX = """st AS (SELECT lower(r_name) AS slug, r_name AS name, CASE r_regionkey%5 WHEN 3 THEN 'hidden' WHEN 4 THEN 'review' ELSE 'active' END AS ps, r_regionkey FROM region),
 l1 AS (SELECT lower(n_name) AS slug, st.slug AS top, n_name AS disp, CASE n_nationkey%5 WHEN 3 THEN 'hidden' WHEN 4 THEN 'review' ELSE 'active' END AS ps, st.ps AS tps, st.name AS tname FROM nation JOIN st ON n_regionkey=r_regionkey),
 cu AS (SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_mktsegment='BUILDING' THEN 'nowhere' ELSE 'NATION_'||c_nationkey END AS native_l1 FROM customer),
 res AS (SELECT cu.*, CASE WHEN l1.slug IS NULL THEN 'UNMAPPED' ELSE 'RESOLVED' END AS tax_status, coalesce(l1.top,'__UNMAPPED__') AS top, coalesce(tname,'') AS top_name,
  CASE WHEN l1.ps='hidden' OR tps='hidden' THEN 'hidden' WHEN l1.ps='review' OR tps='review' THEN 'review' ELSE 'active' END AS publish_status FROM cu LEFT JOIN l1 ON lower(native_l1)=l1.slug)"""


def _resolved(spark, sf):
    tops, l1 = _taxonomy(spark, sf)
    c = b.read(spark, sf, "customer").withColumn("native_l1", F.when(F.col("c_mktsegment") == "BUILDING", "nowhere").otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))))
    return gates.resolve_taxonomy(c, tops, l1)


@query(f"WITH {_TAX} SELECT c_custkey, tax_status, top, top_name, publish_status FROM res")
def taxonomy_resolved(spark, sf):
    return _resolved(spark, sf).select("c_custkey", "tax_status", "top", "top_name", "publish_status")


@query(f"WITH {_TAX} SELECT tax_status, count(*) AS n FROM res GROUP BY 1")
def taxonomy_counters(spark, sf):
    return gates.taxonomy_counters(_resolved(spark, sf))


@query(f"WITH {_TAX} SELECT top, native_l1 AS sub, count(*) AS n FROM res WHERE top<>'__UNMAPPED__' GROUP BY 1,2")
def top_facets(spark, sf):
    return aggregates.catalog_counts(_resolved(spark, sf))


@query(f"WITH {_TAX} SELECT top, native_l1 AS sub, count(*) AS n, grouping(top) AS is_total, grouping(native_l1) AS is_subtotal FROM res WHERE top<>'__UNMAPPED__' GROUP BY ROLLUP(top, native_l1)")
def facet_rollup(spark, sf):
    return aggregates.catalog_rollup(_resolved(spark, sf))


@query(f"""WITH {_TAX} SELECT top, sum(n) AS n, string_agg(s||'='||n, ',' ORDER BY lower(s)) AS subs FROM (SELECT top, native_l1 AS s, count(*) AS n FROM res GROUP BY 1,2) GROUP BY 1""")
def nested_facets(spark, sf):
    _, tops = aggregates.facet_counts(_resolved(spark, sf), "top", "native_l1", "c_mktsegment")
    return tops.select("top", "n", F.array_join(F.transform("subcategories", lambda x: F.concat_ws("=", x["name"], x["n"].cast("string"))), ",").alias("subs"))


@query(f"""WITH {_TAX}, g AS (SELECT top, native_l1 AS slug, count(*) AS n FROM res GROUP BY 1,2)
  SELECT a.top, a.slug, s.slug AS sibling, row_number() OVER (PARTITION BY a.top, a.slug ORDER BY s.n DESC, s.slug) AS pos FROM g a JOIN g s ON a.top=s.top AND a.slug<>s.slug QUALIFY row_number() OVER (PARTITION BY a.top, a.slug ORDER BY s.n DESC, s.slug)<=8""")
def siblings(spark, sf):
    g = aggregates.distribution(_resolved(spark, sf).withColumn("k", F.struct("top", "native_l1")), "k").select("value.top", F.col("value.native_l1").alias("slug"), "n")
    return aggregates.siblings(g)


@query(b.sql("""SELECT category, manufacturer, n, pos FROM (SELECT category, manufacturer, count(*) AS n, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, min(ord)) AS pos FROM parts_v GROUP BY 1,2) WHERE pos<=8""", "parts_v"))
def top_manufacturers(spark, sf):
    return aggregates.top_values(b.parts(spark, sf), ["category"], "manufacturer")


@query(b.sql("""SELECT category AS top, catalog_name AS sub, n, mpn, pos FROM (SELECT category, catalog_name, count(*) AS n, min(mpn) AS mpn, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, catalog_name) AS pos FROM parts_v GROUP BY 1,2) WHERE pos<=8""", "parts_v"))
def representatives(spark, sf):
    return aggregates.representatives(b.parts(spark, sf).select(F.col("category").alias("top"), F.col("catalog_name").alias("sub"), "mpn"))


@query(b.sql("""WITH c AS (SELECT category AS top, lower(manufacturer) AS slug, count(*) AS n FROM parts_v GROUP BY 1,2), f AS (SELECT category AS top, lower(manufacturer) AS slug, sum(size) AS n FROM parts_v WHERE size>25 GROUP BY 1,2)
  SELECT coalesce(c.top,f.top) AS top, coalesce(c.slug,f.slug) AS slug, coalesce(f.n,c.n) AS n, true AS linked FROM c FULL JOIN f ON c.top=f.top AND c.slug=f.slug WHERE coalesce(c.slug,f.slug) IN (SELECT DISTINCT lower(manufacturer) FROM parts_v WHERE price>905)""", "parts_v"))
def merged_facets(spark, sf):
    p = b.parts(spark, sf).select(F.col("category").alias("top"), F.lower("manufacturer").alias("slug"), "size", "price")
    coarse = p.groupBy("top", "slug").agg(F.count(F.lit(1)).alias("n"))
    fine = p.where("size > 25").groupBy("top", "slug").agg(F.sum("size").alias("n"))
    return aggregates.merged_facets(coarse, fine, p.where("price > 905").select("slug"))


@query(b.sql(f"""WITH g AS (SELECT category AS top, trim(regexp_replace(lower(catalog_name),'[^a-z0-9]+','-','g'),'-') AS slug, count(*) AS n FROM parts_v GROUP BY 1,2)
  SELECT top, slug, n, n>=10 AS indexed FROM g WHERE top NOT IN ('SMALL','PROMO') OR slug='mosfets'""", "parts_v"))
def subcategory_groups(spark, sf):
    p = b.parts(spark, sf).select(F.col("category").alias("top"), keys.slug_category("catalog_name").alias("final_slug"), F.col("catalog_name").alias("final_subcategory"), "mpn", "manufacturer", "ord")
    tops = p.select(F.col("top").alias("slug")).distinct().withColumn("publish_status", F.when(F.col("slug") == "SMALL", "hidden").when(F.col("slug") == "PROMO", "review").otherwise("active"))
    return publish.subcategory_pages(p, tops, ["mosfets"])["groups"].select("top", "slug", "n", "indexed")


@query(b.sql("""WITH p AS (SELECT *, CASE WHEN category='PROMO' THEN 'Power MOSFETs' ELSE category END AS sub, ord%3 AS k FROM parts_v),
  v AS (SELECT *, CASE WHEN sub='Power MOSFETs' THEN size||' V '||size||' mA' ELSE '' END AS facts FROM p)
  SELECT lower(cid) AS url_slug, trim(mpn||' '||manufacturer||' '||facts) AS title,
  CASE WHEN facts='' THEN mpn||' '||manufacturer||' '||sub||'. ' ELSE mpn||' '||manufacturer||' '||sub||' — '||size||' V, '||size||' mA; ' END||CASE k WHEN 0 THEN 'datasheet, ' ELSE '' END||CASE k WHEN 1 THEN '1 alternative, ' WHEN 2 THEN '2 alternatives, ' ELSE '' END||'specs.' AS meta,
  'LQFP-48' AS package, size>25 AS rohs_badge, CASE k WHEN 0 THEN 'About '||description WHEN 1 THEN '± '||description END AS introduction, 'Number of Channels: '||size AS key_attributes,
  '[{"label":"Drain-Source Voltage","value":"'||size||' V"},{"label":"Continuous Drain Current","value":"'||size||' mA"}]' AS specs, 'Motors|Lamps' AS applications, 'Fast|Small' AS features,
  '['||CASE WHEN size>25 THEN '{"label":"RoHS","value":"RoHS3"},' ELSE '' END||'{"label":"ECCN","value":"EAR99"},{"label":"CNHTS","value":"8542"},{"label":"USHTS","value":"8541"}]' AS compliance,
  CASE k WHEN 2 THEN '[]' ELSE '[{"question":"What is it?","answer":"'||description||'"}]' END AS faqs, CASE k WHEN 0 THEN '' WHEN 1 THEN 'A1' ELSE 'A1,B2' END AS alternates FROM v""", "parts_v"))
def page_records(spark, sf):
    """Page facts per part: labels, display values, applications, questions, compliance, title; introductions that are fine, damaged and in another script;
    questions to drop; none to several alternates; parts with and without a document and title values."""
    p = b.parts(spark, sf)
    k, t = F.col("ord") % 3, F.col("description")
    asked = lambda q, a: F.struct(F.lit(q).alias("question"), a.alias("answer"))
    faqs = F.when(k == 2, F.array(asked("What does it cost?", F.lit("$ 3")))).otherwise(F.array(asked("What is it?", t), asked("what IS it", F.lit("again")), asked("Where to buy?", F.lit("here"))))
    intro = F.when(k == 0, F.concat(F.lit("About "), t)).when(k == 1, F.concat(F.lit(next(bad for bad, good in MOJIBAKE.items() if good == "±")), F.lit(" "), t)).otherwise(F.concat(F.lit("关于 "), t))
    product = F.struct(
        F.col("cid").alias("productCode"), _params().alias("paramVOList"), F.lit("").alias("productKeyAttributes"), F.lit("LQFP-48(7x7)").alias("encapStandard"),
        (F.col("size") > 25).alias("isRohsCert"), F.lit("RoHS3").alias("rohsCertType"), F.lit("EAR99").alias("eccn"), F.lit(True).alias("isAsianBrand"),
        F.create_map(F.lit("US"), F.lit("8541"), F.lit("CN"), F.lit("8542")).alias("htsMap"), faqs.alias("faqs"))
    raw = p.select("ord", F.col("cid").alias("code"), product.alias("product"), intro.alias("introduction"), F.lit("• Motors\n- Lamps").alias("applications"), F.lit("* Fast\n* Small").alias("features"))
    parts = p.select(
        "mpn", "manufacturer", F.col("cid").alias("supplier_reference"), F.lower("cid").alias("url_slug"),
        F.to_json(F.struct(F.col("size").alias("vdss_v"), (F.col("size") / 1000).alias("id_a"))).alias("attributes_json"), F.lit("transistors").alias("native_l1"),
        F.when(F.col("category") == "PROMO", "Power MOSFETs").otherwise(F.col("category")).alias("subcategory"),
        F.when(k == 0, "[]").when(k == 1, '[{"mpn":"A1"},{"mpn":""}]').otherwise('[{"mpn":"A1"},{"mpn":"B2"}]').alias("alternative_parts_detail"), F.when(k == 0, "https://d/x.pdf").otherwise("").alias("datasheet_url"))
    out = publish.page_records(parts, raw, tasks=b.tasks_for(p))
    return out.select("url_slug", "title", "meta", "package", "rohs_badge", "introduction", "key_attributes", F.to_json("specs").alias("specs"), F.array_join("applications", "|").alias("applications"),
                      F.array_join("features", "|").alias("features"), F.to_json("compliance").alias("compliance"), F.to_json("faqs").alias("faqs"), F.array_join(F.transform("alternates", lambda a: a["mpn"]), ",").alias("alternates"))


@query(b.sql("""SELECT name, count(*) AS n FROM (SELECT unnest(['Output Voltage','Capacitance','legacy']) AS name FROM parts_v) GROUP BY 1""", "parts_v"))
def publish_normalised(spark, sf):
    p = b.parts(spark, sf).withColumn("attributes_json", F.to_json(F.create_map(F.lit("输出电压"), F.col("quantity"), F.lit("容值"), F.lit("1"), F.lit("legacy"), F.lit("x"))))
    none = p.limit(0).select(F.lit("").alias("key"), F.lit("").alias("value"))
    out, _ = publish.publish_normalize(p, none)
    return out.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(b.sql("""SELECT ord AS row, unnest(['Surge Current','X','Nameless','无主']) AS name, unnest(['dictionary','untranslated','majority','untranslated']) AS key_tier,
  unnest([ord||' °C','1 Form A (SPST, NO)','未知'||ord,'Some Value']) AS value, unnest(['rules','rules','untranslated','majority']) AS value_tier FROM parts_v""", "parts_v"))
def publish_values(spark, sf):
    """Names by dictionary, by majority of votes and not at all; values by rules, by votes and not at all."""
    p, n = b.parts(spark, sf), F.col("ord").cast("string")
    text = F.to_json(F.create_map(F.lit("surge_current_a"), F.concat(n, F.lit(" ℃")), F.lit("X"), F.lit("一组常开:1A(单刀单掷-常开)"), F.lit("无名"), F.concat(F.lit("未知"), n), F.lit("无主"), F.lit("某值")))
    votes = merge.majority_translation(p.select(F.lit("无名").alias("key"), F.when(F.col("size") < 40, "Nameless").otherwise("No Name").alias("value")))
    values = p.limit(1).select(F.lit("某值").alias("key"), F.lit("Some Value").alias("value"))
    return publish.publish_normalize(p.withColumn("attributes_json", text), votes, values)[0].select("row", "name", "key_tier", "value", "value_tier")


# ---- search --------------------------------------------------------------------------------

def _entries(spark, sf):
    p = b.parts(spark, sf)
    part = p.select(F.concat(F.lit("p"), F.col("ord").cast("string")).alias("entry_id"), F.lit("PART").alias("type"), F.col("mpn").alias("label"),
                    F.array(F.lower("cid"), keys.slug_alnum("mpn")).alias("aliases"), F.concat(F.lit("/products/"), F.lower("cid")).alias("url"))
    s = b.read(spark, sf, "supplier")
    maker = s.select(F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("entry_id"), F.lit("MANUFACTURER").alias("type"), F.col("s_name").alias("label"),
                     F.array().cast("array<string>").alias("aliases"), F.concat(F.lit("/m/"), F.col("s_suppkey").cast("string")).alias("url"))
    n = b.read(spark, sf, "nation")
    cat = n.select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("entry_id"), F.lit("CATEGORY").alias("type"), F.col("n_name").alias("label"),
                   F.array().cast("array<string>").alias("aliases"), F.concat(F.lit("/c/"), F.col("n_nationkey").cast("string")).alias("url"))
    return part.unionByName(maker).unionByName(cat)


def _queries(spark, sf):
    """Searches: words of part names, code beginnings, supplier names, and names that match nothing."""
    p = b.parts(spark, sf)
    words = p.select(F.explode(F.split("description", " ")).alias("query"))
    codes = p.where("size > 48").select(F.lower("cid").alias("query"))
    makers = b.read(spark, sf, "supplier").select(F.lower("s_name").alias("query"))
    nations = b.read(spark, sf, "nation").select(F.lower("n_name").alias("query"))
    none = b.read(spark, sf, "region").select(F.concat(F.lit("zz "), F.col("r_name")).alias("query"))
    return words.unionByName(codes).unionByName(makers).unionByName(nations).unionByName(none).distinct()


_SEARCH = """e AS (SELECT 'p'||ord AS entry_id, 'PART' AS type, mpn AS label, [lower(cid), replace(lower(mpn),'-','')] AS aliases, '/products/'||lower(cid) AS url FROM parts_v
  UNION ALL SELECT 'm'||s_suppkey, 'MANUFACTURER', s_name, [], '/m/'||s_suppkey FROM supplier UNION ALL SELECT 'c'||n_nationkey, 'CATEGORY', n_name, [], '/c/'||n_nationkey FROM nation),
 q AS (SELECT DISTINCT lower(query) AS query FROM (SELECT unnest(string_split(description,' ')) AS query FROM parts_v UNION ALL SELECT lower(cid) FROM parts_v WHERE size>48 UNION ALL SELECT lower(s_name) FROM supplier
  UNION ALL SELECT lower(n_name) FROM nation UNION ALL SELECT 'zz '||r_name FROM region)),
 nm AS (SELECT entry_id, unnest(list_concat([label], aliases)) AS nm FROM e),
 ac AS (SELECT DISTINCT entry_id, nm, lower(nm) AS l, lower(array_to_string(list_transform(regexp_split_to_array(nm,'\\s+'), lambda x: substr(x,1,1)),'')) AS a1, lower(regexp_replace(nm,'[^A-Z]','','g')) AS a2 FROM nm),
 m AS (SELECT query, entry_id, min(CASE WHEN l=query THEN 1 WHEN starts_with(l,query) THEN 2 WHEN starts_with(a1,query) OR starts_with(a2,query) THEN 3 WHEN contains(l,query) THEN 4 END) AS score FROM q, ac
   WHERE contains(l,query) OR starts_with(a1,query) OR starts_with(a2,query) GROUP BY 1,2),
 mm AS (SELECT m.query, e.entry_id, e.type, e.label, e.url, m.score FROM m JOIN e USING (entry_id))"""


@query(b.sql(f"WITH {_SEARCH} SELECT query, type, score, count(*) AS n FROM mm GROUP BY 1,2,3", "parts_v"))
def search_matches(spark, sf):
    m = search.search(_entries(spark, sf), _queries(spark, sf))
    return m.groupBy("query", "type", "score").agg(F.count(F.lit(1)).alias("n"))


@query(b.sql(f"WITH {_SEARCH} SELECT query, type, pos, entry_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query, type ORDER BY score, lower(label), label, entry_id) AS pos FROM mm) WHERE pos<=8", "parts_v"))
def search_ranked(spark, sf):
    return search.rank_matches(search.search(_entries(spark, sf), _queries(spark, sf))).select("query", "type", "pos", "entry_id", "score")


@query(b.sql(f"WITH {_SEARCH} SELECT query, type, pos, entry_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query, type ORDER BY score, lower(label), label, entry_id) AS pos FROM mm) WHERE pos<=8", "parts_v"))
def search_indexed(spark, sf):
    """The same answers from an index that was written in two batches."""
    index, entries = search.SearchIndex(spark, _fresh_dir(spark, "search"), 32), _entries(spark, sf)
    late = F.pmod(F.xxhash64("entry_id"), F.lit(3)) == 0
    index.add(entries.where(~late), "first")
    index.add(entries.where(late), "second")
    return search.rank_matches(index.search(_queries(spark, sf))).select("query", "type", "pos", "entry_id", "score")


@query(b.sql(f"""WITH {_SEARCH} SELECT q.query, CASE WHEN ex=1 THEN pu WHEN np>=1 THEN r WHEN no=1 THEN ou ELSE r END AS url FROM (SELECT query, '/search/?q='||replace(replace(query,' ','+'),'#','%23') AS r FROM q) q
  LEFT JOIN (SELECT query, count(*) FILTER (WHERE type='PART' AND score=1) AS ex, count(*) FILTER (WHERE type='PART') AS np, count(*) FILTER (WHERE type<>'PART') AS no,
   min(url) FILTER (WHERE type='PART' AND score=1) AS pu, min(url) FILTER (WHERE type<>'PART') AS ou FROM mm GROUP BY 1) f ON f.query=q.query""", "parts_v"))
def search_routed(spark, sf):
    q = _queries(spark, sf)
    return search.route(search.search(_entries(spark, sf), q), q)


# ---- quality and documents -------------------------------------------------------------------

@query("""SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key FROM documents GROUP BY 1 HAVING count(*)>1""")
def content_duplicates(spark, sf):
    return aggregates.content_duplicates(b.read(spark, sf, "documents"), F.col("text"), "doc_id")


@query("""WITH f AS (SELECT count(*) AS t, count(*) FILTER (WHERE trim(text)<>'') AS a, count(*) FILTER (WHERE trim(lang)<>'') AS c, count(*) FILTER (WHERE trim(source)<>'') AS d FROM documents)
  SELECT 'text' AS "column", a AS filled, round(a/t,6) AS share FROM f UNION ALL SELECT 'lang', c, round(c/t,6) FROM f UNION ALL SELECT 'source', d, round(d/t,6) FROM f""")
def fill_rate(spark, sf):
    return aggregates.fill_rate(b.read(spark, sf, "documents"), ["text", "lang", "source"])


@query(b.sql("""SELECT 'mpn' AS "column", count(*) AS rows, count(DISTINCT mpn) AS distinct_values, 0 AS blanks FROM parts_v UNION ALL SELECT 'manufacturer', count(*), count(DISTINCT manufacturer), 0 FROM parts_v
  UNION ALL SELECT 'size', count(*), count(DISTINCT size), 0 FROM parts_v""", "parts_v"))
def quality_stats(spark, sf):
    return aggregates.quality_stats(b.parts(spark, sf), ["mpn", "manufacturer", "size"])


@query(b.sql("SELECT category AS value, count(*) AS n FROM parts_v GROUP BY 1", "parts_v"))
def category_distribution(spark, sf):
    return aggregates.distribution(b.parts(spark, sf), "category")


@query("""SELECT coalesce(a.m,c.m) AS metric, a.v AS run_a, c.v AS run_b, coalesce(c.v,0)-coalesce(a.v,0) AS delta FROM (SELECT l_returnflag AS m, count(*) AS v FROM lineitem WHERE l_linestatus='F' GROUP BY 1) a
  FULL JOIN (SELECT l_returnflag AS m, count(*) AS v FROM lineitem WHERE l_linestatus='O' GROUP BY 1) c ON a.m=c.m""")
def metric_delta(spark, sf):
    li = b.read(spark, sf, "lineitem")
    run = lambda s: li.where(F.col("l_linestatus") == s).groupBy(F.col("l_returnflag").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    return aggregates.metric_delta(run("F"), run("O"))


@query(b.sql("""SELECT m.ord, m.last_ship AS before, s.last_ship AS after FROM master_v m JOIN snap_v s ON s.ord=m.ord WHERE m.last_ship<>s.last_ship""", "master_v", "snap_v"))
def reclassified(spark, sf):
    return aggregates.reclassified(b.master(spark, sf), b.snapshot_new(spark, sf), "ord", "last_ship")


@query("""SELECT event_type AS stage, count(DISTINCT user_id) AS batches, count(*) AS records FROM events GROUP BY 1""")
def pool_stats(spark, sf):
    return aggregates.pool_stats(b.ledger(spark, sf).select(F.col("status").alias("stage"), F.col("asset").alias("batch_id")))


@query(b.sql(f"""WITH {_LINKED}, docs AS (SELECT regexp_extract(datasheet_url,'([^/]+)\\.pdf$',1) AS stem FROM linked WHERE datasheet_url<>''), k AS (SELECT DISTINCT lower(stem) AS k FROM docs),
  m AS (SELECT CASE WHEN lower(cid) IN (SELECT k FROM k) THEN 'cid' WHEN lower(mpn) IN (SELECT k FROM k) THEN 'mpn'
   WHEN regexp_replace(lower(mpn),'[^a-z0-9]','','g') IN (SELECT regexp_replace(k,'[^a-z0-9]','','g') FROM k) THEN 'alnum_mpn' ELSE 'missing' END AS method FROM parts_v)
  SELECT count(*) AS total, 0 AS preserved, count(*) FILTER (WHERE method<>'missing') AS mapped, count(*) FILTER (WHERE method='missing') AS missing, count(*) FILTER (WHERE method='cid') AS by_cid,
  count(*) FILTER (WHERE method='mpn') AS by_mpn, count(*) FILTER (WHERE method='alnum_mpn') AS by_alnum_mpn, 0 AS by_clean_mpn, round(100.0*count(*) FILTER (WHERE method<>'missing')/count(*),1) AS coverage_pct FROM m""", "parts_v"))
def document_coverage(spark, sf):
    linked = _linked(spark, sf)
    docs = linked.where("datasheet_url <> ''").select(F.col("datasheet_url").alias("path"), F.regexp_replace(F.substring_index("datasheet_url", "/", -1), r"\.pdf$", "").alias("stem"))
    p = linked.select(F.col("ord").alias("part_id"), F.col("cid").alias("code"), "mpn", F.lit("").alias("clean_mpn"), F.lit("").alias("url"))
    return aggregates.coverage_summary(assets.document_map(p, docs, "https://files.r2.dev"))


@query(b.sql("""SELECT b.ord, CASE WHEN c.u IS NOT NULL THEN 'set' WHEN x.u IS NOT NULL THEN 'set' ELSE 'preserved' END AS map_result, coalesce(c.u, x.u, 'old') AS datasheet_url FROM batch_v b
  LEFT JOIN (SELECT supplier_reference AS k, max(last_ship) AS u FROM master_v GROUP BY 1) c ON c.k=b.supplier_reference LEFT JOIN (SELECT mpn AS k, arg_max(last_ship, ord) AS u FROM master_v GROUP BY 1) x ON x.k=b.mpn""", "batch_v", "master_v"))
def document_map_applied(spark, sf):
    mapping = b.master(spark, sf).select("supplier_reference", "mpn", F.col("last_ship").alias("url"), "ord", F.lit("mapped").alias("status"))
    return assets.apply_map(b.batch(spark, sf).withColumn("datasheet_url", F.lit("old")), mapping).select("ord", "map_result", "datasheet_url")


@query("""SELECT doc_id AS key, CASE WHEN lang='en' THEN 'MISSING' WHEN source='src3' THEN 'REMOTE_HASH_MISMATCH' ELSE 'OK' END AS status FROM documents""")
def assets_reconciled(spark, sf):
    d = b.read(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("size"))
    local = d.select(F.col("doc_id").alias("key"), "size", "sha256", F.col("sha256").alias("sha256_again"))
    wrong = F.when(F.col("source") == "src3", F.lit("x")).otherwise(F.col("sha256"))
    remote = d.where("lang <> 'en'").select(F.col("doc_id").alias("key"), "size", F.when(F.col("lang") == "de", "").otherwise(wrong).alias("meta_sha256"), wrong.alias("content_sha256"))
    return gates.reconcile_assets(local, remote)


@query("""SELECT doc_id AS row, len(list_filter(string_split(replace(text, chr(13), ''), chr(10)), lambda x: trim(x)<>'')) AS lines FROM documents""")
def text_lines(spark, sf):
    d = b.read(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("row"), F.size(attrs.applications("text")).cast("long").alias("lines"))


@query(b.sql("""SELECT 'MFR-'||lpad(CAST(row_number() OVER (ORDER BY canonical) AS VARCHAR),5,'0') AS mfr_id, canonical, CASE WHEN seeded=1 THEN 'active' ELSE 'candidate' END AS status, CASE WHEN seeded=1 THEN 'A' ELSE 'B' END AS tier
  FROM (SELECT canonical, max(s) AS seeded FROM (SELECT canonical, 1 AS s FROM alias_v UNION ALL SELECT s_name, 0 FROM supplier) GROUP BY 1)""", "alias_v"))
def dictionary_ids(spark, sf):
    from catalogflow.operators.merge import build_dictionary

    p = b.read(spark, sf, "part").select(F.col("p_brand").alias("raw"), F.col("p_partkey").alias("ord"))
    s = b.read(spark, sf, "supplier").select(F.col("s_name").alias("raw"), (F.col("s_suppkey") + 10**12).alias("ord"))
    d, _ = build_dictionary(p.unionByName(s), b.aliases(spark, sf).withColumnRenamed("raw", "alias"))
    return d


@query("""WITH t AS (SELECT o_orderkey AS k, 0 AS n, 0 AS p, 0 AS s, 'o'||o_orderkey AS id, 1 AS level FROM orders UNION ALL
   SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l'||l_orderkey||'-'||l_linenumber||'-'||l_partkey||'-'||l_suppkey, CASE WHEN l_partkey%3=0 THEN 2 ELSE 3 END FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)),
  a AS (SELECT *, last_value(CASE WHEN level=1 THEN id END IGNORE NULLS) OVER w AS l1_id FROM t WINDOW w AS (ORDER BY k, n, p, s))
  SELECT id, level, l1_id, last_value(CASE WHEN level=2 THEN id END IGNORE NULLS) OVER (PARTITION BY l1_id ORDER BY k, n, p, s) AS l2_id FROM a""")
def carry_parent(spark, sf):
    """Orders are nodes of level 1, every third of their lines is of level 2, the others of level 3."""
    from catalogflow.operators.ordering import carry_parent as carry

    zero = F.lit(0).cast("long")
    o = b.read(spark, sf, "orders").select(F.struct(F.col("o_orderkey").alias("k"), zero.alias("n"), zero.alias("p"), zero.alias("s")).alias("ord"), F.lit(1).alias("level"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"))
    key = [F.col(c).cast("long") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    n = b.read(spark, sf, "lineitem").select(F.struct(*[c.alias(a) for c, a in zip(key, "knps")]).alias("ord"), F.when(F.col("l_partkey") % 3 == 0, 2).otherwise(3).alias("level"),
                                             F.concat(F.lit("l"), F.concat_ws("-", *key)).alias("id")).distinct()
    return carry(o.unionByName(n)).select("id", "level", "l1_id", "l2_id")


# ---- logs and streams ----------------------------------------------------------------------------

@query("""SELECT user_id AS asset, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events GROUP BY 1""")
def ledger_latest(spark, sf):
    return logs.ledger_latest(b.ledger(spark, sf), "asset", ["at", "ord"]).select("asset", "status", "at")


_FLOW = {"signup": ("view", "click"), "view": ("click", "purchase", "error"), "click": ("purchase", "error", "view"), "purchase": ("view",), "error": ("view",)}


@query("""SELECT event_id AS ord, before, event_type AS status FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  WHERE before<>event_type AND before||'>'||event_type NOT IN ('signup>view','signup>click','view>click','view>purchase','view>error','click>purchase','click>error','click>view','purchase>view','error>view')""")
def transition_violations(spark, sf):
    return logs.validate_transitions(b.ledger(spark, sf), "asset", ["at", "ord"], "status", _FLOW).select("ord", "before", "status")


@query("""SELECT user_id AS asset, event_type AS status, count(*) AS length, min(event_id) AS from_ord, max(event_id) AS to_ord FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS g FROM events) WHERE event_type IN ('error','view')
  GROUP BY user_id, event_type, g HAVING count(*)>=2""")
def error_streaks(spark, sf):
    return logs.error_streaks(b.ledger(spark, sf), "asset", ["ord"], "status", ["error", "view"], 2)


@query("""WITH s AS (SELECT DISTINCT user_id%10 AS slice_idx FROM events), l AS (SELECT user_id%10 AS slice_idx, event_type, CAST(round(value) AS BIGINT) AS size FROM events),
  a AS (SELECT slice_idx, count(*) AS assets, count(*) FILTER (WHERE event_type='purchase') AS verified, count(*) FILTER (WHERE event_type='error') AS failed, sum(size) AS bytes FROM l GROUP BY 1)
  SELECT s.slice_idx, grouping(s.slice_idx) AS is_total, count(*) AS slices, sum(assets) AS assets, sum(verified) AS verified, sum(failed) AS failed, sum(bytes) AS bytes, sum(assets-verified-failed) AS skips FROM s JOIN a USING (slice_idx) GROUP BY ROLLUP(s.slice_idx)""")
def wave_report(spark, sf):
    e = b.read(spark, sf, "events").withColumn("slice_idx", F.col("user_id") % 10)
    status = F.when(F.col("event_type") == "purchase", "VERIFIED").when(F.col("event_type") == "error", "FAILED").otherwise("OTHER")
    ledger = e.select("slice_idx", status.alias("status"), F.round("value").cast("long").alias("size"))
    exc = e.where("event_type not in ('purchase','error')").select("slice_idx", F.lit("AUTO_SKIP").alias("severity"))
    s = e.select("slice_idx").distinct().withColumn("state", F.lit("READY_FOR_RELEASE"))
    return aggregates.wave_report(s, ledger, exc).select("slice_idx", "is_total", "slices", "assets", "verified", "failed", "bytes", "skips")


@query("""SELECT event_type AS error_code, count(*) AS n FROM events GROUP BY 1""")
def failure_histogram(spark, sf):
    return aggregates.failure_histogram(b.ledger(spark, sf), "status")


@query("""SELECT date_trunc('hour', ts) AS bucket, event_type AS status, count(*) AS n FROM events GROUP BY 1,2""")
def outcomes_hourly(spark, sf):
    return logs.outcome_counts(b.ledger(spark, sf), "at", "status")


def _event_stream(spark, sf):
    schema = b.read(spark, sf, "events").schema
    return jobs.read_files(spark, sf, schema, "parquet", "events.parquet")


@query("""SELECT date_trunc('hour', ts) AS bucket, event_type AS status, count(*) AS n FROM events GROUP BY 1,2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def run_monitor_hourly(spark, sf):
    """Buckets the watermark has closed after all files were read."""
    out, cp = _fresh_dir(spark, "monitor"), _fresh_dir(spark, "monitor-cp")
    counts = jobs.run_monitor(_event_stream(spark, sf).select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("status")))
    jobs.start_monitor(counts, out, cp).awaitTermination()
    return spark.read.parquet(out)


@query("""SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS mpn, event_type AS manufacturer FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id)=1""")
def incremental_intake(spark, sf):
    out, cp = _fresh_dir(spark, "accepted"), _fresh_dir(spark, "accepted-cp")
    stream = _event_stream(spark, sf).select(F.col("event_id").alias("ord"), F.col("user_id").cast("string").alias("mpn"), F.col("event_type").alias("manufacturer"))
    jobs.incremental_intake(stream, out, cp).awaitTermination()
    return spark.read.parquet(out).select("ord", "mpn", "manufacturer")


@query("""SELECT user_id AS asset, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events GROUP BY 1""")
def ledger_latest_stream(spark, sf):
    out, cp = _fresh_dir(spark, "latest"), _fresh_dir(spark, "latest-cp")
    stream = _event_stream(spark, sf).select(F.col("user_id").alias("asset"), F.col("event_type").alias("status"), F.col("ts").alias("at"), F.col("event_id").alias("ord"))
    jobs.latest_upsert(stream, out, cp).awaitTermination()
    return jobs.current_version(spark, out).select("asset", "status", "at")


_RUNS_SQL = """SELECT user_id AS asset, event_type AS status, count(*) AS length, min(event_id) FILTER (WHERE n=1) AS from_ord, arg_max(event_id, p) AS to_ord FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, p-k ORDER BY p) AS n FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS p, row_number() OVER (PARTITION BY user_id, event_type ORDER BY epoch_ms(ts), event_id) AS k FROM events) WHERE event_type IN ('error','view')) x
  GROUP BY user_id, event_type, p-k HAVING count(*)>=2"""


@query(_RUNS_SQL)
def error_runs_followed(spark, sf):
    """Runs kept in keyed state over three deliveries in which records are out of order and repeated, with a restart before each; a last record moves the watermark past all."""
    from datetime import timedelta

    from catalogflow.streaming import state

    source, out, cp = (_fresh_dir(spark, f"follow-{x}") for x in ("in", "out", "cp"))
    e = b.read(spark, sf, "events").select(F.col("user_id").alias("asset"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("ord"))
    micros = F.unix_micros("at")
    first, last = e.agg(F.min(micros), F.max(micros)).first()
    third = (last - first) // 3 + 1
    end = spark.range(1).select(F.lit(-1).cast("long").alias("asset"), F.lit("end").alias("status"), F.timestamp_micros(F.lit(last + 30 * third)).alias("at"), F.lit(-1).cast("long").alias("ord"))
    deliveries = [e.where((micros >= first + i * third - third // 20) & (micros < first + (i + 1) * third)) for i in range(3)]
    for rows in [*deliveries, end]:
        rows.orderBy(F.xxhash64("ord")).write.mode("append").parquet(source)
        stream = jobs.read_files(spark, source, e.schema, "parquet")
        state.start_following(state.follow_assets(stream, ["error", "view"], 2, timedelta(days=1), f"{third // 4_000_000} seconds"), out, cp)
    return state.followed(spark, out, "run").select("asset", "status", "length", "from_ord", "to_ord")


# ---- audits -----------------------------------------------------------------------------------------

@query(b.sql("""SELECT metric, run_a, run_b, run_b-run_a AS delta FROM (SELECT 'rows' AS metric, (SELECT count(*) FROM master_v) AS run_a, (SELECT count(*) FROM batch_v) AS run_b
  UNION ALL SELECT 'categories', (SELECT count(DISTINCT category) FROM master_v), (SELECT count(DISTINCT category) FROM batch_v) UNION ALL SELECT 'uncategorized',0,0
  UNION ALL SELECT 'rows_with_specs', (SELECT count(*) FROM master_v), (SELECT count(*) FROM batch_v) UNION ALL SELECT 'rows_with_leaks', (SELECT count(*) FROM master_v WHERE qty>40), (SELECT count(*) FROM batch_v WHERE qty>40))""", "master_v", "batch_v"))
def batch_report(spark, sf):
    j = lambda d: d.withColumn("attributes_json", F.when(F.col("qty") > 40, F.lit('{"a":1,"x":{"cost":2}}')).otherwise('{"a":1}'))
    return audit.batch_report(j(b.master(spark, sf)), j(b.batch(spark, sf)))


@query(b.sql("""SELECT 'A_l1_known' AS "check", (SELECT count(*) FROM parts_v WHERE category='SMALL') AS n, CASE WHEN (SELECT count(*) FROM parts_v WHERE category='SMALL')=0 THEN 'PASS' ELSE 'FAIL' END AS status
  UNION ALL SELECT 'B_same_parts', n, CASE WHEN n=0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) AS n FROM (SELECT mpn FROM parts_v EXCEPT SELECT mpn FROM parts_v WHERE size>10))
  UNION ALL SELECT 'C_same_l1', n, CASE WHEN n=0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) AS n FROM (SELECT mpn, min(category) AS c FROM parts_v GROUP BY 1) a JOIN (SELECT mpn, min(category) AS c FROM parts_v WHERE size>10 GROUP BY 1) d USING (mpn) WHERE a.c<>d.c)
  UNION ALL SELECT 'D_tokens', 0, 'PASS' UNION ALL SELECT 'E_links', n, CASE WHEN n=0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) AS n FROM (SELECT unnest(regexp_extract_all(html,'href="([^"]*)"',1)) AS href FROM pages) WHERE href LIKE '/%' AND href NOT LIKE '//%' AND regexp_replace(regexp_replace(trim(href),'[?#].*$',''),'/+$','')<>'/and')""", "parts_v"))
def classification_consistency(spark, sf):
    from catalogflow.functions import markup

    p = b.parts(spark, sf).withColumn("native_l1", F.col("category"))
    l1 = p.select(F.col("category").alias("slug")).where("slug <> 'SMALL'").distinct()
    pages = b.read(spark, sf, "pages")
    links = pages.select(F.explode(markup.hrefs("html")).alias("href"))
    site = b.read(spark, sf, "region").select(F.lit("/and").alias("path"))
    return audit.classification_consistency(p, p.where("size > 10"), links, site, l1)


@query(b.sql(f"""WITH {_LINKED}, t AS (SELECT 'synthetic' AS "check", 0 AS n, 'FAIL' AS bad UNION ALL SELECT 'tokens', 0, 'FAIL'
  UNION ALL SELECT 'records_without_page', count(DISTINCT regexp_replace(lower(mpn||'-'||ord),'[^a-z0-9]','','g')), 'FAIL' FROM linked WHERE size<=5
  UNION ALL SELECT 'pages_without_record', count(*), 'WARN' FROM nation UNION ALL SELECT 'json_ld_errors', count(*), 'FAIL' FROM pages WHERE page_id%5=0
  UNION ALL SELECT 'cjk', count(*), 'FAIL' FROM pages WHERE page_id%3=0 UNION ALL SELECT 'document_hosts', count(*), 'FAIL' FROM hosted WHERE verdict LIKE 'BAD%')
  SELECT "check", n, CASE WHEN n=0 THEN 'PASS' ELSE bad END AS status FROM t""", "parts_v"))
def catalog_audit(spark, sf):
    """Records without a page, pages without a record, damaged JSON-LD, visible CJK text and unsuitable hosts all occur."""
    p = _linked(spark, sf).withColumn("mpn", F.concat_ws("-", "mpn", F.col("ord").cast("string")))
    broken = F.when(F.col("page_id") % 5 == 0, '<script type="application/ld+json">{"@type":</script>').otherwise("")
    cjk = F.when(F.col("page_id") % 3 == 0, "<p>温度</p>").otherwise("")
    pages = b.read(spark, sf, "pages").withColumn("html", F.concat("html", broken, cjk))
    orphans = b.read(spark, sf, "nation").select(F.concat(F.lit("orphan "), "n_name").alias("key"))
    page_keys = p.where("size > 5").select(F.col("mpn").alias("key")).unionByName(orphans)
    checks, _ = audit.catalog_audit(p, pages, page_keys)
    return checks


@query("""SELECT 'C'||page_id AS code, coalesce(regexp_extract(html,'<meta[^>]+name="description"[^>]+content="([^"]*)"',1),'') AS description, 0 AS pairs, 0 AS faqs, '' AS applications, 0 AS alternates FROM pages""")
def page_enrichment(spark, sf):
    """Whole pages as they are, without data of any kind; ``pages_to_patch`` has pages with all of it."""
    p = b.read(spark, sf, "pages").select(F.col("page_id").alias("ord"), F.concat(F.lit("C"), F.col("page_id").cast("string")).alias("code"), F.col("url").alias("mpn"), "html")
    f = audit.page_facts(p)
    return f.select("code", "description", F.size("pairs").alias("pairs"), F.size("faqs").alias("faqs"), F.array_join("applications", "|").alias("applications"), F.size("alternates").alias("alternates"))


@query(b.sql(f"""WITH {_TAX}, g AS (SELECT coalesce(a.canonical, trim(v.manufacturer)) AS brand, v.mpn, min(v.ord) AS ord, arg_min('nation_'||(partkey%25), v.ord) AS nl, count(*) AS offers, count(DISTINCT source) AS sources
   FROM offers_v v LEFT JOIN alias_v a ON lower(trim(v.manufacturer))=a.raw GROUP BY 1,2), cm AS (SELECT *, regexp_replace(lower(mpn),'[^a-z0-9]','','g') AS cm FROM g),
  sd AS (SELECT *, CASE WHEN ord=min(ord) OVER (PARTITION BY cm) THEN cm ELSE cm||'-'||trim(regexp_replace(lower(brand),'[^a-z0-9]+','-','g'),'-') END AS seed FROM cm),
  rk AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY ord) AS rn FROM sd)
  SELECT mpn, brand AS manufacturer, CASE WHEN rn=1 THEN seed ELSE seed||'-'||rn END AS url_slug, coalesce(l1.top,'__UNMAPPED__') AS top, CASE WHEN l1.slug IS NULL THEN 'UNMAPPED' ELSE 'RESOLVED' END AS tax_status, offers, sources FROM rk LEFT JOIN l1 ON nl=l1.slug""", "offers_v", "alias_v"))
def catalog_records(spark, sf):
    """Offers to published records: merge, slugs, taxonomy."""
    tops, l1 = _taxonomy(spark, sf)
    offers = b.offers(spark, sf).withColumn("supplier_reference", F.concat(F.lit("C"), F.col("partkey").cast("string"))).withColumn(
        "native_l1", F.concat(F.lit("nation_"), (F.col("partkey") % 25).cast("string")))
    none = b.parts(spark, sf).limit(0).select(F.col("cid").alias("code"), "mpn", "manufacturer", F.lit("").alias("slug"))
    c = publish.catalog_build(offers.drop("partkey", "suppkey", "quantity", "price", "returnflag", "linestatus", "size"), b.aliases(spark, sf), none, tops, l1)
    return c.records.select("mpn", "manufacturer", "url_slug", "top", "tax_status", "offers", F.size("sources").alias("sources"))
