"""Key, text, unit, attribute and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import attrs, classify, keys, markup, text, units
from catalogflow.operators import aggregates, gates, merge
from catalogflow.queries.registry import query


@query("""SELECT url, upper(trim(url)) AS k1, regexp_replace(lower(trim(url)),'[\\s ]+','','g') AS k2, regexp_replace(lower(trim(url)),'[\\s -]','','g') AS k3,
  regexp_replace(lower(trim(url)),'[^a-z0-9]','','g') AS k4, regexp_replace(lower(trim(url)),'[\\s ()\\-]','','g') AS k5, regexp_replace(lower(url),'[^a-z0-9._-]','-','g') AS k6, trim(url) AS k7 FROM pages""")
def key_modes(spark, sf):
    p = b.read(spark, sf, "pages")
    return p.select("url", *[fn("url").alias(f"k{i}") for i, fn in enumerate(
        (keys.key_upper, keys.key_nospace, keys.key_nospace_nohyphen, keys.key_alnum, keys.key_noparen, keys.key_filesafe, keys.key_exact), 1)])


@query("""SELECT url, regexp_replace(lower(url),'[^a-z0-9]','','g') AS alnum, trim(regexp_replace(lower(url),'[^a-z0-9]+','-','g'),'-') AS hyphen,
  lower(regexp_extract(url,'^[a-z]+://([^/?#]+)',1)) AS host,
  regexp_replace(lower(regexp_extract(regexp_replace(trim(url),'[?#].*$',''),'([^/]*)$',1)),'\\.pdf$','') AS object_name,
  'datasheets/pdf/'||substr(sha256(url),1,2)||'/'||sha256(url)||'.pdf' AS content_key FROM pages""")
def slugs_and_urls(spark, sf):
    p = b.read(spark, sf, "pages")
    return p.select("url", keys.slug_alnum("url").alias("alnum"), keys.slug_hyphen("url").alias("hyphen"), keys.url_host("url").alias("host"),
                    keys.object_name("url").alias("object_name"), keys.content_key("datasheets/pdf", F.sha2("url", 256)).alias("content_key"))


@query(b.sql("""SELECT mpn, array_to_string(list_sort(list_distinct([lower(mpn), replace(lower(mpn),'-','')])),'|') AS search_keys,
  lower(cid)||'|'||replace(lower(mpn),'-','')||'|'||lower(mpn) AS aliases,
  ('0x'||substr(sha256(mpn),1,8))::BIGINT % 3 AS choice_a, (('0x'||substr(sha256(mpn),1,8))::BIGINT // 3) % 3 AS choice_b,
  strftime(DATE '2026-01-05','%Y%m%d')||'_'||category||'_'||size AS batch_id FROM parts_v""", "parts_v"))
def part_search_keys(spark, sf):
    p = b.parts(spark, sf)
    bid = keys.batch_id(F.lit("2026-01-05").cast("date"), "category", "size")
    return p.select(
        "mpn", F.array_join(keys.search_keys("mpn"), "|").alias("search_keys"),
        F.array_join(keys.part_aliases(F.col("cid"), keys.slug_alnum("mpn"), F.col("mpn")), "|").alias("aliases"),
        keys.hash_choice("mpn", 3).alias("choice_a"), keys.hash_choice("mpn", 3, 3).alias("choice_b"), bid.alias("batch_id"))


@query("""SELECT doc_id, regexp_matches(text,'[^\\x00-\\x7F±°]') AS illegal, regexp_matches(text,'[一-鿿]') AS cjk FROM documents""")
def illegal_text(spark, sf):
    d = b.read(spark, sf, "documents")
    return d.select("doc_id", text.has_illegal_text("text").alias("illegal"), text.has_cjk("text").alias("cjk"))


@query("""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(
   replace(replace(replace(replace(replace(replace(replace(replace(text,'℃','°C'),'µ','u'),'Ω','Ohm'),'×','x'),'√','sqrt'),'²','2'),'³','3'),'·','-'),
   '[^\\x00-\\x7F±°]',' ','g'),'\\s+',' ','g'))) AS normalised FROM documents""")
def text_normalised(spark, sf):
    return b.read(spark, sf, "documents").select("doc_id", F.sha2(text.normalize_text("text"), 256).alias("normalised"))


@query("""SELECT doc_id, sha256(replace(replace(replace(replace(replace(regexp_replace(text,'[\\x00-\\x1f\\x7f]','','g'),'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#x27;')) AS escaped,
  sha256(trim(regexp_replace(regexp_replace(lower(text),'[^a-z0-9 ]',' ','g'),'\\s+',' ','g'))) AS plain FROM documents""")
def text_escaped(spark, sf):
    return b.read(spark, sf, "documents").select(
        "doc_id", F.sha2(text.escape_html("text"), 256).alias("escaped"), F.sha2(text.plain_words("text"), 256).alias("plain"))


@query("""SELECT doc_id, regexp_matches(lower(text),'\\$\\s?\\d|\\bprice\\b|\\bpricing\\b|\\bcost\\b|\\bquote\\b|\\bin stock\\b|\\bstock level\\b|\\binventory\\b|\\bmoq\\b|\\bminimum order|\\bbuy\\b|\\bpurchase\\b|\\border online\\b|\\border now\\b|\\bplace an order\\b|\\badd to cart\\b|\\bcheckout\\b|\\bshipping\\b|\\bshipment\\b|\\bdeliver\\b|\\bdelivery\\b|\\blead[- ]?time\\b|\\baccount\\b|\\blogin\\b|\\bregister\\b|\\bsign[- ]?in\\b|\\blcsc\\b|our website|the website|\\bmarketplace\\b|\\breturn policy\\b|\\bwarranty claim\\b|\\bcustomer service\\b|\\btrack my order\\b') AS platform,
  regexp_matches(text,'(?i)lcsc|\\$\\s?\\d') AS offbrand FROM documents""")
def faq_screens(spark, sf):
    d = b.read(spark, sf, "documents")
    return d.select("doc_id", text.faq_platform("text", F.lit("")).alias("platform"), text.faq_offbrand("text").alias("offbrand"))


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text,'(?i)\\bthe\\b',0)) AS token FROM documents)
  SELECT doc_id AS key, 'text' AS field, 'the word' AS rule, lower(token) AS token, count(*) AS n FROM t GROUP BY 1,2,3,4
  UNION ALL SELECT doc_id, 'text', 'number', token, count(*) FROM (SELECT doc_id, unnest(regexp_extract_all(text,'[0-9]{3,}',0)) AS token FROM documents) GROUP BY 1,2,3,4""")
def token_hits(spark, sf):
    hits = gates.forbidden_tokens(b.read(spark, sf, "documents"), "doc_id", ["text"], [("the word", r"(?i)\bthe\b"), ("number", r"[0-9]{3,}")])
    return hits.groupBy("key", "field", "rule", F.lower("token").alias("token")).agg(F.count(F.lit(1)).alias("n"))


@query(b.sql("""WITH u AS (SELECT ord, quantity AS q, category, size FROM parts_v)
  SELECT ord, q AS quantity, CASE category WHEN 'ECONOMY' THEN 'single' WHEN 'STANDARD' THEN 'range' WHEN 'LARGE' THEN 'multi' WHEN 'MEDIUM' THEN 'single' WHEN 'PROMO' THEN 'single' ELSE 'single' END AS kind,
  CASE category WHEN 'ECONOMY' THEN round(size*0.001,9) WHEN 'MEDIUM' THEN 1.25 WHEN 'PROMO' THEN size WHEN 'SMALL' THEN size END AS num,
  CASE category WHEN 'STANDARD' THEN q WHEN 'LARGE' THEN q END AS txt,
  category='LARGE' AS multi, CASE category WHEN 'STANDARD' THEN 4 WHEN 'LARGE' THEN NULL WHEN 'MEDIUM' THEN 1.25 ELSE size END AS first_number FROM u""", "parts_v"))
def quantities(spark, sf):
    q = units.voltage("quantity")
    n = units.number("quantity")
    return b.parts(spark, sf).select(
        "ord", "quantity", q["kind"].alias("kind"), F.round(q["num"], 9).alias("num"), q["text"].alias("txt"),
        units.is_multi_value("quantity").alias("multi"), n["num"].alias("first_number"))


@query(b.sql("""SELECT ord, CASE WHEN size>=1000 THEN '' ELSE size||' V' END AS volts, CASE WHEN price>=1000 THEN regexp_replace(regexp_replace(printf('%.3f',price/1000),'0+$',''),'\\.$','')||'kΩ' ELSE regexp_replace(regexp_replace(printf('%.3f',price),'0+$',''),'\\.$','')||'Ω' END AS ohms,
  size||' KB' AS bytes, size||' MHz' AS hertz, size||' mA' AS amps, size||' bit' AS bits FROM parts_v""", "parts_v"))
def display_values(spark, sf):
    p = b.parts(spark, sf)
    s = F.col("size")
    return p.select(
        "ord", units.format_value(F.lit("vdss_v"), s.cast("string")).alias("volts"), units.format_value(F.lit("resistance_ohm"), F.col("price").cast("string")).alias("ohms"),
        units.format_value(F.lit("flash_bytes"), (s * 1024).cast("string")).alias("bytes"), units.format_value(F.lit("frequency_hz"), (s * 1000000).cast("string")).alias("hertz"),
        units.format_value(F.lit("id_a"), (s / 1000).cast("string")).alias("amps"), units.format_value(F.lit("core_bits"), s.cast("string")).alias("bits"))


def attribute_json():
    """Attributes of a part as JSON text; one category writes text that is not JSON, one an array."""
    return (
        F.when(F.col("category") == "SMALL", F.lit("{broken"))
        .when(F.col("category") == "PROMO", F.lit('["a","b"]'))
        .otherwise(F.to_json(F.struct(F.col("quantity").alias("output_voltage_v"), F.col("size").alias("channels"), F.lit("").alias("package"),
                                      F.when(F.col("size") > 25, F.col("price")).alias("legacy_speed")))))


_ATTRS = """attrs AS (SELECT *, CASE category WHEN 'SMALL' THEN NULL WHEN 'PROMO' THEN NULL ELSE 1 END AS good FROM parts_v)"""


@query(b.sql(f"""WITH {_ATTRS} SELECT ord, CASE WHEN good IS NULL THEN 0 WHEN size>25 THEN 3 ELSE 2 END AS specs, good IS NULL AS thin,
  CASE WHEN good IS NULL OR size<=25 THEN '' ELSE 'legacy_speed' END AS unknown FROM attrs""", "parts_v"))
def spec_count(spark, sf):
    p = b.parts(spark, sf).withColumn("attributes_json", attribute_json())
    return p.select("ord", attrs.spec_count("attributes_json").alias("specs"), attrs.is_spec_thin("attributes_json").alias("thin"),
                    F.array_join(attrs.unknown_attr_keys("attributes_json", ["output_voltage_v", "channels", "package"]), ",").alias("unknown"))


@query(b.sql(f"""WITH {_ATTRS} SELECT 'output_voltage_v' AS key, count(*) AS rows FROM attrs WHERE good=1 UNION ALL SELECT 'channels', count(*) FROM attrs WHERE good=1
  UNION ALL SELECT 'package', count(*) FROM attrs WHERE good=1 UNION ALL SELECT 'legacy_speed', count(*) FROM attrs WHERE good=1 AND size>25""", "parts_v"))
def attribute_coverage(spark, sf):
    return aggregates.key_coverage(b.parts(spark, sf).withColumn("attributes_json", attribute_json()))


def _params():
    """Parameter list of a part the way a supplier sends it, with a parameter that comes twice."""
    p = lambda name, en, value, main, sort: F.struct(
        F.lit(name).alias("paramName"), F.lit(en).alias("paramNameEn"), F.lit("").alias("paramValue"), value.alias("paramValueEn"),
        F.lit(main).alias("isMain"), F.lit(sort).alias("sort"))
    size = F.col("size").cast("string")
    return F.array(
        p("输出电压", "", F.col("quantity"), True, 3), p("通道数", "Number of Channels", size, True, 1),
        p("x", "Number of Outputs", F.concat(size, F.lit("0")), False, 2), p("x", "Output Current", F.concat(size, F.lit("mA")), False, 2),
        p("x", "Tolerance", F.lit("±10%"), False, 9), p("x", "Series", F.lit("XC"), False, 9))


@query(b.sql("""SELECT ord, size*10 AS channels, round(size*0.001,9) AS amps, CASE category WHEN 'ECONOMY' THEN 'n' WHEN 'PROMO' THEN 'n' WHEN 'SMALL' THEN 'n' ELSE quantity END AS volts,
  'channels' AS collisions, '±10%' AS tolerance, false AS has_series, 'Number of Channels: '||size AS key_attributes FROM parts_v""", "parts_v"))
def parameters_to_attributes(spark, sf):
    p = b.parts(spark, sf).withColumn("params", _params())
    e = p.withColumn("entries", attrs.parameter_entries("params")).withColumn("canon", attrs.canonical_attributes("entries"))
    e = e.withColumn("all", attrs.forward_unmapped("canon", attrs.unmapped_attributes("entries")))
    v = lambda k, t: F.try_variant_get(F.col("all")[k], "$", t)
    is_text = F.schema_of_variant(F.col("all")["output_voltage_v"]) == "STRING"
    return e.select(
        "ord", v("channels", "long").alias("channels"), F.round(v("output_current_a", "double"), 9).alias("amps"),
        F.when(is_text, v("output_voltage_v", "string")).otherwise("n").alias("volts"), F.array_join(attrs.collisions("entries"), ",").alias("collisions"),
        v("Tolerance", "string").alias("tolerance"), F.map_contains_key("all", F.lit("Series")).alias("has_series"),
        attrs.key_attributes("params").alias("key_attributes"))


_FAMILY_SQL = """CASE parent_catalog WHEN 'Capacitors' THEN 'Capacitor' WHEN 'Inductors, Coils, Chokes' THEN 'Inductor' WHEN 'Resistors' THEN 'Resistor'
  WHEN 'Power Management (PMIC)' THEN 'Voltage Regulator' WHEN 'Embedded Processors & Controllers' THEN 'Microcontroller' WHEN 'Transistors/Thyristors' THEN 'MOSFET' ELSE 'Diode' END"""
_L1_SQL = """CASE WHEN catalog_name='TVS Diodes' THEN 'circuit-protection' ELSE CASE parent_catalog WHEN 'Capacitors' THEN 'capacitors' WHEN 'Inductors, Coils, Chokes' THEN 'inductors-coils-transformers'
  WHEN 'Resistors' THEN 'resistors' WHEN 'Power Management (PMIC)' THEN 'power-management' WHEN 'Embedded Processors & Controllers' THEN 'microcontrollers'
  WHEN 'Transistors/Thyristors' THEN 'transistors' WHEN 'Diodes' THEN 'diodes' END END"""


@query(b.sql(f"""SELECT ord, {_FAMILY_SQL} AS family, 'L1_catalogName' AS level, {_L1_SQL} AS l1, ({_FAMILY_SQL})='Diode' AND catalog_name='TVS Diodes' AS conflict FROM parts_v""", "parts_v"))
def family_detected(spark, sf):
    f = classify.detect_family("parent_catalog", "catalog_name", "category", "description", "attributes_json")
    p = b.parts(spark, sf).withColumn("attributes_json", F.lit("{}")).withColumn("f", f).withColumn("l1", classify.native_l1("parent_catalog", "catalog_name"))
    return p.select("ord", "f.family", "f.level", "l1", classify.family_conflict("f.family", "l1").alias("conflict"))


@query(b.sql(f"""SELECT {_L1_SQL} AS native_l1, count(*) AS n FROM parts_v GROUP BY 1""", "parts_v"))
def native_l1(spark, sf):
    return b.parts(spark, sf).groupBy(classify.native_l1("parent_catalog", "catalog_name").alias("native_l1")).agg(F.count(F.lit(1)).alias("n"))


# a small double as JSON has it
_SMALL = r"regexp_replace(regexp_replace(CAST({} AS VARCHAR), '^(\d+)e', '\1.0e'), 'e-0?', 'E-')"


@query(b.sql(f"""SELECT ord, family, CASE family WHEN 'Diode' THEN '{{"vf_v":0.55}}' WHEN 'MOSFET' THEN '{{"vdss_v":'||size||'}}' WHEN 'Inductor' THEN '{{"inductance_h":'||{_SMALL.format('size*1e-6')}||'}}' WHEN 'Capacitor' THEN '{{"capacitance":'||{_SMALL.format('round(size*1e-9,12)')}||'}}'
   WHEN 'Resistor' THEN '{{"resistance_ohm":'||size*1000||'}}' WHEN 'Microcontroller' THEN '{{"core":"ARM Cortex-M3","frequency_hz":'||size*1000000||'}}'
   ELSE '{{"output_voltage_v":'||CASE category WHEN 'ECONOMY' THEN CAST(size/1000.0 AS VARCHAR) WHEN 'MEDIUM' THEN '1.25' WHEN 'LARGE' THEN '"'||quantity||'"' WHEN 'STANDARD' THEN '"'||quantity||'"' ELSE CAST(size AS VARCHAR) END||'}}' END AS attributes
  FROM (SELECT *, {_FAMILY_SQL} AS family FROM parts_v)""", "parts_v"))
def family_projection(spark, sf):
    """Family attributes from source-language parameters, one parameter of each family."""
    j = F.to_json(F.create_map(
        F.lit("输出电压"), F.col("quantity"), F.lit("容值"), F.concat(F.col("size").cast("string"), F.lit("nF")), F.lit("阻值"), F.concat(F.col("size").cast("string"), F.lit("kΩ")),
        F.lit("漏源电压(Vdss)"), F.concat(F.col("size").cast("string"), F.lit("V")), F.lit("正向压降(Vf)"), F.lit("550mV"), F.lit("电感值"), F.concat(F.col("size").cast("string"), F.lit("µH")),
        F.lit("CPU内核"), F.lit("ARM Cortex-M3"), F.lit("CPU最大主频"), F.concat(F.col("size").cast("string"), F.lit("MHz"))))
    p = b.parts(spark, sf).withColumn("j", j).withColumn("family", classify.detect_family("parent_catalog", "catalog_name", "category", "description", "j")["family"])
    return p.select("ord", "family", F.to_json(classify.project_source("family", "j", "description", "mpn")).alias("attributes"))


@query("""SELECT p_type AS key, CASE WHEN p_size<=10 THEN 'tiny' WHEN p_size<=30 THEN 'middle' ELSE 'big' END AS value, count(*) AS votes FROM part GROUP BY 1,2
  QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, length(value), value)=1""")
def majority_translation(spark, sf):
    p = b.read(spark, sf, "part").select(F.col("p_type").alias("key"), F.when(F.col("p_size") <= 10, "tiny").when(F.col("p_size") <= 30, "middle").otherwise("big").alias("value"))
    return merge.majority_translation(p)


@query(b.sql(f"""SELECT l1 AS l1, cat, sku, CASE WHEN sku>=5 THEN 'DIRECT' WHEN sku>=2 THEN 'MERGE' ELSE 'EXCLUDE' END AS cls, trim(regexp_replace(lower(cat),'[^a-z0-9]+','-','g'),'-') AS slug, sku AS page_sku
  FROM (SELECT {_L1_SQL} AS l1, catalog_name AS cat, count(*) AS sku FROM parts_v GROUP BY 1,2)""", "parts_v"))
def fine_units(spark, sf):
    u, _ = aggregates.fine_units(_classified(spark, sf))
    return u.select("l1", "cat", "sku", "cls", "slug", "page_sku")


# Every class, action and kind of target: units of one row, of two to four and of more, names under several level-1
# slugs, targets in the same level-1 slug, in another and nowhere, and slugs that collide plain and combined.
_MIXED_SQL = """mixed AS (SELECT p_partkey AS k, 'C'||p_partkey AS sr, upper(replace(p_name,' ','-'))||'-'||p_partkey AS mpn, CASE WHEN p_partkey=1 THEN 'a' WHEN p_partkey<=4 THEN 'circuit-protection' WHEN p_partkey<=7 THEN 'sensors'
   WHEN p_partkey<=9 THEN 'relays' ELSE ['circuit-protection','interface-ics','a','b','a','b','logic-ics','memory'][p_size%8+1] END AS l1,
  CASE WHEN p_partkey=1 THEN 'Lonely' WHEN p_partkey<=4 THEN 'Fuseholders' WHEN p_partkey<=7 THEN 'Distance Measuring' WHEN p_partkey<=9 THEN 'Signal Relays, Up to 2 Amps'
   ELSE ['PTC Resettable Fuses','Analog and Digital Output','X','X','X b','X b','Analog Switches, Multiplexers, Demultiplexers',''][p_size%8+1] END AS cat FROM part),
 u AS (SELECT l1, cat, count(*) AS sku, CASE WHEN cat IN ('X','X b') THEN 'REVIEW' WHEN count(*)>=5 THEN 'DIRECT' WHEN count(*)>=2 THEN 'MERGE' ELSE 'EXCLUDE' END AS cls,
   CASE cat WHEN 'Fuseholders' THEN 'PTC Resettable Fuses' WHEN 'Distance Measuring' THEN 'Analog and Digital Output' WHEN 'Analog Switches, Multiplexers, Demultiplexers' THEN 'Signal Switches, Multiplexers, Decoders' END AS target,
   CASE WHEN l1='b' AND cat='X' THEN 'x-4' WHEN l1='b' AND cat='X b' THEN 'x-b-b' ELSE trim(regexp_replace(lower(cat),'[^a-z0-9]+','-','g'),'-') END AS slug FROM mixed WHERE cat<>'' GROUP BY 1,2)"""


def _mixed(spark, sf):
    k, turn = F.col("p_partkey"), F.col("p_size") % 8
    pick = lambda first, rest: (F.when(k == 1, first[0]).when(k <= 4, first[1]).when(k <= 7, first[2]).when(k <= 9, first[3])
                                .otherwise(F.element_at(F.array(*map(F.lit, rest)), turn.cast("int") + 1)))
    rows = b.read(spark, sf, "part").select(
        F.concat(F.lit("C"), k.cast("string")).alias("sr"), F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit("-"), k.cast("string")).alias("mpn"),
        pick(("a", "circuit-protection", "sensors", "relays"), ("circuit-protection", "interface-ics", "a", "b", "a", "b", "logic-ics", "memory")).alias("native_l1"),
        pick(("Lonely", "Fuseholders", "Distance Measuring", "Signal Relays, Up to 2 Amps"),
             ("PTC Resettable Fuses", "Analog and Digital Output", "X", "X", "X b", "X b", "Analog Switches, Multiplexers, Demultiplexers", "")).alias("category"),
        F.lit("p").alias("parent"), k.alias("ord"))
    # an earlier row of each code, which does not count
    return rows.unionByName(rows.withColumns({"ord": F.col("ord") - 10**9, "category": F.lit("Old"), "native_l1": F.lit("old")}))


@query(f"""WITH {_MIXED_SQL} SELECT l1, cat, cls, CASE WHEN target IS NULL THEN 'BUILD' ELSE 'MERGE' END AS action, target, slug, sku,
  sku + CASE cat WHEN 'PTC Resettable Fuses' THEN (SELECT sku FROM u WHERE cat='Fuseholders') WHEN 'Analog and Digital Output' THEN (SELECT sku FROM u WHERE cat='Distance Measuring') ELSE 0 END AS page_sku FROM u""")
def fine_units_mixed(spark, sf):
    u, _ = aggregates.fine_units(_mixed(spark, sf))
    return u.select("l1", "cat", "cls", "action", "target", "slug", "sku", "page_sku")


@query(f"""WITH {_MIXED_SQL} SELECT mpn, coalesce(u.target, u.cat) AS final_subcategory, CASE WHEN u.target IS NULL THEN u.slug ELSE t.slug END AS final_slug, coalesce(t.l1, u.l1) AS final_native_l1
  FROM mixed m JOIN u ON u.l1=m.l1 AND u.cat=m.cat LEFT JOIN u t ON t.cat=u.target""")
def final_map_mixed(spark, sf):
    rows = _mixed(spark, sf)
    return aggregates.final_map(rows, aggregates.fine_units(rows)[1])


def _classified(spark, sf):
    return b.parts(spark, sf).select(
        F.col("cid").alias("sr"), "mpn", classify.native_l1("parent_catalog", "catalog_name").alias("native_l1"),
        F.col("catalog_name").alias("category"), F.col("parent_catalog").alias("parent"), "ord")


@query(b.sql(f"""SELECT mpn, cat AS final_subcategory, l1 AS final_native_l1, trim(regexp_replace(lower(cat),'[^a-z0-9]+','-','g'),'-') AS final_slug
  FROM (SELECT mpn, catalog_name AS cat, {_L1_SQL} AS l1, row_number() OVER (PARTITION BY mpn ORDER BY ord DESC) AS rn FROM parts_v) WHERE rn=1""", "parts_v"))
def final_map(spark, sf):
    p = _classified(spark, sf)
    _, mapping = aggregates.fine_units(p)
    return aggregates.final_map(p, mapping)


@query("""SELECT page_id, array_to_string(regexp_extract_all(html,'href="([^"]*)"',1),' ') AS hrefs, trim(regexp_replace(regexp_extract(html,'(?is)<title[^>]*>(.*?)</title>',1),'\\s+',' ','g')) AS title,
  trim(regexp_replace(regexp_replace(regexp_extract(html,'(?is)<h1[^>]*>(.*?)</h1>',1),'<[^>]+>',' ','g'),'\\s+',' ','g')) AS h1 FROM pages""")
def page_fields(spark, sf):
    p = b.read(spark, sf, "pages")
    return p.select("page_id", F.array_join(markup.hrefs("html"), " ").alias("hrefs"), markup.title("html").alias("title"), markup.first_heading("html").alias("h1"))


@query("""SELECT page_id, sha256(regexp_replace(regexp_replace(html,'(?s)//[^\\n]*|/\\*.*?\\*/|<!--.*?-->','','g'),'(?i)data-zh[a-z-]*\\s*=\\s*(?:"[^"]*"|''[^'']*'')','','g')) AS masked,
  len(regexp_extract_all(html,'(?s)<li[^>]*>(.*?)</li>',1)) AS items FROM pages""")
def page_masked(spark, sf):
    p = b.read(spark, sf, "pages")
    return p.select("page_id", F.sha2(markup.mask_for_scan("html"), 256).alias("masked"),
                    F.size(F.regexp_extract_all("html", F.lit("(?s)<li[^>]*>(.*?)</li>"), F.lit(1))).alias("items"))


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html,'href="([^"]*)"',1)) AS href FROM pages),
  t AS (SELECT DISTINCT '/'||split_part(title,' ',1) AS p FROM (SELECT regexp_extract(html,'(?is)<title[^>]*>(.*?)</title>',1) AS title FROM pages))
  SELECT page_id, href, CASE WHEN href='' OR href NOT LIKE '/%' OR href LIKE '//%' THEN 'skip' WHEN regexp_replace(regexp_replace(trim(href),'[?#].*$',''),'/+$','') IN (SELECT p FROM t) THEN 'ok' ELSE 'dead' END AS link_status, count(*) AS n
  FROM l GROUP BY 1,2,3""")
def dead_links(spark, sf):
    """Links against a page set named after the first title words."""
    p = b.read(spark, sf, "pages")
    links = p.select("page_id", F.explode(markup.hrefs("html")).alias("href"))
    known = p.select(F.concat(F.lit("/"), F.substring_index(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), " ", 1)).alias("path"))
    return gates.dead_links(links, known).groupBy("page_id", "href", "link_status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) AS pages, count(*) FILTER (WHERE contains(html,'application/ld+json')) AS with_json_ld, 0 AS with_product, 0 AS parse_errors, 0 AS with_cjk FROM pages""")
def schema_coverage(spark, sf):
    return aggregates.schema_coverage(b.read(spark, sf, "pages"))
