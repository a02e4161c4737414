"""Queries over the release gates with source records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.operators import gates
from catalogflow.plans import release
from catalogflow.queries.registry import query

def _param(name, value):
    return F.struct(F.lit("").alias("paramName"), F.lit(name).alias("paramNameEn"), F.lit("").alias("paramValue"), value.alias("paramValueEn"), F.lit(True).alias("isMain"), F.lit(1).alias("sort"))


def _checked_parts(spark, sf):
    """Six kinds of parts by their key: a range and a list stored as one number, a lost condition, lost values, nothing wrong, two names of one key."""
    k = (F.col("ord") % 6).cast("int")
    at = lambda *xs: F.array(*[F.lit(x) for x in xs])[k]
    volts = at("3V~5V", "3V;5V", "5V@1A", "5V", "5V", "5V")
    good = '{"output_voltage_v":5,"output_current_a":1,"channels":2}'
    stored = at('{"output_voltage_v":3,"output_current_a":1}', '{"output_voltage_v":3,"output_current_a":1}', '{"output_voltage_v":"5V","output_current_a":1}', "{}", good, good)
    base = F.array(_param("Output Voltage", volts), _param("Output Current", F.lit("1A")))
    two = F.when(k == 5, F.array(_param("Number of Channels", F.lit("1")), _param("Number of Outputs", F.lit("2")))).otherwise(F.array().cast("array<struct<paramName:string,paramNameEn:string,paramValue:string,paramValueEn:string,isMain:boolean,sort:int>>"))
    n = F.col("ord").cast("string")
    link = F.when(F.col("ord") % 3 == 0, "").when(F.col("ord") % 3 == 1, F.concat(F.lit("https://files.r2.dev/"), n, F.lit(".pdf"))).otherwise(F.concat(F.lit("https://datasheet.lcsc.com/"), n, F.lit(".pdf")))
    return b.parts(spark, sf).select(
        F.col("cid").alias("supplier_reference"), F.concat(F.lit("M"), n).alias("mpn"), F.when(F.col("ord") % 7 == 0, "").otherwise(F.col("manufacturer")).alias("manufacturer"), link.alias("datasheet_url"),
        F.concat(base, two).alias("params"), stored.alias("attributes_json"), "ord")


@query(b.sql("""WITH p AS (SELECT ord, 'M'||ord AS mpn, ord%6 AS k FROM parts_v)
  SELECT mpn, 'FAIL' AS level, CASE k WHEN 0 THEN 'RANGE' WHEN 1 THEN 'MULTIVALUE' ELSE 'CONDITION' END AS kind, 'Output Voltage' AS message FROM p WHERE k<3
  UNION ALL SELECT mpn, 'FAIL', 'COMPLETENESS', unnest(['Output Voltage','Output Current']) FROM p WHERE k=3 UNION ALL SELECT mpn, 'FAIL', 'COLLISION', 'channels' FROM p WHERE k=5
  UNION ALL SELECT mpn, 'FAIL', 'IDENTITY', 'part number has several manufacturers in MASTER' FROM p WHERE ord%10=0 UNION ALL SELECT mpn, 'WARN', 'IDENTITY', 'part number has several codes in the source' FROM p WHERE ord%15=0
  UNION ALL SELECT mpn, 'FAIL', 'CHAIN', 'manufacturer empty' FROM p WHERE ord%2=1 AND ord%7=0 UNION ALL SELECT mpn, 'WARN', 'CHAIN', 'no published document' FROM p WHERE ord%2=1 AND ord%3=0
  UNION ALL SELECT mpn, 'FAIL', 'CHAIN', 'document host not shippable' FROM p WHERE ord%2=1 AND ord%3=2""", "parts_v"))
def spec_integrity_findings(spark, sf):
    """Every finding of the job; half of the parts are in MASTER, some part numbers there have two makers, some have two codes in the source."""
    p = _checked_parts(spark, sf)
    master = p.where("ord % 2 = 0").select("supplier_reference", "mpn", "manufacturer").unionByName(p.where("ord % 10 = 0").select(F.concat("supplier_reference", F.lit("x")).alias("supplier_reference"), "mpn", F.lit("Another").alias("manufacturer")))
    raw = p.select("mpn", F.col("supplier_reference").alias("code")).unionByName(p.where("ord % 15 = 0").select("mpn", F.concat("supplier_reference", F.lit("y")).alias("code")))
    return release.spec_integrity(p, master, raw).select("mpn", "level", "kind", F.regexp_replace("message", r": .*$", "").alias("message"))


# ---- release plan with source records (B4) --------------------------------------------------

@query(b.sql("""WITH p AS (SELECT ord, ord%5 AS k, 'M'||ord AS mpn FROM parts_v)
  SELECT 'clone_key' AS gate, 'STOP' AS level, 'CLONE_PART_MPN_KEY_FAIL' AS kind, mpn FROM p WHERE ord%11=0 AND k<>4 UNION ALL SELECT 'faq', 'STOP', 'FAQ_FABRICATED_FAIL', mpn FROM p WHERE ord%10=6
  UNION ALL SELECT 'faq', 'WARN', 'FAQ_CURATED_VERIFIED', mpn FROM p WHERE ord%10=1 UNION ALL SELECT 'alternates', 'STOP', 'ALT_PARTS_ASIS_FAIL', mpn FROM p WHERE k=3 UNION ALL SELECT 'alternates', 'WARN', 'ALT_PARTS_ASIS_WARN', mpn FROM p WHERE k=4""", "parts_v"))
def release_plan_findings(spark, sf):
    """B4 with source records: questions that the record has, that a person verified, and made-up ones; alternates that agree, differ, and have no record; clones
    whose document is named after the part number."""
    p = _checked_parts(spark, sf)
    k, code = F.col("ord") % 5, F.lower("supplier_reference")
    named = F.when(F.col("ord") % 11 == 0, F.lower("mpn")).otherwise(code)
    rows = gates.project_master(p.select(
        "mpn", F.lit("Maker").alias("manufacturer"), F.lit("Maker").alias("brand"), F.lit("text").alias("description"), "supplier_reference", F.lit('{"a":1,"b":2}').alias("attributes_json"), F.lit("l1").alias("native_l1"), "ord",
        F.concat(F.lit("https://files.r2.dev/"), named, F.lit(".pdf")).alias("datasheet_url"), F.when(k < 2, "Q: Why?A: So").otherwise("").alias("faq"), F.when(k == 2, "A1; B2").when(k == 3, "A1; ZZ").otherwise("").alias("alternative_parts")), keep=("ord",))
    question = F.array(F.struct(F.lit("Why?").alias("question"), F.lit("So").alias("answer")))
    other = lambda m: F.struct(F.lit(m).alias("productModel"), F.lit("B").alias("brandNameEn"), F.lit("C1").alias("productCode"), F.lit("").alias("type"), F.lit("").alias("encapStandard"))
    raw = p.where(k != 4).select(F.col("supplier_reference").alias("code"), "mpn", F.lit("Maker").alias("manufacturer"), F.when(k == 0, question).alias("faqs"), F.when(k >= 2, F.array(other("A1"), other("B2"))).alias("alternates"), "ord")
    twins = raw.where("ord % 11 = 0").withColumns({"code": F.concat("code", F.lit("t")), "manufacturer": F.lit("Twin")})
    master = rows.limit(0)
    plan = release.plan_release(master, rows.withColumn("spec_keys", F.lit(2)), raw.unionByName(twins), verified_faq=p.where("ord % 10 = 1").select(F.lower("mpn").alias("mpn")))
    return plan.findings.select("gate", "level", "kind", "mpn")
