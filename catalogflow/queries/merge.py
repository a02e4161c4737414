"""Brand, merge, order and slug queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.operators import merge, ordering
from catalogflow.queries.registry import query


@query(b.sql(
    """, """.strip(", ") + """
    SELECT o.brand, o.mpn, o.offers, o.category, o.description, o.availability, o.sources FROM (
      SELECT coalesce(a.canonical, trim(v.manufacturer)) AS brand, min(v.mpn) AS mpn, count(*) AS offers,
        arg_min(v.category, v.ord) AS category,
        arg_min(v.description, v.ord) FILTER (WHERE v.description<>'') AS description,
        arg_min(v.availability, v.ord) FILTER (WHERE v.availability<>'') AS availability,
        any_value(s.sources) AS sources
      FROM offers_v v LEFT JOIN alias_v a ON lower(trim(v.manufacturer))=a.raw
      JOIN (SELECT brand, mpn, string_agg(source, '|' ORDER BY o) AS sources FROM (
             SELECT coalesce(a2.canonical, trim(v2.manufacturer)) AS brand, v2.mpn, v2.source, min(v2.ord) AS o
             FROM offers_v v2 LEFT JOIN alias_v a2 ON lower(trim(v2.manufacturer))=a2.raw GROUP BY 1,2,3) GROUP BY 1,2) s
        ON s.brand=coalesce(a.canonical, trim(v.manufacturer)) AND s.mpn=v.mpn
      GROUP BY coalesce(a.canonical, trim(v.manufacturer)), v.mpn) o""",
    "offers_v", "alias_v"))
def merged_offers(spark, sf):
    m = merge.merge_offers(b.offers(spark, sf), b.aliases(spark, sf))
    return m.groups.select(
        "brand", "mpn", "offers", "category", "description", "availability",
        F.array_join("sources", "|").alias("sources"),
    )


@query(b.sql(
    """SELECT count(*) AS rows_kept, sum(CASE WHEN trim(manufacturer)='' THEN 1 ELSE 0 END) AS brand_missing,
     sum(CASE WHEN trim(manufacturer)<>'' AND a.raw IS NULL THEN 1 ELSE 0 END) AS brand_unmatched,
     count(DISTINCT (coalesce(a.canonical, trim(manufacturer)), mpn)) AS groups_out,
     count(*) - count(DISTINCT (coalesce(a.canonical, trim(manufacturer)), mpn)) AS merged_dups
     FROM offers_v v LEFT JOIN alias_v a ON lower(trim(v.manufacturer))=a.raw""", "offers_v", "alias_v"))
def merge_stats(spark, sf):
    return merge.merge_offers(b.offers(spark, sf), b.aliases(spark, sf)).stats


@query(b.sql(
    """SELECT v.manufacturer, coalesce(a.canonical, trim(v.manufacturer)) AS brand_canonical, a.raw IS NOT NULL AS brand_matched, count(*) AS n
     FROM offers_v v LEFT JOIN alias_v a ON lower(trim(v.manufacturer))=a.raw GROUP BY 1,2,3""", "offers_v", "alias_v"))
def brand_canonical(spark, sf):
    out = merge.canonicalize_brand(b.offers(spark, sf), b.aliases(spark, sf))
    return out.groupBy("manufacturer", "brand_canonical", "brand_matched").agg(F.count(F.lit(1)).alias("n"))


@query(b.sql("SELECT ord, mpn, manufacturer, cid FROM parts_v QUALIFY row_number() OVER (PARTITION BY mpn, manufacturer ORDER BY ord)=1", "parts_v"))
def first_occurrence(spark, sf):
    return ordering.first_occurrence(b.parts(spark, sf), ["mpn", "manufacturer"]).select("ord", "mpn", "manufacturer", "cid")


@query(b.sql("SELECT ord, mpn, manufacturer, cid FROM parts_v QUALIFY row_number() OVER (PARTITION BY mpn ORDER BY ord DESC)=1", "parts_v"))
def last_occurrence(spark, sf):
    return ordering.last_occurrence(b.parts(spark, sf), ["mpn"]).select("ord", "mpn", "manufacturer", "cid")


@query(b.sql("SELECT (row_number() OVER (ORDER BY ord)-1)//500+1 AS slice_idx, mpn, cid, 'wave_'||lpad(CAST((row_number() OVER (ORDER BY ord)-1)//500+1 AS VARCHAR),4,'0') AS slice_id FROM parts_v", "parts_v"))
def slices(spark, sf):
    return ordering.plan_slices(b.parts(spark, sf)).select("slice_idx", "slice_id", "mpn", "cid")
