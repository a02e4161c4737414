"""Queries over the extension points: table functions in SQL, and a family that a caller adds."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow import sql
from catalogflow.functions import classify
from catalogflow.functions.families import Attribute, Family, registered
from catalogflow.queries.functions import _FAMILY_SQL
from catalogflow.queries.registry import query


@query("""SELECT user_id AS key, event_type AS kind, count(*) AS length, min(event_id) AS from_at, max(event_id) AS to_at FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS g FROM events) WHERE event_type IN ('error','view')
  GROUP BY user_id, event_type, g HAVING count(*)>=2""")
def error_streaks_sql(spark, sf):
    sql.register(spark)
    log = b.read(spark, sf, "events").selectExpr("user_id AS key", "event_id AS at", "event_type AS kind")
    return spark.sql("SELECT * FROM error_streaks(TABLE({log}) PARTITION BY key ORDER BY (at), 'error,view', 2)", log=log)


@query("""SELECT conv_id AS key, turn AS id, CASE WHEN turn%4=0 THEN 1 WHEN turn%2=0 THEN 2 ELSE 3 END AS level, turn-turn%4 AS l1_id, CASE WHEN turn%4>=2 THEN turn-turn%2 END AS l2_id FROM conversations""")
def carry_parent_sql(spark, sf):
    """Turns of conversations: every fourth is a level-1 node, the even ones between are level 2."""
    sql.register(spark)
    nodes = b.read(spark, sf, "conversations").select(F.col("conv_id").alias("key"), F.col("turn").alias("id"), F.when(F.col("turn") % 4 == 0, 1).when(F.col("turn") % 2 == 0, 2).otherwise(3).alias("level"))
    return spark.sql("SELECT * FROM carry_parent(TABLE({nodes}) PARTITION BY key ORDER BY id)", nodes=nodes)


PROTECTOR = Family("Protector", "circuit-protection", parents=("circuit protection",), attributes=(Attribute("clamp_v", "voltage", "1", ("保护电压", "备用电压")), Attribute("polarity", "enum", "", ("保护方向",))))


@query(b.sql(f"""SELECT ord, CASE WHEN parent_catalog='Circuit Protection' THEN 'Protector' ELSE {_FAMILY_SQL} END AS family, false AS conflict,
  CASE WHEN parent_catalog='Circuit Protection' THEN '{{"clamp_v":'||(size+0.3)||CASE WHEN size%2=0 THEN ',"polarity":"Dual"' ELSE '' END||'}}' ELSE '{{}}' END AS attributes FROM parts_v""", "parts_v"))
def family_added(spark, sf):
    """Parts of one parent catalog belong to a family that the rule tables do not have."""
    n = F.col("size").cast("string")
    text = F.when(F.col("size") % 2 == 0, F.concat(F.lit('{"备用电压":"'), n, F.lit('.26V","保护方向":"双"}'))).otherwise(F.concat(F.lit('{"保护电压":"'), n, F.lit('.34V","备用电压":"1V"}')))
    p = b.parts(spark, sf).withColumn("j", text)
    with registered(PROTECTOR):
        family = classify.detect_family("parent_catalog", "catalog_name", "category", "description", F.lit("{}"))["family"]
        p = p.withColumn("family", family).withColumn("l1", classify.native_l1("parent_catalog", "catalog_name"))
        conflict = classify.family_conflict("family", F.when(F.col("family") == "Protector", F.lit("circuit-protection")).otherwise(F.col("l1")))
        return p.select("ord", "family", conflict.alias("conflict"), F.to_json(classify.project_source("family", "j", "description", "mpn")).alias("attributes"))
