"""Round trips: given tables written by the sinks and read back by the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow import schemas
from catalogflow.operators.ordering import plan_slices
from catalogflow.queries.registry import query
from catalogflow.session import shared_dir
from catalogflow.sinks import files as sinks
from catalogflow.sources import files as sources


def _fresh_dir(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _master(spark, sf):
    p = b.parts(spark, sf)
    given = {
        "mpn": F.concat_ws("-", "mpn", F.col("ord").cast("string")), "manufacturer": F.col("manufacturer"), "description": F.concat(F.col("description"), F.lit(', "x"\nline two')),
        "supplier_reference": F.col("cid"), "lcsc_depth": F.when(F.col("size") > 25, F.col("size").cast("string")).otherwise("n/a"), "keywords": F.when(F.col("size") % 2 == 0, "k"),
    }
    return p.select(*[given.get(c, F.lit("")).cast("string").alias(c) for c in schemas.MASTER_COLUMNS])


_MASTER_SQL = """SELECT mpn||'-'||ord AS mpn, manufacturer, description||', "x"'||chr(10)||'line two' AS description, cid AS supplier_reference, CASE WHEN size>25 THEN size END AS lcsc_depth FROM parts_v"""


@query(b.sql(_MASTER_SQL, "parts_v"))
def master_round_trip(spark, sf):
    """S1, D1 over a CSV with quotes and line breaks."""
    path = _fresh_dir(spark, "master")
    _master(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    df = sources.typed_master(sources.read_master(spark, path))
    return df.select("mpn", "manufacturer", "description", "supplier_reference", "lcsc_depth")


@query(b.sql("SELECT mpn||'-'||ord AS mpn FROM parts_v WHERE size>10", "parts_v"))
def keys_scanned(spark, sf):
    """Keys with blanks around them, blank ones dropped."""
    keys = b.parts(spark, sf).select(F.when(F.col("size") > 10, F.concat(F.lit(" "), F.col("mpn"), F.lit("-"), F.col("ord").cast("string"), F.lit(" "))).otherwise(" ").alias("mpn"))
    return sources.scan_keys(keys)


@query("""SELECT event_id, event_type, false AS damaged FROM events WHERE event_id%7<>0 UNION ALL SELECT event_id, NULL, true FROM events WHERE event_id%7=0""")
def events_jsonl(spark, sf):
    """S3 and K8s: a log with damaged lines, which are told apart and not lost."""
    path = _fresh_dir(spark, "log")
    e = b.read(spark, sf, "events")
    whole = F.to_json(F.struct("event_id", "event_type"))
    e.select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))).otherwise(whole).alias("value")).write.text(path)
    good, bad = sources.read_jsonl_tolerant(spark, path, schemas.strings("event_id", "event_type"))
    cut = bad.select(F.regexp_extract("damaged", r"(\d+)$", 1).alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit(True).alias("damaged"))
    return good.withColumn("damaged", F.lit(False)).unionByName(cut).withColumn("event_id", F.col("event_id").cast("long"))


@query("SELECT lower(p_brand) AS raw, arg_max(upper(p_type), p_partkey) AS canonical FROM part GROUP BY 1")
def alias_map_read(spark, sf):
    """The last row of a name wins; rows with a blank side are skipped."""
    path = _fresh_dir(spark, "alias")
    p = b.read(spark, sf, "part")
    rows = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("raw"), F.upper("p_type").alias("canonical"))
    rows = rows.unionByName(rows.select((-F.col("p_partkey")).alias("p_partkey"), "raw", F.lit(" ").alias("canonical")))
    rows.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").select("raw", "canonical").write.option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return sources.read_alias_map(spark, path)


@query("""SELECT batch_id, mpn FROM (SELECT CASE WHEN l_linestatus='O' THEN 'b1' ELSE 'b2' END AS batch_id, l_partkey||'-'||l_suppkey AS mpn FROM lineitem) WHERE batch_id='b2'
  UNION ALL SELECT 'b1', 'again-'||p_partkey FROM part""")
def candidates_replaced(spark, sf):
    """K2s: a batch written again replaces that batch only."""
    path = _fresh_dir(spark, "candidates")
    li = b.read(spark, sf, "lineitem")
    first = li.select(F.when(F.col("l_linestatus") == "O", "b1").otherwise("b2").alias("batch_id"), F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("mpn"))
    sinks.write_candidates(first, path)
    again = b.read(spark, sf, "part").select(F.lit("b1").alias("batch_id"), F.concat(F.lit("again-"), F.col("p_partkey").cast("string")).alias("mpn"))
    sinks.write_candidates(again, path)
    return spark.read.schema("mpn string, batch_id string").parquet(path).select("batch_id", "mpn")


@query("SELECT 'urls_'||(1 + (row_number() OVER (ORDER BY o_orderkey) - 1)//700) AS file, '  <url><loc>https://x/?a='||o_orderkey||'&amp;b=&lt;'||'</loc></url>' AS value FROM orders QUALIFY count(*) OVER () > 700")
def url_files(spark, sf):
    """K6s: numbered files of at most 700 lines, escaped, read back with their names."""
    path = _fresh_dir(spark, "urls")
    urls = b.read(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("https://x/?a="), F.col("o_orderkey").cast("string"), F.lit("&b=<")).alias("url"))
    sinks.write_url_shards(sinks.url_shards(urls, ["o_orderkey"], "urls", 700), path)
    return spark.read.schema("value string, file string").text(path).select("file", "value")


@query("""SELECT (row_number() OVER (ORDER BY lower(c_name), c_custkey) - 1)//400 AS shard, c_custkey, c_name FROM customer""")
def search_shard_files(spark, sf):
    """K5s: shards of 400 entries in sort order, read back."""
    path = _fresh_dir(spark, "shards")
    c = b.read(spark, sf, "customer").select("c_custkey", "c_name", F.lower("c_name").alias("k"))
    sinks.write_search_shards(sinks.search_shards(c, ["k", "c_custkey"], 400), path, ["k", "c_custkey"])
    return spark.read.schema("c_custkey long, c_name string, k string, shard long").json(path).select("shard", "c_custkey", "c_name")


@query(b.sql("SELECT ord, mpn, (row_number() OVER (ORDER BY ord) - 1)//150 AS slice FROM parts_v", "parts_v"))
def slice_files(spark, sf):
    """K3s: slices of 150 rows, read back with their number counted from the first."""
    path = _fresh_dir(spark, "slices")
    sliced = plan_slices(b.parts(spark, sf).select("ord", "mpn"), size=150)
    sinks.write_slices(sliced, path)
    found = spark.read.parquet(path)
    first = found.agg(F.min("slice_idx").alias("_first"))
    return found.crossJoin(F.broadcast(first)).select("ord", "mpn", (F.col("slice_idx") - F.col("_first")).cast("long").alias("slice"))


@query("""SELECT DISTINCT c_name AS mpn, 'unknown_brand' AS reason, c_mktsegment AS detail FROM customer""")
def review_queue_file(spark, sf):
    """K7s: repeats are written once."""
    path = _fresh_dir(spark, "review")
    c = b.read(spark, sf, "customer").select(F.col("c_name").alias("mpn"), F.lit("unknown_brand").alias("reason"), F.col("c_mktsegment").alias("detail"))
    sinks.write_review_queue(c.unionByName(c), path)
    return spark.read.option("header", True).csv(path)


@query("""SELECT CAST(count(*) AS BIGINT) AS total, 'ok' AS part FROM part UNION ALL SELECT count(*), 'finding' FROM part WHERE p_size>40""")
def plan_files(spark, sf):
    """K10s: a summary of one row, and findings as rows of their own."""
    path = _fresh_dir(spark, "plan")
    p = b.read(spark, sf, "part")
    sinks.write_plan(p.agg(F.count(F.lit(1)).alias("total")), p.where("p_size > 40").select("p_partkey"), path)
    summary = spark.read.json(f"{path}/summary").select(F.col("total").cast("long").alias("total"), F.lit("ok").alias("part"))
    return summary.unionByName(spark.read.json(f"{path}/findings").agg(F.count(F.lit(1)).alias("total"), F.lit("finding").alias("part")))


@query(b.sql("""SELECT count(*) * 2 AS rows, true AS ok FROM parts_v UNION ALL SELECT 0, false""", "parts_v"))
def master_appended(spark, sf):
    """K1s: an append that is clean, and one that repeats identities and is refused."""
    old = _master(spark, sf)
    new = old.withColumn("mpn", F.concat(F.lit("N"), F.col("mpn")))
    good = sinks.append_validated(spark, old, new, _fresh_dir(spark, "snapshot"))
    bad = sinks.append_validated(spark, old, old, _fresh_dir(spark, "snapshot"))
    counted = spark.read.parquet(good.path).agg(F.count(F.lit(1)).alias("rows"), F.lit(good.ok).alias("ok"))
    return counted.unionByName(spark.range(1).select(F.lit(bad.rows).cast("long").alias("rows"), F.lit(bad.ok).alias("ok")))


@query("""SELECT doc_id, CASE WHEN text IS NULL OR text='' THEN 'EMPTY' WHEN octet_length(encode(text))<1024 THEN 'TOO_SMALL' WHEN doc_id%3=0 THEN '' WHEN doc_id%3=1 THEN 'NO_END_MARK' ELSE 'NO_PDF_MARK' END AS error FROM documents""")
def document_errors(spark, sf):
    """F69 over documents that carry both marks, one of them or none."""
    d = b.read(spark, sf, "documents")
    small = F.octet_length("text") < 1024
    body = F.when(small | F.col("text").isNull(), F.col("text")).when(F.col("doc_id") % 3 == 0, F.concat(F.lit("%PDF-1.4 "), F.col("text"), F.lit(" %%EOF"))).when(
        F.col("doc_id") % 3 == 1, F.concat(F.lit("%PDF-1.4 "), F.col("text"))).otherwise(F.concat(F.lit("x"), F.col("text"), F.lit(" %%EOF")))
    return d.select("doc_id", sources.document_error(body.cast("binary")).alias("error"))
