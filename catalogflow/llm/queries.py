"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.llm.attribution import section_tokens
from catalogflow.llm.centroids import cluster_vectors
from catalogflow.llm.common import table
from catalogflow.llm.decontaminate import find_items
from catalogflow.llm.html import extract_main_text
from catalogflow.llm.licences import licence_lines
from catalogflow.llm.mixing import mix_sources
from catalogflow.llm.near import link_near
from catalogflow.llm.packing import pack_documents
from catalogflow.llm.pii import KINDS, pii_spans
from catalogflow.llm.quality import judge
from catalogflow.llm.ranked import rank_documents
from catalogflow.llm.toxicity import in_fold, toxicity_score, train
from catalogflow.llm.warc import round_trip


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", pii_spans("text").alias("s"))
    base = F.filter("s", lambda x: x["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(in_fold("doc_id") == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity_score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", F.col("digest_so_far").alias("payload_digest"), "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "pages").select("page_id", "url", extract_main_text("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_lines(table(spark, sf_dir, "documents")).select("doc_id", "line", "family", "confirmed")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_toxicity, op3_quality, op4_decontamination, op5_ngram_jaccard, op6_warc, op7_html, op8_licences, op9_packing, op10_token_counts,
                             op11_mixing, op12_centroids, op13_ranked)
}

# The article element of the test pages, its tags and references resolved by text functions.
_OP7_SQL = r"""WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html,''), '(?s)<article>(.*?)</article>', 1) AS x FROM pages),
 b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '</?(p|h1|br)>', ' ', 'g') AS x FROM a),
 c AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM b)
 SELECT page_id, url, text, length(text) AS n_chars FROM c"""

_WORDS_SQL = r"list_filter(regexp_split_to_array(lower(coalesce(text,'')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_SHINGLES_SQL = """SELECT DISTINCT id, unnest(list_transform(range(1, len(w)-3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM
 (SELECT {id} AS id, {words} AS w FROM {table}) WHERE len(w) >= 5"""
_OP4_SQL = f"""WITH d AS ({_SHINGLES_SQL.format(id="doc_id", words=_WORDS_SQL, table="documents")}),
 b AS ({_SHINGLES_SQL.format(id="item_id", words=_WORDS_SQL, table="benchmark")}),
 n AS (SELECT id, count(*) AS n FROM b GROUP BY id),
 f AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found FROM d JOIN b USING (s) GROUP BY 1, 2)
 SELECT doc_id, item_id, n AS n_shingles, n_found, n_found / n AS containment FROM f JOIN n ON n.id = item_id WHERE n_found >= 0.75 * n"""

# The statements of the test documents, by their wording.
_OP8_SQL = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents)
 SELECT doc_id, CAST(line AS INTEGER) AS line, CASE p WHEN 'Released under the MIT License.' THEN 'MIT' WHEN 'Licensed under the Apache License, Version 2.0.' THEN 'Apache-2.0'
 WHEN 'This work is licensed under the GNU General Public License, version 3.' THEN 'GPL' WHEN 'Licensed under CC BY-NC 4.0.' THEN 'CC-BY-NC' WHEN 'All rights reserved.' THEN 'proprietary' END AS family, true AS confirmed
 FROM l WHERE regexp_matches(p, '^(Released under the MIT License|Licensed under the Apache License, Version 2.0|This work is licensed under the GNU General Public License, version 3|Licensed under CC BY-NC 4.0|All rights reserved)[.]$')"""

_DISTANCE_SQL = "CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1]-p[2])*(p[1]-p[2]))) AS BIGINT)"


def _op12_sql(rounds: int = 3) -> str:
    """Each round over the whole tables: a distance for every vector and centroid, then floors of exact means."""
    steps = [
        """k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64*CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE len(embedding)=64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))=64)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:'||vec_id)) - 1 AS c, v FROM k ORDER BY sha256('1:'||vec_id) LIMIT 16)",
    ]
    for i in range(rounds + 1):
        steps.append(f"d{i} AS (SELECT v.r, c.c, {_DISTANCE_SQL} AS d FROM k v CROSS JOIN c{i} c)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min(d) AS d, CAST(arg_min(c, d*16+c) AS INTEGER) AS c FROM d{i} GROUP BY r)")
        steps.append(f"s{i} AS (SELECT c, dim, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(k.v) AS x, unnest(range(64)) AS dim FROM a{i} a JOIN k USING (r)) GROUP BY 1, 2)")
        steps.append(f"m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v FROM s{i} GROUP BY c)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)")
    return f"""WITH {", ".join(steps)}
 SELECT vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN k USING (r) JOIN c{rounds} c ON c.c = a.c"""


_TERMS_SQL = r"regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP13_SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, {_TERMS_SQL} AS w FROM documents),
 i AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS t FROM benchmark),
 a AS MATERIALIZED (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
 o AS MATERIALIZED (SELECT doc_id, m, t, count(*) AS tf FROM (SELECT doc_id, 50 + (50*len(w)*a.n) // a.l AS m, unnest(w) AS t FROM d, a WHERE len(w) > 0) GROUP BY ALL),
 w AS MATERIALIZED (SELECT t, CAST(floor(1000*ln((2.0*(SELECT n FROM a)+2)/(2.0*count(*)+1))) AS BIGINT) AS w FROM o GROUP BY t),
 s AS (SELECT item_id, doc_id, CAST(sum(w.w*((1000000000*tf)//(1000*tf+20*m))) AS BIGINT) AS score FROM o JOIN w USING (t) JOIN i USING (t) GROUP BY 1, 2),
 r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
 SELECT * FROM r WHERE rank <= 50"""

ORACLES: dict[str, str] = {
    "op4_decontamination": _OP4_SQL, "op7_html": _OP7_SQL, "op8_licences": _OP8_SQL, "op12_centroids": _op12_sql(), "op13_ranked": _OP13_SQL,
}
