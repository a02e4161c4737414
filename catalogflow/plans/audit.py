"""Audits and reports (B10, B14, B15) and enrichment from pages (B13), dictionaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.functions import attrs, classify, markup, text as tx
from catalogflow.functions.keys import key_alnum, key_exact, merge_semicolon, nonblank, slug_hyphen, text
from catalogflow.operators import aggregates, gates, identity
from catalogflow.operators.ordering import carry_parent, global_rank, unique_seo_slugs, with_order

# Tokens a published text may not hold.
TOKENS = (
    ("supplier host", r"(?i)lcsc\.com"),
    ("supplier site", r"(?i)www\.lcsc\.com"),
    ("supplier assets", r"(?i)assets\.lcsc\.com"),
    ("MCU100 family", r"(?i)MCU100"),
    ("100000 family", r"100000\d{3}"),
    ("TEST token", r"(?i)(?<!\.)\bTEST\b"),
    ("SAMPLE token", r"\bSAMPLE\b"),
    ("PLACEHOLDER", r"PLACEHOLDER"),
    ("XXX suffix", r"(?i)XXX$"),
)


def _check(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n", F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"))


def classification_consistency(
    master: DataFrame, records: DataFrame, links: DataFrame, pages: DataFrame, valid_l1: DataFrame, text_columns: Sequence[str] = ("description",)
) -> DataFrame:
    """Five checks, one row each (check, n, status).

    A blank or unknown level-1 slugs in MASTER, B part numbers of MASTER without a record and the
    other way round, C records whose level-1 slug differs from MASTER, D forbidden tokens, E dead links.
    """
    l1 = valid_l1.select(F.col("slug").alias("_l")).distinct()
    unknown = master.join(l1, text("native_l1") == F.col("_l"), "left_anti")
    m = master.groupBy(key_exact("mpn").alias("mpn")).agg(F.min(text("native_l1")).alias("native_l1")).where("mpn <> ''")
    p = records.groupBy(key_exact("mpn").alias("mpn")).agg(F.min(text("native_l1")).alias("native_l1")).where("mpn <> ''")
    cmp = identity.reconcile(m, p, ["mpn"], ["native_l1"])
    tokens = gates.forbidden_tokens(records, "mpn", list(text_columns), TOKENS)
    dead = gates.dead_links(links, pages).where("link_status = 'dead'")
    return reduce(DataFrame.unionByName, [
        _check(unknown, "A_l1_known"), _check(cmp.where("status in ('missing','extra')"), "B_same_parts"),
        _check(cmp.where("status = 'mismatch'"), "C_same_l1"), _check(tokens, "D_tokens"), _check(dead, "E_links")])


def catalog_audit(records: DataFrame, pages: DataFrame, page_keys: DataFrame, exemptions: DataFrame | None = None, known_brand: str = "manufacturer") -> tuple[DataFrame, DataFrame]:
    """(checks, all offenders; ``first_reports`` gives their heads). Synthetic rows, forbidden tokens, records without page (FAIL) and
    pages without record (WARN), JSON-LD, CJK outside the masked parts, document hosts."""
    exempt = gates.numeric_mpn_exempt("build", known_brand)
    synthetic = records.withColumn("reason", gates.synthetic_reason(F.trim("mpn"), known_brand, exempt)).where("reason <> ''")
    tokens = gates.forbidden_tokens(records, "mpn", ["description"], TOKENS, exemptions)
    r = records.select(key_alnum("mpn").alias("k")).where("k <> ''").distinct()
    p = page_keys.select(key_alnum("key").alias("k")).where("k <> ''").distinct()
    no_page, orphan = r.join(p, "k", "left_anti"), p.join(r, "k", "left_anti")
    masked = pages.select("page_id", markup.mask_for_scan("html").alias("m"))
    cjk = masked.where(tx.has_cjk("m"))
    schema = aggregates.schema_coverage(pages)
    hosts = records.withColumn("verdict", gates.classify_host("datasheet_url")["verdict"]).where("verdict like 'BAD%'")
    checks = reduce(DataFrame.unionByName, [
        _check(synthetic, "synthetic"), _check(tokens, "tokens"), _check(no_page, "records_without_page"),
        _check(orphan, "pages_without_record").withColumn("status", F.when(F.col("n") == 0, "PASS").otherwise("WARN")),
        schema.select(F.lit("json_ld_errors").alias("check"), F.col("parse_errors").alias("n"), F.when(F.col("parse_errors") == 0, "PASS").otherwise("FAIL").alias("status")),
        _check(cjk, "cjk"), _check(hosts, "document_hosts")])
    off = lambda d, c, v: d.select(F.lit(c).alias("check"), v.cast("string").alias("what"))
    offenders = reduce(DataFrame.unionByName, [
        off(synthetic, "synthetic", F.col("mpn")), off(tokens, "tokens", F.col("key")), off(no_page, "records_without_page", F.col("k")),
        off(orphan, "pages_without_record", F.col("k")), off(cjk, "cjk", F.col("page_id")), off(hosts, "document_hosts", F.col("mpn"))])
    return checks, offenders


def audit_verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(F.sum(F.when(F.col("status") == "FAIL", 1).otherwise(0)).alias("failed"), F.sum(F.when(F.col("status") == "WARN", 1).otherwise(0)).alias("warned")).withColumn(
        "verdict", F.when(F.col("failed") > 0, "FAIL").when(F.col("warned") > 0, "WARN").otherwise("PASS"))


def batch_report(before: DataFrame, after: DataFrame, key: str = "ord", label: str = "category", attributes: str = "attributes_json") -> DataFrame:
    """Metrics of two runs side by side: rows, categories, rows with attributes, leaked keys."""
    def metrics(d):
        n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
        wide = d.agg(
            F.count(F.lit(1)).cast("long").alias("rows"), F.countDistinct(label).cast("long").alias("categories"),
            n(text(label).isin("", classify.UNCATEGORIZED)).cast("long").alias("uncategorized"),
            n(attrs.spec_count(attributes) > 0).cast("long").alias("rows_with_specs"), n(F.size(attrs.leaked_keys(attributes)) > 0).cast("long").alias("rows_with_leaks"))
        return wide.unpivot([], wide.columns, "metric", "value")

    return aggregates.metric_delta(metrics(before), metrics(after))


# ---- enrichment from pages (B13) -----------------------------------------------------------

def page_facts(pages: DataFrame, code: str = "code", mpn: str = "mpn", html: str = "html", ord: str = "ord") -> DataFrame:
    """F62-F63 per page."""
    return with_order(pages, ord).select(
        F.col(ord).alias("ord"),
        F.col(code).alias("code"), F.col(mpn).alias("mpn"), markup.property_pairs(html).alias("pairs"), markup.page_description(html).alias("description"),
        markup.page_faq(html).alias("faqs"), markup.page_brand(html).alias("page_brand"), markup.list_after_heading(html).alias("applications"),
        markup.alternate_anchors(html, F.col(code), F.col(mpn)).alias("alternates"))


def enrich(master: DataFrame, pages: DataFrame, code: str = "supplier_reference") -> DataFrame:
    """Patch rows: page facts merged into the curated columns, one per MASTER row with a page. Of
    several pages of a code the first by ``ord`` counts."""
    facts = page_facts(pages).groupBy("code").agg(F.min_by(F.struct("pairs", "description", "faqs", "applications", "alternates"), "ord").alias("f"))
    rows = master.where(gates.valid_code(code)).join(facts, text(code) == F.col("code"))
    fresh = F.map_from_entries(F.transform("f.pairs", lambda p: F.struct(p["name"].alias("key"), p["value"].alias("value"))))
    curated = F.coalesce(attrs.json_map("attributes_json"), attrs.empty_text_map())
    return rows.select(
        "ord", "mpn", F.col(code).alias("supplier_reference"), F.to_json(attrs.merge_attributes(curated, fresh)).alias("attributes_json"),
        merge_semicolon("applications", F.array_join("f.applications", ";")).alias("applications"),
        merge_semicolon("alternative_parts", F.array_join(F.transform("f.alternates", lambda a: a["mpn"]), ";")).alias("alternative_parts"),
        F.when(nonblank("description"), F.col("description")).otherwise(F.col("f.description")).alias("description"),
        tx.faq_text("f.faqs").alias("faq"))


# ---- category dictionary (B19) ------------------------------------------------------------------

def category_dictionary(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Category tree of the listing pages in document order: id, level, parent, name, slug."""
    anchors = pages.select(F.col(page).alias("_p"), F.posexplode(markup.tree_anchors(html)).alias("_i", "a")).select(
        F.struct(F.col("_p").alias("p"), F.col("_i").alias("i")).alias("ord"), "a.*")
    return tree_dictionary(anchors)


def tree_dictionary(anchors: DataFrame) -> DataFrame:
    """``anchors``: ord, level, id, name. Adds parent id and a unique slug; ids follow tree order."""
    tree = carry_parent(anchors)
    parent = F.when(F.col("level") == 2, F.col("l1_id")).when(F.col("level") >= 3, F.col("l2_id"))
    base = F.coalesce(F.nullif(slug_hyphen("name"), F.lit("")), F.lit("category"))
    slugged = unique_seo_slugs(tree.withColumn("parent_id", parent).withColumn("base", base))
    return global_rank(slugged, ["ord"], "_r").withColumn("cat_id", F.format_string("CAT-%04d", F.col("_r"))).drop("_r", "base")
