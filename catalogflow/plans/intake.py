"""Intake, normalisation and wave ingest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.functions import attrs, classify
from catalogflow.functions.keys import key_filesafe, key_upper, nonblank, text
from catalogflow.functions.text import as_text, has_illegal_text
from catalogflow.operators import gates, identity
from catalogflow.operators.merge import canonicalize_brand
from catalogflow.operators.ordering import first_occurrence, global_rank, plan_slices
from catalogflow.session import cut


@dataclass
class Intake:
    kept: DataFrame
    counters: DataFrame
    exceptions: DataFrame


def intake(
    raw: DataFrame, selector: DataFrame | None = None, exclude: DataFrame | None = None, category: str | None = None,
    require_document: bool = False, limit: int | None = None, ord: str = "ord",
) -> Intake:
    """B1: filter ladder, first occurrence of a part number, limit on the kept rows, counters."""
    flagged = gates.intake_filter(raw, selector, exclude, category, require_document)
    passed = flagged.where("drop_reason = ''").drop("drop_reason")
    kept = first_occurrence(passed, [key_upper("mpn")], ord)
    if limit is not None:
        kept = global_rank(kept, [ord], "_r").where(F.col("_r") <= limit).drop("_r")
    n_passed = passed.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key_upper("mpn")).alias("d"))
    counters = gates.drop_counts(flagged).withColumnRenamed("drop_reason", "counter").unionByName(
        n_passed.select(F.lit("repeated_in_source").alias("counter"), (F.col("n") - F.col("d")).alias("n"))).unionByName(
        kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("counter"), "n"))
    repeated = n_passed.where("n > d").select((F.col("n") - F.col("d")).alias("x"))
    exc = gates.exceptions(
        repeated.withColumn("mpn", F.lit(None).cast("string")), "DUPLICATE_SKIP",
        F.concat(F.col("x").cast("string"), F.lit(" part numbers repeat inside the source; first kept")))
    return Intake(kept, counters, exc)


def build_rows(records: DataFrame, alias: DataFrame) -> DataFrame:
    """Row construction of B2: brand, family, level-1 slug, attributes, texts and pool-only fields.

    ``records`` come from the flat export (source-language attributes) or from flattened
    envelopes (``source_kind`` = lcsc_http_json, English keys and the unmapped side map).
    """
    cols = records.columns
    opt = lambda c: F.col(c) if c in cols else F.lit("")
    rows = canonicalize_brand(records, alias, "manufacturer_raw").withColumn("brand", F.col("brand_canonical"))
    english = text(opt("source_kind")) == "lcsc_http_json"
    rows = rows.withColumn("_l1", classify.native_l1(opt("parentCatalogName"), F.col("catalogName")))
    rows = rows.withColumn("_det", classify.detect_family(opt("parentCatalogName"), "catalogName", "category", "description", "attributes_json"))
    canon = F.coalesce(attrs.variant_map("attributes_json"), F.create_map().cast("map<string,variant>"))
    side = F.coalesce(attrs.json_map(opt("attributes_json_unmapped")), attrs.empty_text_map())
    fallback = classify.detect_by_english_keys(canon, side, "description")
    family = F.when(english & (F.col("_det.family") == classify.UNCATEGORIZED), F.coalesce(fallback["family"], F.col("_det.family"))).otherwise(F.col("_det.family"))
    rows = rows.withColumn("family", F.when(~english & (F.col("_l1") == ""), classify.UNCATEGORIZED).otherwise(family))
    projected = F.when(english, attrs.forward_unmapped(classify.project_english("family", canon), side)).when(
        F.col("family") == classify.UNCATEGORIZED, F.create_map().cast("map<string,variant>")).otherwise(
        classify.project_source("family", "attributes_json", "description", "mpn"))
    # values with text that may not be published are left out once more, whatever their source
    clean = F.map_filter(projected, lambda k, v: ~has_illegal_text(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))))
    rows = rows.withColumn("_attrs", clean).withColumn("_txt", classify.family_text("family", "_attrs", "brand", "mpn"))
    known = F.col("family") != classify.UNCATEGORIZED
    plain = F.trim(F.regexp_replace(text("description"), r"[^\x00-\x7F]", " "))
    category = F.when(F.col("_l1") != "", F.col("_l1")).when(english, F.col("family")).otherwise(classify.UNCATEGORIZED)
    keep = ["ord"] if "ord" in cols else []
    return rows.select(
        *keep, "mpn", F.lit("").alias("clean_mpn"), F.col("brand").alias("manufacturer"), "brand", F.lit("").alias("url_slug"),
        category.alias("category"), category.alias("subcategory"),
        F.when(known, F.col("_txt.description")).when(plain != "", plain).otherwise(F.concat_ws(" ", "brand", "mpn")).alias("description"),
        text(opt("applications_en")).alias("applications"), F.when(known, F.col("_txt.keywords")).otherwise(F.col("mpn")).alias("keywords"),
        F.to_json("_attrs").alias("attributes_json"), F.lit("active").alias("availability"), text(opt("alternative_parts")).alias("alternative_parts"),
        as_text(opt("alternative_parts_detail")).alias("alternative_parts_detail"), text("source_datasheet_url").alias("datasheet_url"), F.lit("").alias("faq"),
        text(opt("source_image_url")).alias("image"), F.lit("").alias("source"), F.lit("LCSC").alias("source_url"),
        text("supplier_sku").alias("supplier_reference"), F.col("_l1").alias("native_l1"),
        *[text(opt(c)).alias(c) for c in ("lcsc_parent_chain", "lcsc_leaf_id", "lcsc_leaf_name", "lcsc_parent_id", "lcsc_parent_name", "lcsc_depth")],
        key_filesafe("mpn").alias("asset_key"), F.size("_attrs").alias("spec_keys"), "family", F.col("_det.level").alias("signal_level"),
        text(opt("source_kind")).alias("source_kind"), (F.col("_l1") == "").alias("needs_review"),
    )


@dataclass
class Normalized:
    candidates: DataFrame
    rows: DataFrame
    exceptions: DataFrame
    decision: DataFrame


def normalize(records: DataFrame, master: DataFrame, alias: DataFrame, mode: str = "mpn_brand") -> Normalized:
    """B2: synthetic screen, row build, qualification, duplicate guard.

    The qualified rows feed three outputs, so they are stored once.
    """
    exempt = gates.numeric_mpn_exempt("intake", "manufacturer_raw", "supplier_sku", "description", "source_kind" if "source_kind" in records.columns else F.lit(""))
    screened = records.withColumn("_syn", gates.synthetic_reason("mpn", "manufacturer_raw", exempt))
    rows = cut(gates.qualify(build_rows(screened.where("_syn = ''").drop("_syn"), alias), alias))
    guard = identity.dedup_guard(rows.where("verdict <> 'reject'"), master, mode=mode)
    exc = gates.exceptions(screened.where("_syn <> ''"), "SYNTHETIC_MPN", F.col("_syn")).unionByName(
        gates.exceptions(rows.where("verdict <> 'ok'"), F.col("code"), F.col("note"), severity=F.when(
            F.col("verdict") == "warn", "WARNING").when(F.col("code") == "CJK_LEAK", "STOP").otherwise("AUTO_SKIP"))).unionByName(guard.exceptions)
    return Normalized(guard.new, rows, exc, guard.decision)


def ingest_wave(raw: DataFrame, master: DataFrame, exclude: DataFrame | None = None, size: int = 500, wave: str = "wave", **filters) -> tuple[DataFrame, DataFrame]:
    """Filter once, drop repeats and known part numbers, number the slices. Returns (slices, counters)."""
    known = master.select("mpn")
    if exclude is not None:
        known = identity.union_distinct(known, exclude.select("mpn"))
    result = intake(raw, exclude=known, **filters)
    return plan_slices(result.kept, size, wave=wave), result.counters
