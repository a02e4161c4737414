"""Publishing: catalog build, change plan, index policy, pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow import rules
from catalogflow.functions import attrs, text as tx, units
from catalogflow.functions.keys import key_upper, literal_map, nonblank, search_keys, slug_hyphen, text
from catalogflow.operators import aggregates, gates, identity, merge
from catalogflow.operators.ordering import paginate, with_order
from catalogflow.session import cut, stored

FINGERPRINTS = ("renderer_v", "data_fp", "enrich_fp", "template_v", "asset_v", "dependency_fp")


# ---- change plan (B6) ----------------------------------------------------------------

def build_keys(
    pages: DataFrame, data_columns: Sequence[str], neighbours: DataFrame | None = None, slug: str = "slug",
    renderer: str = "v3", template: str = "1", asset: str = "0",
) -> DataFrame:
    """Six fingerprints per page. ``neighbours`` (slug, rank, neighbour, neighbour_mpn) is the related list
    a page shows; ``enrich_fp`` is taken from the pages when present."""
    rows = pages.select(
        F.col(slug).alias("slug"), F.col("mpn").alias("mpn"), F.lit(renderer).alias("renderer_v"), aggregates.row_fingerprint(data_columns).alias("data_fp"),
        (F.col("enrich_fp") if "enrich_fp" in pages.columns else F.lit("NO_ENRICH")).alias("enrich_fp"),
        F.lit(template).alias("template_v"), F.lit(asset).alias("asset_v"))
    if neighbours is None:
        return rows.withColumn("dependency_fp", F.lit(""))
    dep = aggregates.group_fingerprint(neighbours, ["slug"], ["neighbour_mpn", "neighbour"], "rank").withColumnRenamed("fingerprint", "dependency_fp")
    return rows.join(dep, "slug", "left").withColumn("dependency_fp", F.coalesce("dependency_fp", F.lit("")))


def places(pages: DataFrame, group: str, ord: str, slug: str = "slug") -> DataFrame:
    """(slug, mpn, group, ord): what the related lists (J10) of a page set depend on; kept beside the fingerprints."""
    return pages.select(F.col(slug).alias("slug"), F.col("mpn").alias("mpn"), F.col(group).alias("group"), F.col(ord).alias("ord"))


def changed_groups(new: DataFrame, old: DataFrame) -> DataFrame:
    """Groups in which a page came, went, moved or was renamed, of two tables of ``places``."""
    of = lambda d, sign: d.groupBy("slug", "mpn", "group", "ord").agg(F.sum(F.lit(sign)).alias("n"))
    both = of(new, 1).unionByName(of(old, -1)).groupBy("slug", "mpn", "group", "ord").agg(F.sum("n").alias("n"))
    return both.where("n <> 0").select("group").distinct()


def updated_dependencies(new: DataFrame, old: DataFrame, recorded: DataFrame, k: int = 6) -> DataFrame:
    """(slug, dependency_fp) of all pages in ``new``, equal to a ranking of all groups, with only changed ones ranked anew.

    ``new``, ``old``: ``places``; ``recorded``: slug, dependency_fp. A slug in several groups shows the list of the group that starts first, so the
    groups that share a slug with a changed one are ranked with them.
    """
    touched = cut(changed_groups(new, old))
    in_touched = new.join(touched, new["group"].eqNullSafe(touched["group"]), "left_semi")
    slugs = cut(in_touched.select("slug").distinct())
    shared = new.join(slugs, "slug", "left_semi").select(F.col("group").alias("_g")).distinct()
    pool = new.join(shared, F.col("group").eqNullSafe(F.col("_g")), "left_semi")
    lists = identity.related_neighbours(pool, "group", "slug", "ord", k)
    fresh = aggregates.group_fingerprint(lists.join(slugs, "slug", "left_semi"), ["slug"], ["neighbour_mpn", "neighbour"], "rank").withColumnRenamed("fingerprint", "dependency_fp")
    again = slugs.join(fresh, "slug", "left").select("slug", F.coalesce("dependency_fp", F.lit("")).alias("dependency_fp"))
    kept = new.select("slug").distinct().join(slugs, "slug", "left_anti").join(recorded.select("slug", "dependency_fp"), "slug")
    return again.unionByName(kept.select("slug", "dependency_fp"))


def incremental_keys(pages: DataFrame, recorded: DataFrame, recorded_places: DataFrame, data_columns: Sequence[str], group: str, ord: str, k: int = 6, **versions: str) -> DataFrame:
    """B6 keys of ``pages`` as ``build_keys`` gives them with the related lists of all groups, from what was recorded and the changes since."""
    dep = updated_dependencies(places(pages, group, ord), recorded_places, recorded, k)
    return build_keys(pages, data_columns, **versions).drop("dependency_fp").join(dep, "slug")


def change_plan(desired: DataFrame, recorded: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """CREATE, UPDATE or SKIP per page, and for updates direct or dependency-induced.

    ``edges`` (source, target): a page that lists a page being written is updated too, one hop.
    """
    old = recorded.select(F.col("slug").alias("_s"), *[F.col(f).alias(f"_o_{f}") for f in FINGERPRINTS])
    j = desired.join(old, F.col("slug") == F.col("_s"), "left")
    changed = {f: ~F.col(f).eqNullSafe(F.col(f"_o_{f}")) for f in FINGERPRINTS}
    any_of = lambda names: F.greatest(*[changed[f].cast("int") for f in names]) == 1
    own = any_of(FINGERPRINTS[:-1])
    action = F.when(F.col("_s").isNull(), "CREATE").when(own | changed["dependency_fp"], "UPDATE").otherwise("SKIP")
    kind = F.when(F.col("_s").isNull(), "").when(own, "direct").when(changed["dependency_fp"], "dependency-induced").otherwise("")
    plan = j.select("slug", "mpn", action.alias("action"), kind.alias("kind"))
    if edges is None:
        return plan
    plan = cut(plan)
    written = plan.where("action <> 'SKIP'").select(F.col("slug").alias("_w"))
    induced = edges.join(written, F.col("target") == F.col("_w"), "left_semi").select(F.col("source").alias("_i")).distinct()
    out = plan.join(induced, F.col("slug") == F.col("_i"), "left")
    pushed = (F.col("action") == "SKIP") & F.col("_i").isNotNull()
    return out.select("slug", "mpn", F.when(pushed, "UPDATE").otherwise(F.col("action")).alias("action"),
                      F.when(pushed, "dependency-induced").otherwise(F.col("kind")).alias("kind"))


def change_summary(plan: DataFrame) -> DataFrame:
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    a, k = F.col("action"), F.col("kind")
    return plan.agg(n(a == "CREATE").alias("create"), n(a == "UPDATE").alias("update"), n(a == "SKIP").alias("skip"),
                    n(k == "direct").alias("direct"), n(k == "dependency-induced").alias("dependency_induced"))


def affected_nodes(plan: DataFrame, pages: DataFrame, slug: str = "slug") -> DataFrame:
    """Brands, tops and level-1 nodes that hold a written page."""
    hit = pages.join(plan.where("action <> 'SKIP'").select(F.col("slug").alias("_w")), F.col(slug) == F.col("_w"), "left_semi")
    cols = [c for c in ("manufacturer", "top", "native_l1") if c in pages.columns]
    node = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("node")) for c in cols]))
    return hit.select(node.alias("x")).select("x.*").where("node <> ''").distinct()


def unexpected_writes(plan: DataFrame, requested: DataFrame) -> DataFrame:
    """B6 scope guard: written pages that were neither requested nor dependency-induced."""
    return identity.scope_violations(
        plan.where("action <> 'SKIP'").select("slug"), requested.select("slug"), plan.where("kind = 'dependency-induced'").select("slug"))


def bootstrap(desired: DataFrame, published: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """B6 baseline: (recorded pages, orphans without a part, parts without a page)."""
    p = published.select(F.col("slug").alias("_p")).distinct()
    recorded = desired.join(p, F.col("slug") == F.col("_p"), "left_semi").withColumn(
        "status", F.when(F.col("asset_v") == "UNKNOWN", "REQUIRES_REBUILD").otherwise("published"))
    orphans = p.join(desired, F.col("_p") == F.col("slug"), "left_anti").select(F.col("_p").alias("slug"))
    missing = desired.join(p, F.col("slug") == F.col("_p"), "left_anti").select("slug", "mpn")
    return recorded, orphans, missing


# ---- catalog build (B7) -----------------------------------------------------------------

@dataclass
class Catalog:
    records: DataFrame
    makers: DataFrame
    tops: DataFrame
    search: DataFrame
    urls: DataFrame
    review: DataFrame
    stats: DataFrame


def catalog_build(
    offers: DataFrame, alias: DataFrame, deployed: DataFrame, tops: DataFrame, l1: DataFrame, final: DataFrame | None = None,
    allowed_keys: DataFrame | None = None, site: str = "https://catalog.invalid",
) -> Catalog:
    """Merge offers, attach final units, assign slugs, derive the published sets.

    Offers are merged once, step by step, and slugs are assigned to parts without their lists and texts.
    """
    merged = merge.merge_offers(offers, stored(alias), allowed_keys, keep=stored)  # Spark knows how small the aliases are only once they are stored
    groups = merged.groups.drop("_brand", "_mpn")
    if final is not None:
        groups = aggregates.attach_final(groups, final)
    groups = stored(groups.withColumn("_row", F.monotonically_increasing_id()))
    named = groups.select(*[c for c in groups.columns if c in ("_row", "ord", "mpn", "manufacturer", "supplier_reference", "url_slug")])
    slugs = identity.assign_stable_slugs(named, deployed).select("_row", "url_slug")
    groups = groups.drop("url_slug").join(slugs, "_row").drop("_row")
    records = gates.resolve_taxonomy(groups, tops, l1)
    records = stored(records.withColumn("product_url", F.concat(F.lit("products/"), F.col("url_slug"), F.lit("/"))))
    makers, top_facets = aggregates.facet_counts(records, "top", "native_l1")
    listed = records.where("url_slug <> ''")
    search = search_entries(listed)
    urls = listed.select(F.concat(F.lit(site + "/products/"), F.col("url_slug"), F.lit("/")).alias("url"), "url_slug", "ord")
    return Catalog(records, makers, top_facets, search, urls, merged.review, merged.stats)


def search_entries(records: DataFrame) -> DataFrame:
    """Title, key, search keys, type, URL and maker of each part."""
    return records.select(
        F.col("mpn").alias("t"), text(F.lower("mpn")).alias("k"), search_keys("mpn").alias("keys"), F.lit("PART").alias("ty"),
        F.concat(F.lit("/products/"), F.col("url_slug"), F.lit("/")).alias("u"), F.col("manufacturer").alias("sub"))


# ---- index policy (B8) -----------------------------------------------------------------------

def index_policy(parts: DataFrame, category: str = "category", slug: str = "slug") -> DataFrame:
    """Indexable or not, with the reason and, for duplicates, the page to point to."""
    rows = identity.duplicate_primary(parts.withColumn("category", F.col(category)), slug=slug)
    reason = (
        F.when(gates.is_unknown_category("category"), "UNKNOWN_CATEGORY").when(~nonblank("mpn"), "NO_MPN")
        .when(gates.synthetic_reason(F.trim("mpn")) != "", "SYNTHETIC_MPN").otherwise("INDEX"))
    duplicate = (F.col("group_size") > 1) & (F.col("primary_slug") != F.col(slug))
    return rows.withColumn("reason", F.when(duplicate, "DUPLICATE").otherwise(reason)).withColumn(
        "indexable", F.col("reason") == "INDEX").withColumn("canonical_to", F.when(duplicate, F.col("primary_slug")).otherwise(""))


def policy_counts(policy: DataFrame) -> DataFrame:
    return policy.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def prune_urls(urls: DataFrame, policy: DataFrame, static: DataFrame, slug: str = "slug") -> DataFrame:
    """URL list without pages that are not indexed, completed by the static pages.

    ``urls`` and ``static``: ``url`` and ``slug`` (blank for static pages). A page is dropped only
    if none of its rows is indexable.
    """
    state = policy.groupBy(F.col(slug).alias("_s")).agg(F.max(F.col("indexable").cast("int")).alias("_i"))
    kept = urls.join(state.where("_i = 0"), F.col("slug") == F.col("_s"), "left_anti").select("url", "slug")
    return kept.unionByName(static.select("url", "slug")).dropDuplicates(["url"])


def policy_violations(urls: DataFrame, policy: DataFrame, slug: str = "slug") -> DataFrame:
    """U3 gate: listed pages that are not indexed; has to be empty."""
    closed = policy.groupBy(F.col(slug).alias("slug")).agg(F.max(F.col("indexable").cast("int")).alias("_i")).where("_i = 0").select("slug")
    return urls.select("slug").where("slug <> ''").intersect(closed)


# ---- publish normalisation (B11) ----------------------------------------------------------------

def publish_normalize(df: DataFrame, votes: DataFrame, value_votes: DataFrame | None = None, attributes: str = "attributes_json", key: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Attribute keys and values in English, remaining CJK counted, tiers counted.

    ``votes`` (key, value) is the majority translation of source names (A12), ``value_votes`` that
    of whole values. Returns (long table key, name, value, tiers; per-tier counts).
    """
    d = literal_map(rules.table("attribute_dictionary"))
    pairs = df.select(F.col(key).alias("row"), F.explode(F.map_entries(attrs.json_map(attributes))).alias("e")).select(
        "row", F.col("e.key").alias("src"), F.col("e.value").alias("raw"))
    v = votes.select(F.col("key").alias("_vk"), F.col("value").alias("_vv"))
    j = pairs.join(v, F.col("src") == F.col("_vk"), "left").withColumn("_v", tx.translate_value("raw"))
    residual = tx.has_cjk("_v")
    whole = F.lit(None).cast("string")
    if value_votes is not None:
        w = value_votes.select(F.col("key").alias("_wk"), F.col("value").alias("_wv"))
        j = j.join(w, F.col("raw") == F.col("_wk"), "left")
        whole = F.col("_wv")
    out = j.select(
        "row", "src", F.coalesce(d[F.col("src")], F.col("_vv"), F.col("src")).alias("name"),
        F.when(d[F.col("src")].isNotNull(), "dictionary").when(F.col("_vv").isNotNull(), "majority").otherwise("untranslated").alias("key_tier"),
        F.when(residual & whole.isNotNull(), whole).otherwise(F.col("_v")).alias("value"),
        F.when(~residual, "rules").when(whole.isNotNull(), "majority").otherwise("untranslated").alias("value_tier"))
    tiers = out.groupBy("key_tier", "value_tier").agg(F.count(F.lit(1)).alias("n"))
    return out, tiers


# ---- subcategory pages (B16) -----------------------------------------------------------------------

PAGE_SIZE = 50
INDEX_MIN = 10


def subcategory_pages(parts: DataFrame, tops: DataFrame, allow: Sequence[str] = (), size: int = PAGE_SIZE) -> dict[str, DataFrame]:
    """Groups with gate and index decision, part positions on pages, makers and siblings.

    ``parts``: top, final_slug, final_subcategory, mpn, manufacturer, ord.
    """
    groups = aggregates.fine_groups(parts).withColumn("slug", F.col("final_slug"))
    gated = gates.publish_gate(groups, tops, allow)
    kept = gated.where("skip_reason = ''").withColumn("indexed", F.col("n") >= INDEX_MIN)
    live = parts.join(kept.select(F.col("top").alias("_t"), F.col("final_slug").alias("_f")), (F.col("top") == F.col("_t")) & (F.col("final_slug") == F.col("_f")), "left_semi")
    return {
        "groups": kept, "skipped": gated.where("skip_reason <> ''"),
        "pages": paginate(live, ["top", "final_slug"], ["mpn", "ord"], size),
        "makers": aggregates.top_values(live, ["top", "final_slug"], "manufacturer"),
        "siblings": aggregates.siblings(kept.select("top", "slug", "n")),
    }


# ---- page records (B18) ------------------------------------------------------------------------------

def title_family(l1, subcategory) -> Column:
    family = literal_map(rules.table("title_family"))
    return F.when(F.lower(text(subcategory)).contains("mosfet"), "MOSFET").otherwise(F.coalesce(family[F.lower(text(l1))], F.lit("Other")))


def page_title(mpn, maker, attributes, l1, subcategory) -> Column:
    """part number, maker and up to three main values."""
    values = attrs.top_attributes(attributes, title_family(l1, subcategory))
    return F.array_join(F.filter(F.concat(F.array(text(mpn), text(maker)), values), lambda x: x != ""), " ")


def page_meta(mpn, maker, subject, attributes, l1, subcategory, alternates: Column, has_document: Column) -> Column:
    """subject line, main values and what the page offers."""
    values = F.array_join(attrs.top_attributes(attributes, title_family(l1, subcategory)), ", ")
    base = F.array_join(F.filter(F.array(text(mpn), text(maker), text(subject)), lambda x: x != ""), " ")
    plural = F.when(alternates == 1, "").otherwise("s")
    extras = F.array_join(F.array_compact(F.array(
        F.when(has_document, F.lit("datasheet")), F.when(alternates > 0, F.concat(alternates.cast("string"), F.lit(" alternative"), plural)), F.lit("specs"))), ", ")
    return F.when(values != "", F.concat(base, F.lit(" — "), values, F.lit("; "), extras, F.lit("."))).otherwise(F.concat(base, F.lit(". "), extras, F.lit(".")))


def page_records(parts: DataFrame, raw: DataFrame, overrides: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Facts of a page in one row: labelled specs, applications, questions, alternates,
    compliance, introduction, title.

    ``parts``: mpn, manufacturer, supplier_reference, url_slug, attributes_json, native_l1,
    subcategory, alternative_parts_detail, datasheet_url. ``raw``: ord, code, product (struct),
    introduction, applications, features. Source facts attach by code only, the first row of a code counts.
    Both are wide; with ``tasks`` they are dealt out by code to so many, so that a task sorts a small share.
    """
    by_code = with_order(raw).withColumn("_code", key_upper("code"))
    coded = parts.withColumn("_c", key_upper("supplier_reference"))
    if tasks:
        by_code, coded = by_code.repartition(tasks, "_code"), coded.repartition(tasks, "_c")
    right = by_code.groupBy("_code").agg(F.min_by(F.struct("product", "introduction", "applications", "features"), "ord").alias("r"))
    rows = coded.join(right, F.col("_c") == F.col("_code"), "left")
    text_attrs = F.coalesce(attrs.attributes_from_any("attributes_json"), attrs.empty_text_map())
    specs = F.transform(F.map_entries(text_attrs), lambda e: F.struct(tx.human_label(e["key"]).alias("label"), units.format_value(e["key"], e["value"]).alias("value")))
    alts = attrs.parse_alternates("alternative_parts_detail")
    intro = tx.repair_mojibake(F.col("r.introduction"), colon=False)
    none = F.array().cast("array<struct<label:string,value:string>>")
    out = rows.select(
        "mpn", "manufacturer", "url_slug", "native_l1", specs.alias("specs"),
        attrs.applications("r.applications").alias("applications"), attrs.feature_bullets("r.features").alias("features"),
        F.when(~tx.has_cjk(intro), F.nullif(intro, F.lit(""))).alias("introduction"),
        attrs.merge_faqs("r.product.faqs")["faqs"].alias("faqs"), alts.alias("alternates"),
        F.when(F.col("r").isNull(), none).otherwise(attrs.compliance(F.col("r.product"))).alias("compliance"),
        F.coalesce(attrs.rohs_badge(F.col("r.product")), F.lit(False)).alias("rohs_badge"),
        F.coalesce(F.col("r.product.isAsianBrand"), F.lit(False)).alias("asian_brand"),
        attrs.key_attributes("r.product.paramVOList", F.col("r.product.productKeyAttributes")).alias("key_attributes"),
        tx.clean_package("r.product.encapStandard").alias("package"), page_title("mpn", "manufacturer", text_attrs, "native_l1", "subcategory").alias("title"),
        F.col("datasheet_url").alias("url"),
        page_meta("mpn", "manufacturer", "subcategory", text_attrs, "native_l1", "subcategory", F.size(alts), nonblank("datasheet_url")).alias("meta"))
    if overrides is None:
        return out
    return identity.override(out, overrides.withColumnRenamed("slug", "url_slug"), "url_slug", "url")


def brand_page_slug(brand) -> Column:
    return slug_hyphen(brand)
