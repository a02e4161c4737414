"""Attribute maps, alternates, FAQs and other nested facts.

Attributes travel as map<string, variant>, so numbers stay numbers and text stays text when
the map is written as JSON. Parameter lists are worked on inside the row with higher-order
functions: no explode, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow import rules
from catalogflow.functions import units
from catalogflow.functions.keys import _col, let, literal_map, text
from catalogflow.functions.text import (
    concept, faq_offbrand, faq_platform, has_cjk, has_illegal_text, half_width, normalize_text, plain_words,
    repair_mojibake, translate_key, translate_value,
)
from catalogflow.schemas import ALTERNATE

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
VARIANT_MAP = "map<string,variant>"


def json_map(c) -> Column:
    """Attribute JSON as map<string,string>; bad JSON and non-objects give null."""
    return F.from_json(_col(c), TEXT_MAP)


def variant_map(c) -> Column:
    return F.from_json(_col(c), T.MapType(T.StringType(), T.VariantType()))


def empty_text_map() -> Column:
    return F.create_map().cast("map<string,string>")


def spec_count(c) -> Column:
    """Keys with a value; bad JSON counts as none."""
    filled = F.map_filter(json_map(c), lambda k, v: v.isNotNull() & ~v.isin("", "[]"))
    return F.coalesce(F.size(filled), F.lit(0))


def is_spec_thin(c, minimum: int = 2) -> Column:
    return spec_count(c) < minimum


def unknown_attr_keys(c, allowed: list[str]) -> Column:
    """Keys outside the allow-list, sorted."""
    allow = F.array(*[F.lit(a) for a in allowed]).cast("array<string>")
    return F.sort_array(F.array_except(F.coalesce(F.map_keys(json_map(c)), F.array().cast("array<string>")), allow))


def alias_attribute_keys(c) -> Column:
    """old key names to canonical ones, for validation only. Several old names of one
    key collapse; the last one holds the value."""
    alias = literal_map(rules.table("attribute_alias"))
    entries = F.transform(F.map_entries(_col(c)), lambda e: F.struct(
        F.coalesce(alias[F.lower(e["key"])], e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(keep_last(entries))


def keep_last(entries: Column) -> Column:
    """Entries whose key does not come again later in the array."""
    return let(entries, lambda xs: F.filter(xs, lambda e, i: ~F.exists(
        F.slice(xs, i + 2, F.greatest(F.size(xs) - i - 1, F.lit(0))), lambda later: later["key"] == e["key"])))


def keep_first(entries: Column, key=lambda e: e["key"]) -> Column:
    """Entries whose key was not there earlier in the array."""
    keyed = F.transform(entries, lambda e: F.struct(key(e).alias("k"), e.alias("e")))
    kept = let(keyed, lambda xs: F.filter(xs, lambda x, i: ~F.exists(F.slice(xs, F.lit(1), i), lambda before: before["k"] == x["k"])))
    return F.transform(kept, lambda x: x["e"])


# ---- parameters to attributes (F45, F46) ---------------------------------------

# Keys that describe identity or packaging, not behaviour.
IDENTITY_KEYS = (
    "brand", "manufacturer", "series", "part number", "part status", "packaging", "package",
    "package / case", "supplier device package", "base product number", "rohs", "lead free", "lead-free",
)


def parameter_entries(params) -> Column:
    """One entry per usable parameter: key, canonical flag, quantity, source name."""
    english = literal_map((r[0], r[1]) for r in rules.table("parameter_map"))
    english_kind = literal_map((r[0], r[2]) for r in rules.table("parameter_map"))
    source = literal_map((r[0], r[1]) for r in rules.table("parameter_map_source_language"))
    source_kind = literal_map((r[0], r[2]) for r in rules.table("parameter_map_source_language"))

    def entry(p):
        name_en, name = text(p["paramNameEn"]), text(p["paramName"])
        label = F.when(name_en != "", name_en).otherwise(name)
        canon = F.coalesce(english[label], F.when(name_en == "", source[name]))
        kind = F.coalesce(english_kind[label], F.when(name_en == "", source_kind[name]))
        raw = F.when(F.coalesce(p["paramValueEn"], F.lit("")) != "", p["paramValueEn"]).otherwise(F.coalesce(p["paramValue"], F.lit("")))
        return F.struct(label.alias("label"), canon.alias("canon"), kind.alias("kind"), units.dash_range(raw).alias("raw"))

    def measured(e):
        return let(normalize_text(e["raw"]), lambda folded: _measured(e, folded))

    def _measured(e, folded):
        verbatim = (folded == "-") | folded.contains("@") | units.is_multi_value(folded) | (
            (e["kind"] == "number") & folded.contains("~"))
        # ohms and henries are parsed with the omega sign still in place
        source_text = F.when(e["kind"].isin("resistance", "inductance"), half_width(e["raw"])).otherwise(folded)
        q = F.when(verbatim | e["canon"].isNull(), units.plain(folded)).otherwise(units.parse_kind(source_text, e["kind"]))
        return F.struct(
            F.coalesce(e["canon"], e["label"]).alias("key"), e["canon"].isNotNull().alias("mapped"),
            e["label"].alias("label"), folded.alias("folded"), q.alias("q"))

    base = F.transform(F.coalesce(_col(params), F.array().cast(_params_type())), entry)
    done = F.transform(F.filter(base, lambda e: e["label"] != ""), measured)
    return F.filter(done, lambda e: (e["folded"] != "") & e["q"].isNotNull())


def _params_type() -> str:
    from catalogflow.schemas import PARAMETER
    return T.ArrayType(PARAMETER).simpleString()


def to_variant(q: Column) -> Column:
    return F.when(q["text"].isNotNull(), q["text"].cast("variant")).when(
        q["num"] == F.floor(q["num"]), q["num"].cast("long").cast("variant")).otherwise(q["num"].cast("variant"))


def canonical_attributes(entries) -> Column:
    """canonical key to value, the later parameter overwrites the earlier."""
    hits = F.filter(_col(entries), lambda e: e["mapped"])
    return F.map_from_entries(F.transform(keep_last(hits), lambda e: F.struct(e["key"].alias("key"), to_variant(e["q"]).alias("value"))))


def unmapped_attributes(entries) -> Column:
    """parameters outside the rule table, text kept."""
    rest = F.filter(_col(entries), lambda e: ~e["mapped"])
    return F.map_from_entries(F.transform(keep_last(rest), lambda e: F.struct(e["key"].alias("key"), e["folded"].alias("value"))))


def forward_unmapped(canon, unmapped) -> Column:
    """unmapped specs join the canonical ones unless the key is CJK, an identity key or taken."""
    canon = _col(canon)
    return let(F.map_keys(canon), lambda taken: _forward(canon, taken, unmapped))


def _forward(canon, taken, unmapped) -> Column:
    extra = F.map_filter(_col(unmapped), lambda k, v: (
        (k != "") & (v != "") & ~has_illegal_text(k) & ~F.lower(F.trim(k)).isin(*IDENTITY_KEYS) & ~F.array_contains(taken, k)))
    return F.map_concat(canon, F.map_from_entries(F.transform(F.map_entries(extra), lambda e: F.struct(
        e["key"].alias("key"), e["value"].cast("variant").alias("value")))))


def collisions(entries) -> Column:
    """Canonical keys that two parameters of one part claim (checked before the overwrite)."""
    keys = F.transform(F.filter(_col(entries), lambda e: e["mapped"]), lambda e: e["key"])
    return let(keys, lambda hits: F.sort_array(F.array_distinct(
        F.filter(hits, lambda k, i: F.array_position(hits, k) != i + 1))))


# ---- envelopes (F47-F49) ---------------------------------------------------------

def replay_alternates(items, default_type: str = "Similar") -> Column:
    """supplier list in its own order, entries without a model dropped."""
    kept = F.filter(_col(items), lambda a: text(a["productModel"]) != "")
    return F.transform(kept, lambda a: F.struct(
        text(a["productModel"]).alias("mpn"), text(a["brandNameEn"]).alias("manufacturer"),
        text(a["productCode"]).alias("lcsc"),
        F.when(text(a["type"]) == "", F.lit(default_type)).otherwise(text(a["type"])).alias("type"),
        text(a["encapStandard"]).alias("package")))


def parse_alternates(c) -> Column:
    """stored JSON list, entries without a model dropped, blank type filled."""
    items = F.from_json(_col(c), T.ArrayType(ALTERNATE))
    kept = F.filter(F.coalesce(items, F.array().cast(T.ArrayType(ALTERNATE))), lambda a: text(a["mpn"]) != "")
    return F.transform(kept, lambda a: F.struct(
        text(a["mpn"]).alias("mpn"), text(a["manufacturer"]).alias("manufacturer"), text(a["lcsc"]).alias("lcsc"),
        F.when(text(a["type"]) == "", F.lit("Similar")).otherwise(text(a["type"])).alias("type"),
        text(a["package"]).alias("package")))


def parent_chain(nodes, leaf_name, leaf_id) -> Column:
    """root-to-leaf chain with leaf, parent and depth; null when nothing is known."""
    leaf = F.coalesce(_col(leaf_name), F.lit(""))
    name = lambda n: F.when(F.coalesce(n["catalogNameEn"], F.lit("")) != "", n["catalogNameEn"]).otherwise(F.coalesce(n["catalogName"], F.lit("")))
    up = F.transform(
        F.filter(F.coalesce(_col(nodes), F.array().cast("array<struct<catalogId:bigint,catalogName:string,catalogNameEn:string>>")),
                 lambda n: (name(n) != "") & (name(n) != leaf)),
        lambda n: F.struct(n["catalogId"].alias("id"), name(n).alias("name")))
    end = F.when(leaf != "", F.array(F.struct(_col(leaf_id).cast("long").alias("id"), leaf.alias("name")))).otherwise(
        F.array().cast("array<struct<id:bigint,name:string>>"))
    chain = F.concat(up, end)
    parent = F.try_element_at(chain, F.lit(-2))
    return F.when(F.size(chain) > 0, F.struct(
        F.to_json(chain).alias("parent_chain"), _col(leaf_id).cast("long").alias("leaf_id"), leaf.alias("leaf_name"),
        parent["id"].alias("parent_id"), F.coalesce(parent["name"], F.lit("")).alias("parent_name"),
        F.size(chain).alias("depth")))


def first_image(product) -> Column:
    """First listed picture, else the big one, else the small one."""
    listed = F.filter(F.coalesce(product["productImages"], F.array().cast("array<string>")), lambda u: text(u) != "")
    return F.coalesce(F.trim(F.try_element_at(listed, F.lit(1))),
                      F.nullif(text(product["productImageUrlBig"]), F.lit("")), text(product["productImageUrl"]))


# ---- merging and repair ------------------------------------------------------------

def merge_attributes(old, new) -> Column:
    """curated keys stay; new keys are added unless present in any letter case."""
    old = F.coalesce(_col(old), empty_text_map())
    fresh = keep_first(F.map_entries(_col(new)), lambda e: F.lower(e["key"]))
    return let(F.transform(F.map_keys(old), lambda k: F.lower(k)), lambda have: F.map_concat(
        old, F.map_from_entries(F.filter(fresh, lambda e: ~F.array_contains(have, F.lower(e["key"]))))))


def repair_json_strings(c) -> Column:
    """the symbols are never JSON syntax, so the text is repaired as a whole."""
    return F.when(F.try_parse_json(_col(c)).isNull(), _col(c)).otherwise(repair_mojibake(_col(c)))


def translate_attributes(c) -> Column:
    """dictionary keys and rule-translated values; map<string,string>."""
    entries = F.transform(F.map_entries(json_map(c)), lambda e: F.struct(
        translate_key(e["key"]).alias("key"), translate_value(e["value"]).alias("value")))
    return F.map_from_entries(keep_last(entries))


def residual_count(attrs) -> Column:
    """keys and values that still hold CJK."""
    m = _col(attrs)
    return F.coalesce(F.size(F.filter(F.map_keys(m), lambda k: has_cjk(k))) + F.size(F.filter(F.map_values(m), lambda v: has_cjk(v))), F.lit(0))


def publish_attributes(c) -> Column:
    """F16: pairs that cannot be shown in English are left out; numbers stay numbers."""
    exact = literal_map((r[0], r[1]) for r in rules.table("value_translation") if len(r) > 1 and r[1])
    m = variant_map(c)
    entries = F.transform(F.map_entries(m), lambda e: F.struct(
        translate_key(F.trim(e["key"])).alias("key"),
        F.when(F.schema_of_variant(e["value"]) != "STRING", e["value"])
        .when(~has_cjk(e["value"].cast("string")), F.trim(e["value"].cast("string")).cast("variant"))
        .otherwise(exact[F.trim(e["value"].cast("string"))].cast("variant")).alias("value")))
    return F.map_from_entries(keep_last(F.filter(entries, lambda e: ~has_cjk(e["key"]) & e["value"].isNotNull())))


def attributes_from_any(c) -> Column:
    """object form, list of {k, v} objects or list of pairs, as map<string,string>."""
    pairs = F.from_json(_col(c), T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])))
    lists = F.from_json(_col(c), T.ArrayType(T.ArrayType(T.StringType())))
    as_pairs = F.transform(pairs, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value")))
    as_lists = F.transform(F.filter(lists, lambda p: F.size(p) > 0), lambda p: F.struct(
        p[0].alias("key"), F.coalesce(F.get(p, F.lit(1)), F.lit("")).alias("value")))
    named = lambda xs: F.map_from_entries(keep_last(F.filter(xs, lambda e: e["key"].isNotNull())))
    s = text(c)
    return F.coalesce(
        F.when(s.startswith("{"), json_map(c)),
        F.when(s.rlike(r"^\[\s*\{"), named(as_pairs)),
        F.when(s.rlike(r"^\[\s*\["), named(as_lists)),
        empty_text_map())


def key_attributes(params, given=None) -> Column:
    """``Name: Value`` lines of the main parameters (all when none is main), by sort
    number then position, first of each name. A text given by the source comes first."""
    usable = F.filter(F.transform(_col(params), lambda p, i: F.struct(
        F.coalesce(p["sort"], F.lit(0)).alias("sort"), i.alias("pos"), (F.coalesce(p["isMain"], F.lit(False))).alias("main"),
        text(p["paramNameEn"]).alias("name"), text(p["paramValueEn"]).alias("value"))),
        lambda p: (p["name"] != "") & ~p["value"].isin("", "-"))
    main = F.filter(usable, lambda p: p["main"])
    chosen = F.sort_array(F.when(F.size(main) > 0, main).otherwise(usable))
    lines = F.transform(keep_first(chosen, lambda p: p["name"]), lambda p: F.concat(p["name"], F.lit(": "), p["value"]))
    built = F.nullif(F.array_join(lines, "\n"), F.lit(""))
    return built if given is None else F.coalesce(F.nullif(text(given), F.lit("")), built)


def applications(c) -> Column:
    """one entry per line, bullets stripped."""
    lines = F.filter(F.split(F.coalesce(_col(c), F.lit("")), r"\r?\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, lambda x: F.regexp_replace(x, r"^[ \-•\t]+|[ \-•\t]+$", ""))


def feature_bullets(c) -> Column:
    """lines without bullets, lines with CJK (after repair) dropped."""
    lines = F.transform(F.filter(F.split(F.coalesce(_col(c), F.lit("")), r"\r?\n"), lambda x: F.trim(x) != ""),
                        lambda x: F.trim(F.regexp_replace(F.trim(x), r"^[-•* ]+", "")))
    return F.filter(lines, lambda x: ~has_cjk(repair_mojibake(x, colon=False)))


# Countries in the order the compliance table lists them.
HTS_ORDER = ("CN", "US", "TARIC", "CA", "BR", "IN", "MX")


def compliance(product) -> Column:
    """(label, value) rows: RoHS with evidence, ECCN, HTS by country."""
    row = lambda label, value: F.struct(label.alias("label"), value.alias("value"))
    none = F.array().cast("array<struct<label:string,value:string>>")
    rohs = F.when(product["isRohsCert"], F.array(row(F.lit("RoHS"), F.coalesce(F.nullif(text(product["rohsCertType"]), F.lit("")), F.lit("Compliant")))))
    eccn = F.when(~text(product["eccn"]).isin("", "-"), F.array(row(F.lit("ECCN"), text(product["eccn"]))))
    rank = F.create_map(*[F.lit(x) for i, c in enumerate(HTS_ORDER) for x in (c, i)])
    filled = F.map_entries(F.map_filter(product["htsMap"], lambda k, v: F.coalesce(v, F.lit("")) != ""))
    ordered = F.sort_array(F.transform(filled, lambda e: F.struct(
        F.coalesce(rank[e["key"]], F.lit(len(HTS_ORDER))).alias("o"), e["key"].alias("code"), F.trim(e["value"]).alias("v"))))
    hts = F.transform(ordered, lambda e: row(F.when(e["code"] == "TARIC", F.lit("TARIC")).otherwise(F.concat(e["code"], F.lit("HTS"))), e["v"]))
    return F.concat(F.coalesce(rohs, none), F.coalesce(eccn, none), F.coalesce(hts, none))


def rohs_badge(product) -> Column:
    """certified and with a certificate type as evidence."""
    return F.coalesce(product["isRohsCert"], F.lit(False)) & (text(product["rohsCertType"]) != "")


def merge_faqs(raw, curated=None, verified=None, limit: int = 3) -> Column:
    """source questions (curated ones only for verified parts without any), commerce
    and competitor entries out, repeated questions out, at most ``limit`` (O7).

    Returns struct<faqs, n_source, offbrand, platform, repeated, truncated>.
    """
    none = F.array().cast("array<struct<question:string,answer:string>>")
    source = F.coalesce(_col(raw), none)

    def screen(xs):
        off = lambda f: faq_offbrand(f["question"]) | faq_offbrand(f["answer"])
        on_brand = F.filter(xs, lambda f: ~off(f))
        clean = F.filter(on_brand, lambda f: ~faq_platform(f["question"], f["answer"]))
        unique = keep_first(clean, lambda f: plain_words(f["question"]))
        return on_brand, clean, unique

    on_brand, clean, unique = screen(source)
    final = unique
    if curated is not None:
        _, _, extra = screen(_col(curated))
        final = F.when((F.size(unique) == 0) & F.coalesce(_col(verified), F.lit(False)), extra).otherwise(unique)
    counted = F.struct(source.alias("s"), on_brand.alias("o"), clean.alias("c"), unique.alias("u"), final.alias("f"))
    return let(counted, lambda x: F.struct(
        F.slice(x["f"], 1, limit).alias("faqs"), F.size(x["s"]).alias("n_source"),
        (F.size(x["s"]) - F.size(x["o"])).alias("offbrand"), (F.size(x["o"]) - F.size(x["c"])).alias("platform"),
        (F.size(x["c"]) - F.size(x["u"])).alias("repeated"), F.greatest(F.size(x["f"]) - limit, F.lit(0)).alias("truncated")))


def top_faqs(faqs, n: int = 3) -> Column:
    return F.slice(_col(faqs), 1, n)


def merge_enrichment(specs, extra) -> Column:
    """extra specs whose concept the part already has are skipped."""
    specs = _col(specs)
    fresh = keep_first(F.map_entries(_col(extra)), lambda e: concept(e["key"]))
    return let(F.transform(F.map_keys(specs), concept), lambda have: F.map_concat(
        specs, F.map_from_entries(F.filter(fresh, lambda e: ~F.array_contains(have, concept(e["key"]))))))


def merge_lines(old, extra) -> Column:
    """applications by normalised text."""
    return keep_first(F.concat(_col(old), _col(extra)), plain_words)


# ---- selection for titles (O6) ------------------------------------------------------

def top_attributes(attrs, family, n: int = 3) -> Column:
    """Display values of the first ``n`` filled slots of the family.

    A key used by one slot is not used again; values are cut at the first ``;`` or ``,`` and
    at 16 characters; CJK values are passed over.
    """
    m, fam = _col(attrs), _col(family)
    by_family: dict[str, list[str]] = {}
    for name, slot in rules.table("title_slots"):
        by_family.setdefault(name, []).append(slot)
    slots = lambda name: F.array(*[F.array(*[F.lit(k) for k in s.split("|")]) for s in by_family[name]])
    chosen = slots("Other")
    for name in by_family:
        if name != "Other":
            chosen = F.when(fam == name, slots(name)).otherwise(chosen)

    usable = F.map_filter(m, lambda k, v: (text(v) != "") & ~has_cjk(v))
    shown = F.transform_values(usable, lambda k, v: F.rtrim(F.substring(F.trim(units.title_value(
        k, F.trim(F.substring_index(F.substring_index(v, ";", 1), ",", 1)))), 1, 16)))
    shown = F.map_filter(shown, lambda k, v: F.coalesce(v, F.lit("")) != "")
    return F.when(m.isNull(), F.array().cast("array<string>")).otherwise(
        let(shown, lambda ready: F.slice(_fill_slots(chosen, ready), 1, n)))


def _fill_slots(chosen, shown) -> Column:
    start = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast("array<string>").alias("out"))

    def step(acc, slot):
        key = F.try_element_at(F.filter(slot, lambda k: F.map_contains_key(shown, k) & ~F.array_contains(acc["used"], k)), F.lit(1))
        return F.when(key.isNull(), acc).otherwise(F.struct(
            F.array_append(acc["used"], key).alias("used"), F.array_append(acc["out"], shown[key]).alias("out")))

    return F.aggregate(chosen, start, step)["out"]


# ---- keys kept aside (P20, P21, P27) -------------------------------------------------

# Real-time fields, internal fields, and fields a published record may not carry.
VOLATILE_KEYS = (
    "stockNumber", "stockSz", "domesticStockVO", "overseasStockVO", "wmStockHk",
    "productPriceList", "productLadderPrice", "reelPrice", "ladderDiscountRate",
    "isRealPrice", "isShowForeignPrice", "isForeignOnsale", "isForeignDisplay",
    "hasThirdPartyStock", "flashSaleProductPO",
)
INTERNAL_KEYS = (
    "productCostPricePO", "activityPO", "szlcscActivityPO", "warehouseCode",
    "productBatchCode", "costPrice", "purchasePrice", "productCostPrice",
    "supplierCost", "productPricePO", "profitRate", "grossProfit", "costPricePO",
)
FORBIDDEN_KEYS = (
    "warehouseCode", "productBatchCode", "cost", "purchasePrice", "profit",
    "grossProfit", "supplierCost", "activityPO", "szlcscActivityPO",
    "dollarLadderPrice", "foreignWeight", "real_time_snapshot", "internal_raw",
    "authenticationList", "edaSvgInfo", "flashSaleProductPO", "productWeight",
)


def isolate_keys(c, forbidden=INTERNAL_KEYS) -> Column:
    """P20, one level: struct<public, isolated> of a map."""
    m = _col(c)
    return F.struct(
        F.map_filter(m, lambda k, v: ~k.isin(*forbidden)).alias("public"),
        F.map_filter(m, lambda k, v: k.isin(*forbidden)).alias("isolated"))


def leaked_keys(c, forbidden=FORBIDDEN_KEYS) -> Column:
    """Forbidden keys anywhere in the JSON text, whatever the depth."""
    names = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(r'"((?:[^"\\]|\\.)*)"\s*:'), F.lit(1))
    return F.sort_array(F.array_intersect(F.array_distinct(names), F.array(*[F.lit(k) for k in forbidden])))


def split_volatile(c, volatile=VOLATILE_KEYS) -> Column:
    """Price and stock facts apart from stable ones."""
    m = _col(c)
    return F.struct(
        F.map_filter(m, lambda k, v: ~k.isin(*volatile)).alias("stable"),
        F.map_filter(m, lambda k, v: k.isin(*volatile)).alias("volatile"))


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)
