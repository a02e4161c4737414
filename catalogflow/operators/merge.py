"""Brand canonicalisation (J1), offer merge (A1) and the dictionaries built from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow import rules
from catalogflow.functions.keys import key_nospace, literal_map, nonblank, split_multi, text
from catalogflow.functions.text import brand_blob, collapse, short_abbreviation
from catalogflow.operators.ordering import first_occurrence, global_rank

# Columns a later offer may fill when the first one left them blank.
FILL_COLUMNS = (
    "description", "subcategory", "applications", "keywords",
    "faq", "image", "datasheet_url", "availability",
)


def canonicalize_brand(df: DataFrame, alias: DataFrame, brand: str = "manufacturer") -> DataFrame:
    """Look the brand up by its trimmed lower-case form.

    Adds ``brand_canonical`` (the raw brand when unknown) and ``brand_matched``. ``alias`` has
    one row per ``raw`` key. No broadcast is forced: Spark broadcasts the map while its
    measured size is under the session threshold and shuffles it beyond that.
    """
    a = alias.select(F.lower(F.trim("raw")).alias("_raw"), F.col("canonical").alias("_canon"))
    joined = df.withColumn("_b", F.lower(text(brand))).join(a, F.col("_b") == F.col("_raw"), "left")
    return (
        joined.withColumn("brand_canonical", F.coalesce(F.col("_canon"), text(brand)))
        .withColumn("brand_matched", F.col("_canon").isNotNull())
        .drop("_b", "_raw", "_canon")
    )


@dataclass
class Merged:
    groups: DataFrame
    stats: DataFrame
    review: DataFrame


def _ordered_values(rows: DataFrame, value: str) -> DataFrame:
    """Distinct values per key in order of first appearance, as one array.

    Repeats collapse per (key, value) before anything is collected, so the array holds
    distinct values only, however many offers a part has. A place of several fields is
    laid out flat, since comparing structs inside structs takes most of the sort.
    """
    firsts = rows.groupBy("_brand", "_mpn", value).agg(F.min("_at").alias("_at"))
    place = _flat("_at", rows.schema["_at"].dataType)
    entry = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(place)], F.col(value).alias("_v"))
    return firsts.groupBy("_brand", "_mpn").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["_v"]).alias("_values"))


def _flat(name: str, kind: T.DataType) -> list[Column]:
    """The fields of a column at any depth, in their order; a column that is no struct as it is."""
    if not isinstance(kind, T.StructType):
        return [F.col(name)]
    return [c for f in kind.fields for c in _flat(f"{name}.{f.name}", f.dataType)]


def merge_offers(
    df: DataFrame, alias: DataFrame, allowed_keys: DataFrame | None = None, ord: str = "ord", source: str = "source",
    keep: Callable[[DataFrame], DataFrame] = lambda step: step,
) -> Merged:
    """A1: collapse offers by (canonical brand, part number without spaces).

    The first offer is the base row; blank columns are filled by the first offer that has
    them; alternates and sources are unions in order of appearance. ``keep`` may store the
    lists of sources and of alternates, so that the shuffles of one are gone before the next begins.
    """
    rows = canonicalize_brand(df.where(nonblank("mpn")), alias)
    if ord != "ord":
        rows = rows.withColumn("ord", F.col(ord))
    rows = rows.withColumn("_brand", F.col("brand_canonical")).withColumn("_mpn", key_nospace("mpn"))
    rows = rows.withColumn("_source", text(source))

    fills = [c for c in FILL_COLUMNS if c in df.columns]
    base_cols = [c for c in df.columns if c not in fills and c not in ("ord", ord, source)]
    base = F.struct(*[F.col(c) for c in base_cols], F.col("brand_matched"), (text("manufacturer") == "").alias("brand_missing"))

    # Of the rows of a part in which the same columns are filled the first is enough: it is the base row, or the first one with a value, if any of them
    # is. Partial minima are taken inside the map tasks, so whole rows are sorted there and only a few for each part and task are sent.
    filled = F.lit(0)
    for i, c in enumerate(fills):
        filled = filled + F.when(nonblank(c), F.lit(1 << i)).otherwise(F.lit(0))
    row = F.struct("ord", base.alias("_base"), *[F.col(c).alias(f"_f_{c}") for c in fills])
    firsts = rows.withColumn("_filled", filled).groupBy("_brand", "_mpn", "_filled").agg(F.min_by(row, F.col("ord")).alias("_first"), F.count(F.lit(1)).alias("offers"))
    at = F.col("_first.ord")
    heads = firsts.groupBy("_brand", "_mpn").agg(
        F.min(at).alias("ord"),
        F.min_by(F.col("_first._base"), at).alias("_base"),
        F.sum("offers").alias("offers"),
        *[F.min_by(F.col(f"_first._f_{c}"), F.when(F.col("_filled").bitwiseAND(F.lit(1 << i)) != 0, at)).alias(f"_f_{c}") for i, c in enumerate(fills)],
    )
    # sources go another way, with nothing but their place
    sources = keep(_ordered_values(rows.where("_source <> ''").select("_brand", "_mpn", "_source", F.col("ord").alias("_at")), "_source"))
    groups = heads.join(sources, ["_brand", "_mpn"], "left").withColumn("_values", F.coalesce("_values", F.array().cast("array<string>")))
    out = groups.select(
        "_brand", "_mpn", "ord", "offers",
        *[F.col(f"_base.{c}").alias(c) for c in base_cols if c not in ("manufacturer", "brand")],
        F.col("_brand").alias("manufacturer"),
        F.col("_brand").alias("brand"),
        *[F.col(f"_f_{c}").alias(c) for c in fills],
        F.col("_values").alias("sources"),
        F.col("_base.brand_matched").alias("brand_matched"),
        F.col("_base.brand_missing").alias("brand_missing"),
    )

    if "alternative_parts" in df.columns:
        exploded = rows.select(
            "_brand", "_mpn", "ord", F.posexplode(split_multi("alternative_parts")).alias("_p", "_alt")
        ).withColumn("_at", F.struct("ord", "_p"))
        alts = keep(_ordered_values(exploded, "_alt")).withColumnRenamed("_values", "_alts")
        out = (
            out.drop("alternative_parts").join(alts, ["_brand", "_mpn"], "left")
            .withColumn("alternative_parts", F.coalesce(F.array_join("_alts", ";"), F.lit(""))).drop("_alts")
        )
    if "alternative_parts_detail" in df.columns:
        from catalogflow.functions.attrs import parse_alternates

        detail = rows.select(
            "_brand", "_mpn", "ord", F.posexplode(parse_alternates("alternative_parts_detail")).alias("_p", "_d")
        )
        firsts = detail.groupBy("_brand", "_mpn", F.col("_d.mpn").alias("_dm")).agg(
            F.min_by(F.struct(F.struct("ord", "_p").alias("at"), F.col("_d").alias("d")), F.struct("ord", "_p")).alias("x")
        )
        lists = firsts.groupBy("_brand", "_mpn").agg(F.sort_array(F.collect_list("x")).alias("_x"))
        out = (
            out.drop("alternative_parts_detail").join(lists, ["_brand", "_mpn"], "left")
            .withColumn("alternative_parts_detail", F.to_json(F.transform("_x", lambda x: x["d"]))).drop("_x")
        )

    review = _brand_review(out)
    unknown_stats = None
    if "attributes_json" in df.columns:
        unknown, malformed = _attribute_review(rows, allowed_keys)
        per_group = unknown.groupBy("_brand", "_mpn").agg(F.sort_array(F.collect_set("key")).alias("unknown_attr"))
        bad = malformed.groupBy("_brand", "_mpn").agg(F.lit(True).alias("malformed_attributes"))
        out = (
            out.join(per_group, ["_brand", "_mpn"], "left").join(bad, ["_brand", "_mpn"], "left")
            .withColumn("unknown_attr", F.coalesce("unknown_attr", F.array().cast("array<string>")))
            .withColumn("malformed_attributes", F.coalesce("malformed_attributes", F.lit(False)))
        )
        review = review.unionByName(
            unknown.select("mpn", F.col("_brand").alias("brand"), F.lit("unknown_attribute_key").alias("reason"),
                           F.concat(F.lit("key="), F.col("key")).alias("detail"))
        ).unionByName(
            malformed.select("mpn", F.col("_brand").alias("brand"), F.lit("malformed_attributes").alias("reason"),
                             F.lit("attributes_json is not an object").alias("detail"))
        )
        unknown_stats = unknown.agg(F.count(F.lit(1)).alias("attr_unknown"))
        reasons = F.concat(
            F.when(F.col("brand_missing"), F.array(F.lit("missing_manufacturer")))
            .when(~F.col("brand_matched"), F.array(F.lit("unknown_manufacturer")))
            .otherwise(F.array().cast("array<string>")),
            F.transform("unknown_attr", lambda k: F.concat(F.lit("unknown_attr_key="), k)),
            F.when(F.col("malformed_attributes"), F.array(F.lit("malformed_attributes"))).otherwise(F.array().cast("array<string>")),
        )
        out = out.withColumn("review_reasons", reasons).withColumn("needs_review", F.size("review_reasons") > 0)

    stats = rows.agg(
        F.count(F.lit(1)).alias("rows_kept"),
        F.sum(F.when(text("manufacturer") == "", 1).otherwise(0)).alias("brand_missing"),
        F.sum(F.when((text("manufacturer") != "") & ~F.col("brand_matched"), 1).otherwise(0)).alias("brand_unmatched"),
    ).crossJoin(out.agg(F.count(F.lit(1)).alias("groups_out")))  # one row each
    stats = stats.withColumn("merged_dups", F.col("rows_kept") - F.col("groups_out"))
    if unknown_stats is not None:
        stats = stats.crossJoin(unknown_stats)  # one row each
    return Merged(out, stats, review.dropDuplicates(["mpn", "reason", "detail"]))


def _brand_review(groups: DataFrame) -> DataFrame:
    missing = groups.where("brand_missing").select(
        "mpn", "brand", F.lit("missing_manufacturer").alias("reason"), F.lit("empty manufacturer").alias("detail"))
    unknown = groups.where("not brand_matched and not brand_missing").select(
        "mpn", "brand", F.lit("unknown_manufacturer").alias("reason"),
        F.concat(F.lit("raw="), F.col("brand")).alias("detail"))
    return missing.unionByName(unknown)


def _attribute_review(rows: DataFrame, allowed: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Unknown keys (after the alias table) and offers whose attributes are not an object."""
    parsed = rows.withColumn("_v", F.try_parse_json("attributes_json")).withColumn(
        "_kind", F.schema_of_variant("_v"))
    malformed = parsed.where(F.col("_v").isNotNull() & ~F.col("_kind").startswith("OBJECT")).select("_brand", "_mpn", "mpn")
    alias = rules.mapping("attribute_alias")
    alias_map = literal_map(alias.items())
    keys = rows.select("_brand", "_mpn", "mpn", F.explode(F.json_object_keys("attributes_json")).alias("_raw"))
    keys = keys.select("_brand", "_mpn", "mpn", F.coalesce(alias_map[F.lower("_raw")], F.col("_raw")).alias("key")).distinct()
    if allowed is None:
        return keys.limit(0), malformed
    known = allowed.select(F.col("key").alias("_known")).distinct()
    return keys.join(known, F.col("key") == F.col("_known"), "left_anti"), malformed


def union_alternates(a, b) -> Column:
    """Union of two ``;`` lists, order of appearance kept."""
    return F.array_join(F.array_distinct(F.concat(split_multi(a), split_multi(b))), ";")


# ---- dictionaries -------------------------------------------------------------

def brand_key(c) -> Column:
    """Comparison form of a maker's name: lower case, trade mark signs out, single blanks."""
    return collapse(F.regexp_replace(F.lower(text(c)), "[®™]", ""))


def build_dictionary(names: DataFrame, seed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manufacturer dictionary and alias mapping.

    ``names``: ``raw``, ``ord``. ``seed``: ``alias``, ``canonical``, confirmed by people.
    A name matches a seed alias, then a seed canonical name, else it is new. Descriptions in
    the name field are left out. Ids follow the sorted canonical names.
    """
    clean = names.where((text("raw") != "") & ~brand_blob("raw")).withColumn("_k", brand_key("raw"))
    raw = first_occurrence(clean, ["_k"]).select(F.trim("raw").alias("raw"), "_k")
    s_alias = seed.groupBy(brand_key("alias").alias("_ak")).agg(F.min(F.trim("canonical")).alias("_ac"))
    s_canon = seed.groupBy(brand_key("canonical").alias("_ck")).agg(F.min(F.trim("canonical")).alias("_cc"))
    mapped = (
        raw.join(s_alias, F.col("_k") == F.col("_ak"), "left")
        .join(s_canon, F.col("_k") == F.col("_ck"), "left")
        .withColumn("canonical", F.coalesce("_ac", "_cc", "raw"))
        .withColumn("method", F.when(F.col("_ac").isNotNull(), "seed_alias")
                    .when(F.col("_cc").isNotNull(), "seed_canonical").otherwise("new"))
        .select("raw", "canonical", "method")
    )
    seeded = seed.select(F.trim("canonical").alias("canonical"), F.lit(1).alias("_seeded"))
    fresh = mapped.where("method = 'new'").select("canonical", F.lit(0).alias("_seeded"))
    canon = seeded.unionByName(fresh).groupBy("canonical").agg(F.max("_seeded").alias("_seeded"))
    short = short_abbreviation("canonical")
    dictionary = global_rank(canon, ["canonical"], "_r").select(
        F.format_string("MFR-%05d", F.col("_r")).alias("mfr_id"), "canonical",
        F.when(F.col("_seeded") == 1, "active").when(short, "review").otherwise("candidate").alias("status"),
        F.when((F.col("_seeded") == 1) | short, "A").otherwise("B").alias("tier"),
    )
    return dictionary, mapped


def majority_translation(pairs: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Most frequent ASCII translation per key; ties go to the shorter, then to the first in order."""
    counts = (
        pairs.select(text(key).alias("key"), text(value).alias("value"))
        .where((F.col("key") != "") & F.col("value").rlike(r"^[\x00-\x7F]+$"))
        .groupBy("key", "value").agg(F.count(F.lit(1)).alias("votes"))
    )
    w = Window.partitionBy("key").orderBy(F.desc("votes"), F.length("value"), "value")
    return counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("key", "value", "votes")
