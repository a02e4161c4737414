"""Reports and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow import rules
from catalogflow.functions.keys import _col, literal_map, nonblank, slug_category, text
from catalogflow.operators.ordering import first_occurrence, global_rank, last_occurrence, top_per_group
from catalogflow.session import cut

# Parts of one category name from which a unit stands on its own, or is merged.
DIRECT_MIN, MERGE_MIN = 5, 2


# ---- fine classification (A10, A11) ------------------------------------------------

def fine_units(parts: DataFrame, review: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A10: classify category names into units and map every part to its final unit.

    ``parts``: ``sr``, ``native_l1``, ``category``, ``parent``, ``ord``. ``review``: ``category``,
    ``parent``, ``native_l1`` for names that occur under several level-1 slugs. Returns
    (units, part map). Of several rows of a code (``sr``) the last counts, in the place of the first. Counts are
    partial sums; a unit is one row however many parts it has.
    """
    per_code = parts.groupBy(text("sr").alias("sr")).agg(F.max_by(F.struct("native_l1", "category", "parent"), "ord").alias("x"), F.min("ord").alias("ord"))
    known = per_code.where(nonblank("x.category")).select("sr", text("x.native_l1").alias("own_l1"), F.col("x.category").alias("cat"), F.col("x.parent").alias("par"), "ord")
    per_cat = known.groupBy("cat").agg(F.count(F.lit(1)).alias("n"), F.min("own_l1").alias("_lo"), F.max("own_l1").alias("_hi"))
    cls = F.when(F.col("_lo") != F.col("_hi"), "REVIEW").when(F.col("n") >= DIRECT_MIN, "DIRECT").when(F.col("n") >= MERGE_MIN, "MERGE").otherwise("EXCLUDE")
    classed = known.join(per_cat.withColumn("cls", cls).select("cat", "cls"), "cat")
    if review is not None:
        r = review.groupBy(F.col("category").alias("_rc"), F.col("parent").alias("_rp")).agg(F.min("native_l1").alias("_rl"))
        classed = classed.join(r, (F.col("cat") == F.col("_rc")) & (F.col("par") == F.col("_rp")), "left")
        l1 = F.when(F.col("cls") == "REVIEW", F.coalesce("_rl", "own_l1")).otherwise(F.col("own_l1"))
    else:
        l1 = F.col("own_l1")
    classed = classed.withColumn("l1", l1)
    units = classed.groupBy("l1", "cat").agg(F.count(F.lit(1)).alias("sku"), F.min("ord").alias("first"), F.max("cls").alias("cls"))

    key = F.concat_ws("\t", "l1", "cat")
    merge = literal_map((f"{r[0]}\t{r[1]}", r[2]) for r in rules.table("merge_target") if r[2] != "NO_SAFE_TARGET")
    larger = literal_map((f"{r[0]}\t{r[1]}", r[2]) for r in rules.table("candidate_merge_target"))
    target = F.when(F.col("cls").isin("DIRECT", "REVIEW"), larger[key]).when(F.col("cls") == "MERGE", merge[key])
    units = units.withColumn("target", target).withColumn("action", F.when(F.col("target").isNotNull(), "MERGE").otherwise("BUILD"))
    units = _unit_slugs(units)

    # The target unit: same level-1 slug first, else the first seen unit of that name.
    cand = units.select(F.col("l1").alias("t_l1"), F.col("cat").alias("t_cat"), F.col("first").alias("t_first"), F.col("slug").alias("t_slug"))
    merging = units.where("action = 'MERGE'").join(cand, F.col("target") == F.col("t_cat"), "left")
    w = Window.partitionBy("l1", "cat").orderBy(F.when(F.col("t_l1") == F.col("l1"), 0).otherwise(1), "t_first")
    picked = merging.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("l1", "cat", "t_l1", "t_slug")
    full = units.join(picked, ["l1", "cat"], "left")
    is_merge = F.col("action") == "MERGE"
    full = (
        full.withColumn("final_subcategory", F.when(is_merge, F.col("target")).otherwise(F.col("cat")))
        .withColumn("final_slug", F.when(is_merge, F.col("t_slug")).otherwise(F.col("slug")))
        .withColumn("final_native_l1", F.when(is_merge, F.coalesce("t_l1", "l1")).otherwise(F.col("l1")))
    )
    moved = full.where(is_merge & F.col("t_l1").isNotNull()).groupBy(F.col("t_l1").alias("_ml"), F.col("target").alias("_mc")).agg(F.sum("sku").alias("_in"))
    full = full.join(moved, (F.col("l1") == F.col("_ml")) & (F.col("cat") == F.col("_mc")), "left").withColumn(
        "page_sku", F.col("sku") + F.coalesce("_in", F.lit(0))).drop("_ml", "_mc", "_in", "t_l1", "t_slug")
    mapping = classed.select("sr", "l1", "cat").join(
        full.select("l1", "cat", "final_subcategory", "final_slug", "final_native_l1"), ["l1", "cat"]).drop("l1", "cat")
    return full, mapping


def _unit_slugs(units: DataFrame) -> DataFrame:
    """Slug of a unit: its name; name and level-1 slug when an earlier unit has that slug; else the name with the
    number of different slugs so far and one, whether or not that one is free.

    Units come in the order of (level-1 slug, name). Every unit claims its first choice; a claim loses when an earlier
    unit claims the same slug, and the loser goes on to its next choice. A slug that an earlier unit claims is
    never free again, only handed to a still earlier one, so claims that stand when none loses are those of a one-by-one run.
    The number is the unit's rank less the repeated slugs before it. Those are known only when the slugs are, so the claims are
    settled again until the repeated slugs no longer change; each time at least the next one in order is right.
    """
    ranked = cut(global_rank(units, ["l1", "cat"], "_rank").withColumns({
        "_s": F.coalesce(slug_category("cat"), F.lit("")), "_b": F.coalesce(slug_category(F.concat_ws(" ", "cat", "l1")), F.lit("")), "_repeated": F.lit(0)}))
    while True:
        settled = _claimed_slugs(_with_number(ranked))
        marked = cut(settled.withColumn("_again", (F.col("_rank") != F.col("_holder")).cast("int")))
        if marked.where("_again <> _repeated").isEmpty():
            return marked.withColumnRenamed("_slug", "slug").drop("_rank", "_s", "_b", "_number", "_choice", "_holder", "_repeated", "_again")
        ranked = marked.withColumn("_repeated", F.col("_again")).drop("_number", "_choice", "_slug", "_holder", "_again")


_STRETCH = 4096  # ranks whose repeated slugs are counted in one task


def _with_number(ranked: DataFrame) -> DataFrame:
    """``_number``: the rank less the rows before it with ``_repeated``; a running sum in stretches of ranks and one over the stretches."""
    stretch = F.floor(F.col("_rank") / _STRETCH)
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # one row for thousands of units
    offsets = ranked.groupBy(stretch.alias("_at")).agg(F.sum("_repeated").alias("_n")).select("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy("_at").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    joined = ranked.withColumn("_at", stretch).join(offsets, "_at")
    return joined.withColumn("_number", F.col("_rank") - F.col("_off") - F.coalesce(F.sum("_repeated").over(own), F.lit(0))).drop("_at", "_off")


def _claimed_slugs(units: DataFrame) -> DataFrame:
    """``_slug`` and ``_holder``, the rank of the first unit with that slug, when no claim loses any more."""
    state = cut(units.withColumn("_choice", F.lit(1)))
    while True:
        name = F.when(F.col("_choice") == 1, F.col("_s")).when(F.col("_choice") == 2, F.col("_b")).otherwise(F.concat_ws("-", "_s", F.col("_number").cast("string")))
        claims = state.withColumn("_slug", name)
        first = claims.groupBy("_slug").agg(F.min("_rank").alias("_holder"))
        met = cut(claims.join(first, "_slug"))
        lost = (F.col("_choice") < 3) & (F.col("_holder") < F.col("_rank"))
        if met.where(lost).isEmpty():
            return met
        state = met.withColumn("_choice", F.col("_choice") + lost.cast("int")).drop("_slug", "_holder")


def final_map(parts: DataFrame, mapping: DataFrame, mpn: str = "mpn", sr: str = "sr", ord: str = "ord") -> DataFrame:
    """Final fields per part number; the last row of a part number decides."""
    last = last_occurrence(parts.where(nonblank(mpn)), [mpn], ord).select(F.col(mpn).alias("mpn"), text(sr).alias("sr"))
    return last.join(mapping, "sr").where("final_subcategory is not null").select("mpn", "final_subcategory", "final_native_l1", "final_slug")


def attach_final(df: DataFrame, final: DataFrame, mpn: str = "mpn") -> DataFrame:
    """Parts without a final unit keep null fields, which JSON leaves out."""
    f = final.withColumnRenamed("mpn", "_fm")
    return df.join(f, F.trim(mpn) == F.col("_fm"), "left").drop("_fm")


# ---- catalog counts (A13-A15, A36, O2-O4, O9) -----------------------------------------

def catalog_counts(df: DataFrame, top: str = "top", sub: str = "native_l1") -> DataFrame:
    """Parts per top and level-1 slug, unmapped ones left out."""
    return df.where(F.col(top) != "__UNMAPPED__").groupBy(F.col(top).alias("top"), F.col(sub).alias("sub")).agg(F.count(F.lit(1)).alias("n"))


def catalog_rollup(df: DataFrame, top: str = "top", sub: str = "native_l1") -> DataFrame:
    """A13 with subtotals; the flags tell a subtotal from a blank value."""
    named = df.where(F.col(top) != "__UNMAPPED__").select(F.col(top).alias("top"), F.col(sub).alias("sub"))
    return named.rollup("top", "sub").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("top").alias("is_total"), F.grouping("sub").alias("is_subtotal"))


def facet_counts(df: DataFrame, top: str = "top", sub: str = "sub", maker: str = "manufacturer") -> tuple[DataFrame, DataFrame]:
    """Makers with counts; tops with counts and their subcategories nested."""
    makers = df.groupBy(F.col(maker).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    subs = df.groupBy(F.col(top).alias("top"), F.col(sub).alias("sub")).agg(F.count(F.lit(1)).alias("n"))
    tops = subs.groupBy("top").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.lower("sub").alias("o"), F.col("sub").alias("name"), F.col("n").alias("n")))).alias("s"))
    return makers, tops.select("top", "n", F.transform("s", lambda x: F.struct(x["name"].alias("name"), x["n"].alias("n"))).alias("subcategories"))


def fine_groups(df: DataFrame) -> DataFrame:
    """Parts per (top, final slug); parts without a final unit left out."""
    return df.where(nonblank("final_slug")).groupBy("top", "final_slug").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("final_subcategory", "ord").alias("name"), F.min("ord").alias("first"))


def merged_facets(coarse: DataFrame, fine: DataFrame, pages: DataFrame) -> DataFrame:
    """Coarse and fine subcategories on one slug: the fine count wins, a slug is listed
    once, only existing pages are linked, a subcategory named like its top stays without link."""
    c = coarse.select(F.col("top").alias("ct"), F.col("slug").alias("cs"), F.col("n").alias("cn"))
    f = fine.select(F.col("top").alias("ft"), F.col("slug").alias("fs"), F.col("n").alias("fn"))
    both = c.join(f, (F.col("ct") == F.col("ft")) & (F.col("cs") == F.col("fs")), "full_outer").select(
        F.coalesce("ct", "ft").alias("top"), F.coalesce("cs", "fs").alias("slug"), F.coalesce("fn", "cn").alias("n"))
    p = pages.select(F.col("slug").alias("_p")).distinct()
    rows = both.join(p, F.col("slug") == F.col("_p"), "left")
    own = F.col("slug") == F.col("top")
    return rows.where(F.col("_p").isNotNull() | own).withColumn("linked", F.col("_p").isNotNull() & ~own).drop("_p")


def top_values(df: DataFrame, group: Sequence[str], value: str, k: int = 8, ord: str = "ord", allowed: DataFrame | None = None) -> DataFrame:
    """O2: most frequent values of a group; ties go to the one seen first."""
    rows = df if allowed is None else df.join(allowed.select(F.col(value).alias("_a")).distinct(), F.col(value) == F.col("_a"), "left_semi")
    counts = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), F.min(ord).alias("first"))
    return top_per_group(counts, group, [F.desc("n"), "first"], k).drop("first")


def siblings(groups: DataFrame, top: str = "top", slug: str = "slug", k: int = 8) -> DataFrame:
    """O3: other subcategories of the same top, larger ones first.

    Only the first k+1 of a top can be among anyone's first k, so the self join meets at most
    that many rows per subcategory.
    """
    leaders = top_per_group(groups, [top], [F.desc("n"), slug], k + 1, "_p").select(
        F.col(top).alias("_t"), F.col(slug).alias("sibling"), "_p")
    met = groups.select(top, slug).join(leaders, F.col(top) == F.col("_t")).where(F.col(slug) != F.col("sibling"))
    w = Window.partitionBy(top, slug).orderBy("_p")
    return met.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k).select(top, slug, "sibling", "pos")


def subcategory_order(groups: DataFrame) -> DataFrame:
    """O4."""
    return groups.orderBy(F.desc("n"), F.asc("slug"))


def representatives(parts: DataFrame, top: str = "top", sub: str = "sub", mpn: str = "mpn", k: int = 8) -> DataFrame:
    """One part per subcategory (lowest part number), subcategories by size, at most ``k`` per top."""
    per = parts.where(nonblank(mpn)).groupBy(top, sub).agg(F.count(F.lit(1)).alias("n"), F.min(mpn).alias("mpn"))
    return top_per_group(per, [top], [F.desc("n"), sub], k)


# ---- coverage and quality (A16-A18, A28, A31, A33, A34) ---------------------------------

def key_coverage(df: DataFrame, attributes: str = "attributes_json") -> DataFrame:
    """Attribute key and the number of rows that carry it (a key counts once per row)."""
    return df.select(F.explode(F.array_distinct(F.json_object_keys(attributes))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


def coverage_totals(df: DataFrame, attributes: str = "attributes_json", unmapped: str | None = None) -> DataFrame:
    """Rows, rows with at least one key, total of unmapped keys."""
    n = F.coalesce(F.size(F.json_object_keys(attributes)), F.lit(0))
    u = F.coalesce(F.size(F.json_object_keys(unmapped)), F.lit(0)) if unmapped else F.lit(0)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.when(n > 0, 1).otherwise(0)).alias("rows_with_keys"), F.sum(u).alias("unmapped_keys"))


def fill_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-blank count and share per column, in one pass over the rows."""
    filled = [F.sum(F.when(nonblank(F.col(c).cast("string")), 1).otherwise(0)).alias(c) for c in cols]
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *filled)
    return wide.unpivot(["_total"], list(cols), "column", "filled").select(
        "column", "filled", F.round(F.try_divide(F.col("filled"), F.col("_total")), 6).alias("share"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """A18."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def quality_stats(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows, distinct non-blank values and blanks per column.

    Exact distinct counts expand the rows once per column; ``approximate`` keeps one pass for
    very large inputs.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    s = [text(F.col(c).cast("string")) for c in cols]
    aggs = []
    for c, v in zip(cols, s):
        aggs += [distinct(F.nullif(v, F.lit(""))).alias(f"{c}__d"), F.sum(F.when(v == "", 1).otherwise(0)).alias(f"{c}__b")]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__d").alias("distinct_values"), F.col(f"{c}__b").alias("blanks")) for c in cols])
    return wide.select("rows", F.explode(items).alias("x")).select("x.column", "rows", "x.distinct_values", "x.blanks")


def metric_delta(a: DataFrame, b: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    """Two runs side by side with the difference."""
    l = a.select(F.col(key).alias("_a"), F.col(value).alias("run_a"))
    r = b.select(F.col(key).alias("_b"), F.col(value).alias("run_b"))
    return l.join(r, F.col("_a") == F.col("_b"), "full_outer").select(
        F.coalesce("_a", "_b").alias(key), "run_a", "run_b",
        (F.coalesce("run_b", F.lit(0)) - F.coalesce("run_a", F.lit(0))).alias("delta"))


def reclassified(a: DataFrame, b: DataFrame, key: str, label: str) -> DataFrame:
    """Rows whose label changed between two runs."""
    r = b.select(F.col(key).alias("_k"), F.col(label).alias("after"))
    return a.join(r, F.col(key) == F.col("_k")).where(~F.col(label).eqNullSafe(F.col("after"))).select(key, F.col(label).alias("before"), "after")


def pool_stats(df: DataFrame, stage: str = "stage", batch: str = "batch_id") -> DataFrame:
    """Batches and records per stage."""
    return df.groupBy(stage).agg(F.countDistinct(batch).alias("batches"), F.count(F.lit(1)).alias("records"))


def coverage_summary(matched: DataFrame) -> DataFrame:
    """Preserved, mapped, missing, share covered and parts per method, one row."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    m = F.col("method")
    return matched.agg(
        F.count(F.lit(1)).alias("total"), n(m == "preserved").alias("preserved"), n(~m.isin("preserved", "missing")).alias("mapped"),
        n(m == "missing").alias("missing"), *[n(m == x).alias(f"by_{x}") for x in ("cid", "mpn", "alnum_mpn", "clean_mpn")],
    ).withColumn("coverage_pct", F.round(F.try_divide((F.col("preserved") + F.col("mapped")) * 100.0, F.col("total")), 1))


# ---- content (A25) and fingerprints (A26, A27) ---------------------------------------------

def content_duplicates(docs: DataFrame, content: Column, key: str) -> DataFrame:
    """Hash, number of documents that share it, first and last key."""
    return docs.groupBy(F.sha2(content, 256).alias("sha256")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")).where("n > 1")


def key_collisions(docs: DataFrame, key: Column, name: str) -> DataFrame:
    """Stems, ids or normalised keys that several documents share."""
    return docs.groupBy(key.alias("key")).agg(F.countDistinct(name).alias("n"), F.min(name).alias("first"), F.max(name).alias("last")).where("n > 1 and key <> ''")


def row_fingerprint(cols: Sequence, sep: str = "|") -> Column:
    """SHA-256 of a row's columns, blanks for nulls."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]), 256)


def group_fingerprint(df: DataFrame, group: Sequence[str], cols: Sequence[str], ord: str) -> DataFrame:
    """A26 over the rows of small groups in order (a page's neighbours, a few rows each).

    Rows are hashed before they are collected, so a group holds hashes only.
    """
    rows = df.select(*group, F.col(ord).alias("_o"), row_fingerprint(cols).alias("_t"))
    return rows.groupBy(*group).agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_o", "_t"))), lambda x: x["_t"]), "\n"), 256).alias("fingerprint"))


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row that changes when any row changes, whatever the order: count, sum and xor of
    row hashes. Computed with partial aggregates, nothing is sorted."""
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (cols or df.columns)])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


# ---- page audit (A29) -------------------------------------------------------------------------

def schema_coverage(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with JSON-LD, with a Product node, with blocks that do not parse, with CJK inside."""
    from catalogflow.functions.markup import json_ld_blocks
    from catalogflow.functions.text import has_cjk

    rows = pages.select(json_ld_blocks(html).alias("b"))
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("pages"), n(F.size("b") > 0).alias("with_json_ld"),
        n(F.exists("b", lambda x: x.rlike(r'"@type"\s*:\s*"Product"'))).alias("with_product"),
        n(F.exists("b", lambda x: F.try_parse_json(x).isNull())).alias("parse_errors"),
        n(F.exists("b", lambda x: has_cjk(x))).alias("with_cjk"))


# ---- wave roll-up (A21) ------------------------------------------------------------------------

def wave_report(slices: DataFrame, ledger: DataFrame, exc: DataFrame) -> DataFrame:
    """Per slice and in total (rollup): slice state, asset outcomes, bytes, exceptions by severity.

    ``slices``: slice_idx, state. ``ledger``: slice_idx, status, size. ``exc``: slice_idx, severity.
    Each input is reduced to one row per slice before they meet.
    """
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    assets = ledger.groupBy("slice_idx").agg(
        F.count(F.lit(1)).alias("assets"), n(F.col("status") == "VERIFIED").alias("verified"), n(F.col("status") == "DUPLICATE").alias("duplicate"),
        n(F.col("status") == "FAILED").alias("failed"), n(F.col("status") == "SKIPPED").alias("skipped"), F.sum("size").alias("bytes"))
    sev = exc.groupBy("slice_idx").agg(
        n(F.col("severity") == "STOP").alias("stops"), n(F.col("severity") == "WARNING").alias("warnings"), n(F.col("severity") == "AUTO_SKIP").alias("skips"))
    rows = slices.join(assets, "slice_idx", "left").join(sev, "slice_idx", "left")
    sums = ["assets", "verified", "duplicate", "failed", "skipped", "bytes", "stops", "warnings", "skips"]
    return rows.rollup("slice_idx").agg(
        F.grouping("slice_idx").alias("is_total"), F.count(F.lit(1)).alias("slices"),
        n(F.col("state") == "READY_FOR_RELEASE").alias("ready"), n(F.coalesce(F.col("stops"), F.lit(0)) > 0).alias("blocked"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def failure_histogram(ledger: DataFrame, error: str = "error_code") -> DataFrame:
    """Failures by code."""
    return ledger.where(nonblank(error)).groupBy(F.col(error).alias("error_code")).agg(F.count(F.lit(1)).alias("n"))


def first_per_key(df: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    return first_occurrence(df, [key], ord)


def total_of(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
