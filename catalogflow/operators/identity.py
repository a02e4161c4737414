"""Identity operators: lookups, duplicates, slugs, clones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.keys import (
    KEY_MODES, identity_columns, key_alnum, key_filesafe, key_nospace, key_nospace_nohyphen, key_noparen, key_upper, nonblank,
    object_name, slug_alnum, slug_base, slug_hyphen, text,
)
from catalogflow.operators.ordering import first_occurrence, grouped_rank, last_occurrence, skip_taken, with_order
from catalogflow.session import cut

# Share and count of known candidates that stop a batch.
MASS_DUPLICATE_RATE = 0.20
MASS_DUPLICATE_MIN = 5


# ---- lookups -------------------------------------------------------------------

def enrich_by_code(df: DataFrame, raw: DataFrame, code: str, raw_code: str, cols: Sequence[str], ord: str = "ord", partitions: int | None = None) -> DataFrame:
    """Attach source facts by supplier code only; a part number may belong to clones. Of several
    source rows of a code the first by ``ord`` counts.

    With ``partitions`` both sides are dealt into as many tasks by code. Without, Spark sizes them at run time, and
    a code of many source rows is cut down to one row in every task before it is dealt.
    """
    coded = with_order(raw, ord).where(nonblank(raw_code)).select(key_upper(raw_code).alias("_code"), F.col(ord).alias("_at"), *cols)
    left = df.withColumn("_c", key_upper(code))
    if partitions:
        coded, left = coded.repartition(partitions, "_code"), left.repartition(partitions, "_c")
    right = first_occurrence(coded, ["_code"], "_at").drop("_at")
    return left.join(right, F.col("_c") == F.col("_code"), "left").drop("_c", "_code")


def lookup_with_fallback(
    df: DataFrame, by_code: DataFrame, by_mpn: DataFrame, code: str, mpn: str, out: str = "value", mpn_first: bool = False
) -> DataFrame:
    """Exact code, else part number. ``<out>_path`` reports which key answered.

    ``by_code`` and ``by_mpn`` have ``key`` and ``value``; of several rows of a key the smallest value
    counts. A key that is present with a blank value still answers ("covered but blank").
    """
    c = by_code.groupBy(F.col("key").alias("_ck")).agg(F.coalesce(F.min("value"), F.lit("")).alias("_cv"))
    m = by_mpn.groupBy(F.col("key").alias("_mk")).agg(F.coalesce(F.min("value"), F.lit("")).alias("_mv"))
    joined = df.join(c, key_upper(code) == F.col("_ck"), "left").join(m, key_upper(mpn) == F.col("_mk"), "left")
    order = [("mpn", "_mv"), ("code", "_cv")] if mpn_first else [("code", "_cv"), ("mpn", "_mv")]
    value = F.coalesce(*[F.col(v) for _, v in order])
    path = reduce(lambda acc, kv: F.when(F.col(kv[1]).isNotNull(), kv[0]).otherwise(acc), reversed(order), F.lit(""))
    return joined.withColumn(out, value).withColumn(out + "_path", path).drop("_ck", "_cv", "_mk", "_mv")


def safe_fallback_index(raw: DataFrame, mpn: str, code: str, value: str) -> DataFrame:
    """A part number is a key only if exactly one code claims it.

    Values of a safe part number come from its one code; blank values stay (they answer too).
    """
    per = raw.where(nonblank(mpn)).groupBy(key_upper(mpn).alias("key")).agg(
        F.min(key_upper(code)).alias("_a"), F.max(key_upper(code)).alias("_b"), F.min(value).alias("value"))
    return per.where(F.col("_a") == F.col("_b")).select("key", "value")


def exclude_known(df: DataFrame, master: DataFrame, mode: str = "mpn_brand", **cols: str) -> DataFrame:
    """Rows whose identity is not in MASTER yet."""
    left = identity_columns(mode, **cols)
    keys = [f"_k{i}" for i in range(len(left))]
    known = master.select(*identity_columns(mode, **cols)).distinct()
    flagged = df
    for c, k in zip(left, keys):
        flagged = flagged.withColumn(k, c)
    return flagged.join(known, keys, "left_anti").drop(*keys)


def select_subset(df: DataFrame, keys: DataFrame, mpn: str = "mpn") -> DataFrame:
    """Rows whose part number is on the list."""
    want = keys.select(key_upper(mpn).alias("_want")).distinct()
    return df.join(want, key_upper(df[mpn]) == F.col("_want"), "left_semi")


def resolve_code(mpns: DataFrame, master: DataFrame, mpn: str = "mpn", code: str = "supplier_reference") -> DataFrame:
    """Code of each part number; several codes or none is an error."""
    per = master.where(nonblank(code)).groupBy(key_upper(mpn).alias("_m")).agg(
        F.min(text(code)).alias("_lo"), F.max(text(code)).alias("_hi"))
    joined = mpns.select(mpn).distinct().join(per, key_upper(mpn) == F.col("_m"), "left")
    return joined.select(
        mpn,
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("code"),
        F.when(F.col("_lo").isNull(), "NO_CODE").when(F.col("_lo") != F.col("_hi"), "AMBIGUOUS").otherwise("OK").alias("status"),
    )


def own_introduction(df: DataFrame, raw: DataFrame, code: str, mpn: str, ord: str = "ord") -> DataFrame:
    """Introduction from the part's own envelope (code, else part number as key), the last one of a
    key by ``ord``, of equal ``ord`` the greatest; dropped when CJK remains after repair."""
    from catalogflow.functions.text import has_cjk, repair_mojibake

    placed = with_order(raw, ord).where(nonblank("key")).withColumn("_place", F.struct(ord, text("introduction")))
    right = last_occurrence(placed, [key_upper("key")], "_place").select(key_upper("key").alias("_rk"), text("introduction").alias("_intro"))
    own = F.when(text(code) != "", key_upper(code)).otherwise(key_upper(mpn))
    fixed = repair_mojibake(F.col("_intro"), colon=False)
    return (
        df.withColumn("_own", own).join(right, F.col("_own") == F.col("_rk"), "left")
        .withColumn("introduction", F.when(~has_cjk(fixed), F.nullif(fixed, F.lit(""))))
        .drop("_own", "_rk", "_intro")
    )


def carry_forward(new: DataFrame, old: DataFrame, key: str, col: str) -> DataFrame:
    """New value if present, else the previous one, else blank."""
    prev = old.groupBy(F.col(key).alias("_pk")).agg(F.max(col).alias("_prev"))
    joined = new.join(prev, F.col(key) == F.col("_pk"), "left")
    value = F.coalesce(F.nullif(text(col), F.lit("")), F.nullif(text("_prev"), F.lit("")), F.lit(""))
    return joined.withColumn(col, value).drop("_pk", "_prev")


def override(df: DataFrame, frozen: DataFrame, key: str, col: str) -> DataFrame:
    """The frozen table always wins; of several rows of a key its smallest value."""
    f = frozen.groupBy(F.col(key).alias("_fk")).agg(F.min(col).alias("_fv"))
    return df.join(f, F.col(key) == F.col("_fk"), "left").withColumn(col, F.coalesce("_fv", col)).drop("_fk", "_fv")


# Columns a patch may change.
PATCH_COLUMNS = ("attributes_json", "applications", "alternative_parts", "description", "keywords", "faq")


def apply_patch(
    master: DataFrame, patch: DataFrame, cols: Sequence[str] = PATCH_COLUMNS, mpn: str = "mpn", ord: str = "ord"
) -> tuple[DataFrame, DataFrame]:
    """Non-blank patch values replace MASTER values.

    Only the first MASTER row of a part number is patched; alternates equal to the part itself
    are dropped; a JSON column that does not parse is skipped. Returns the patched table with
    ``changed_columns`` and one row of counters with orphan patches.
    """
    from catalogflow.functions.attrs import repair_json_strings
    from catalogflow.functions.keys import split_multi
    from catalogflow.functions.text import normalize_visible

    cols = [c for c in cols if c in master.columns and c in patch.columns]
    at = F.col(ord) if ord in patch.columns else F.lit(0)
    p = patch.where(nonblank(mpn)).groupBy(text(mpn).alias("_pk")).agg(
        *[F.max_by(F.col(c), F.when(nonblank(c), at)).alias(f"_p_{c}") for c in cols], F.lit(True).alias("_hit"))
    first = master.where(nonblank(mpn)).groupBy(text(mpn).alias("_mk")).agg(F.min(ord).alias("_first"))
    target = first.join(p, F.col("_mk") == F.col("_pk")).select("_mk", "_first", *[f"_p_{c}" for c in cols])
    # one patched row per part number, so the join is on the row itself
    joined = master.withColumn("_k", text(mpn)).join(target, (F.col("_k") == F.col("_mk")) & (F.col(ord) == F.col("_first")), "left")

    changed, values = [], {}
    for c in cols:
        if c.endswith("_json"):
            new = F.when(F.try_parse_json(F.col(f"_p_{c}")).isNotNull(), repair_json_strings(F.col(f"_p_{c}")))
        elif c == "alternative_parts":
            others = F.filter(split_multi(f"_p_{c}"), lambda x: key_noparen(x) != key_noparen(mpn))
            new = normalize_visible(F.array_join(others, "; "))
        else:
            new = normalize_visible(F.col(f"_p_{c}"))
        differs = F.col("_mk").isNotNull() & (F.coalesce(new, F.lit("")) != "") & (new != text(c))
        values[c] = F.when(differs, new).otherwise(F.col(c))
        changed.append(F.when(differs, F.lit(c)))
    out = joined.withColumn("changed_columns", F.array_compact(F.array(*changed)))
    out = out.withColumns(values).drop("_k", "_mk", "_first", *[f"_p_{c}" for c in cols])
    orphans = p.join(first, F.col("_pk") == F.col("_mk"), "left_anti").agg(F.count(F.lit(1)).alias("orphan_patches"))
    counters = out.agg(
        F.sum(F.when(F.size("changed_columns") > 0, 1).otherwise(0)).alias("rows_changed"),
        F.sum(F.size("changed_columns")).alias("cells_changed"),
    ).crossJoin(orphans)  # one row each
    return out, counters


def alternate_edges(parts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target) edges of the alternates lists, unresolved ones dropped.

    ``parts``: ``slug``, ``alternates`` (array of part numbers). ``targets``: ``slug``, ``mpn``.
    An alternate resolves by slug first, then by part number (first part in slug order).
    """
    edges = parts.select(F.col("slug").alias("source"), F.posexplode("alternates").alias("pos", "alt"))
    by_slug = targets.where(nonblank("slug")).select(F.col("slug").alias("_s")).distinct()
    by_mpn = targets.where(nonblank("mpn")).groupBy(key_upper("mpn").alias("_m")).agg(F.min("slug").alias("_ms"))
    hit = (
        edges.join(by_slug, slug_alnum("alt") == F.col("_s"), "left")
        .join(by_mpn, key_upper("alt") == F.col("_m"), "left")
        .withColumn("target", F.coalesce("_s", "_ms"))
    )
    return hit.where("target is not null and target <> source").select("source", "target").distinct()


def related_neighbours(df: DataFrame, group: str, slug: str, ord: str = "ord", k: int = 6, mpn: str = "mpn") -> DataFrame:
    """The next ``k`` parts of the same group in cyclic order, own slug passed over.

    Positions inside the group make this an equality join on (group, position): a part meets
    at most a handful of positions, never its whole group. In small groups the walk wraps and
    repeats neighbours; only the first row of a slug is reported on.
    """
    pool = grouped_rank(df.select(F.col(group).alias("g"), F.col(slug).alias("slug"), F.col(mpn if mpn in df.columns else slug).alias("mpn"), F.col(ord).alias("o")), ["g"], ["o"], "pos", "n")
    pool = cut(pool.withColumn("pos", F.col("pos") - 1))
    same = pool.groupBy("g", "slug").agg(F.count(F.lit(1)).alias("c"), F.min("pos").alias("first"), F.min("n").alias("n"))
    # A slug in several groups is reported in the group that starts first.
    starts = pool.groupBy("g").agg(F.min("o").alias("start"))
    placed = same.join(starts, "g")
    home = placed.groupBy("slug").agg(F.min("start").alias("start"))
    same = placed.join(home, ["slug", "start"]).where("n > c")
    # A row of another slug is found within c further steps of every lap.
    last = F.when(F.col("n") - F.col("c") >= k, F.col("c") + k).otherwise(F.col("n") + k)
    own = same.select("g", F.col("slug").alias("own"), "first", "n", last.alias("last"))
    # A slug that repeats very often walks in blocks, spread over the tasks.
    block = 8192
    steps = (
        own.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - 1) / block).cast("long"))))
        .repartition("g", "own", "b")
        .withColumn("step", F.explode(F.sequence(F.col("b") * block + 1, F.least((F.col("b") + 1) * block, F.col("last")))))
        .drop("b")
    )
    steps = steps.withColumn("at", (F.col("first") + F.col("step")) % F.col("n"))
    met = steps.join(pool.select("g", F.col("pos").alias("at"), "slug", "mpn"), ["g", "at"]).where("slug <> own")
    w = Window.partitionBy("g", "own").orderBy("step")
    return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        F.col("g").alias("group"), F.col("own").alias("slug"), "rank", F.col("slug").alias("neighbour"), F.col("mpn").alias("neighbour_mpn"))


def canonical_href(df: DataFrame, pages: DataFrame, model: str, prefix: str, fallback: str) -> DataFrame:
    """Link to the page of a model if it exists, else the request page."""
    p = pages.select(F.col("slug").alias("_s")).distinct()
    return (
        df.join(p, slug_alnum(model) == F.col("_s"), "left")
        .withColumn("href", F.when(F.col("_s").isNotNull(), F.concat(F.lit(prefix), F.col("_s"), F.lit("/")))
                    .otherwise(F.concat(F.lit(fallback), F.url_encode(model))))
        .drop("_s")
    )


def match_documents(parts: DataFrame, docs: DataFrame) -> DataFrame:
    """Document path of each part; priority code, part number, alnum part number, clean one.

    ``parts``: ``part_id``, ``code``, ``mpn``, ``clean_mpn``, ``url`` (already published, kept).
    ``docs``: ``path``, ``stem``; the first path of a key is used. The winner per part is one
    minimum over four key joins.
    """
    keyed = docs.groupBy(F.lower("stem").alias("k")).agg(F.min("path").alias("path"))
    alnum = docs.groupBy(key_alnum("stem").alias("k")).agg(F.min("path").alias("path"))
    tries = [
        (1, "cid", F.lower(text("code")), keyed), (2, "mpn", F.lower(text("mpn")), keyed),
        (3, "alnum_mpn", key_alnum("mpn"), alnum), (4, "clean_mpn", F.lower(text("clean_mpn")), keyed),
    ]
    open_parts = parts.where(~nonblank("url"))
    hits = reduce(DataFrame.unionByName, [
        open_parts.select("part_id", key.alias("k")).where("k <> ''").join(d, "k").select(
            "part_id", F.lit(p).alias("p"), F.lit(m).alias("method"), "path")
        for p, m, key, d in tries
    ])
    best = hits.groupBy("part_id").agg(F.min(F.struct("p", "method", "path")).alias("b"))
    return parts.join(best, "part_id", "left").withColumn(
        "method", F.when(nonblank("url"), "preserved").when(F.col("b").isNotNull(), F.col("b.method")).otherwise("missing")
    ).withColumn("path", F.when(nonblank("url"), F.col("url")).otherwise(F.col("b.path"))).drop("b")


# ---- duplicates -----------------------------------------------------------------

def distinct_keys(df: DataFrame, mode: str = "mpn_brand", **cols: str) -> DataFrame:
    """A2: set of identities."""
    keys = identity_columns(mode, **cols)
    return df.select(*keys).where("_k0 <> ''").distinct()


class Guard:
    """Result of ``dedup_guard``: rows with ``status`` (new, duplicate, self_duplicate),
    exceptions, and the one-row decision."""

    def __init__(self, rows: DataFrame, exceptions: DataFrame, decision: DataFrame):
        self.rows, self.exceptions, self.decision = rows, exceptions, decision

    @property
    def new(self) -> DataFrame:
        return self.rows.where("status = 'new'").drop("status")


def dedup_guard(
    cands: DataFrame, master: DataFrame, known_codes: DataFrame | None = None, mode: str = "mpn_brand",
    rate: float = MASS_DUPLICATE_RATE, minimum: int = MASS_DUPLICATE_MIN, ord: str = "ord", code: str = "supplier_reference",
) -> Guard:
    """A3: split candidates into new, already known and repeated inside the batch."""
    keys = identity_columns(mode)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = cands
    for c, n in zip(keys, names):
        rows = rows.withColumn(n, c)
    first = rows.groupBy(*names).agg(F.min(ord).alias("_first"))
    known = distinct_keys(master, mode).withColumn("_known", F.lit(True))
    facts = first.join(known, names, "left")  # one row per identity
    rows = rows.join(facts, names)
    is_known = F.coalesce(F.col("_known"), F.lit(False))
    if known_codes is not None:
        codes = known_codes.select(text(code).alias("_kc")).where("_kc <> ''").distinct()
        rows = rows.join(codes, text(code) == F.col("_kc"), "left")
        is_known = is_known | F.col("_kc").isNotNull()
    status = F.when(F.col(ord) != F.col("_first"), "self_duplicate").when(is_known, "duplicate").otherwise("new")
    rows = rows.withColumn("status", status).select(*cands.columns, "status")
    exceptions = rows.where("status <> 'new'").select(
        F.when(F.col("status") == "duplicate", "DUPLICATE_SKIP").otherwise("BATCH_SELF_DUPLICATE").alias("code"),
        F.when(F.col("status") == "duplicate", "AUTO_SKIP").otherwise("STOP").alias("severity"),
        key_upper("mpn").alias("mpn"),
        F.when(F.col("status") == "duplicate", "identity is already in MASTER").otherwise("identity repeats inside the batch").alias("message"),
    )
    n = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0))
    counts = rows.agg(F.count(F.lit(1)).alias("total"), n("new").alias("new"), n("duplicate").alias("duplicates"), n("self_duplicate").alias("self_duplicates"))
    share = F.col("duplicates") / F.greatest(F.col("total"), F.lit(1))
    mass = (F.col("duplicates") >= minimum) & (share > rate)
    decision = counts.withColumn("duplicate_rate", share).withColumn(
        "stop_code", F.when(F.col("self_duplicates") > 0, "BATCH_SELF_DUPLICATE").when(mass, "MASS_DUPLICATE").otherwise("")
    ).withColumn("stop", F.col("stop_code") != "")
    return Guard(rows, exceptions, decision)


def duplicate_mpns(df: DataFrame, mpn: str = "mpn", line: str = "line") -> DataFrame:
    """A4: every row of the part numbers that occur more than once: normalised key, raw part number
    and line, the key's number of rows, and whether the row repeats an earlier line.

    The number of duplicates of a table is the count of ``duplicate``.
    """
    keyed = df.select(key_nospace(mpn).alias("key"), F.trim(mpn).alias("mpn"), F.col(line).alias("line")).where("key <> ''")
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("_first")).where("n > 1")
    return keyed.join(counts, "key").select("key", "mpn", "line", "n", (F.col("line") != F.col("_first")).alias("duplicate"))


def slug_collisions(df: DataFrame, mpn: str = "mpn", slug: str = "slug") -> DataFrame:
    """A5: slugs that several part numbers share, and part numbers without a slug (blank slug)."""
    pairs = df.select(F.col(slug).alias("slug"), key_nospace(mpn).alias("mpn")).where("mpn <> ''").distinct()
    per = pairs.groupBy("slug").agg(F.count(F.lit(1)).alias("mpns"), F.min("mpn").alias("first_mpn"), F.max("mpn").alias("last_mpn"))
    return per.where("mpns > 1 or slug = ''")


def clone_index(raw: DataFrame, mpn: str = "mpn", brand: str = "manufacturer", code: str = "cid") -> DataFrame:
    """Per part number the makers that use it and the codes under each maker.

    Repeats collapse per (part number, maker, code) first; a row then holds one entry per
    distinct maker.
    """
    keyed = raw.select(key_alnum(mpn).alias("key"), key_alnum(brand).alias("maker"), text(code).alias("code")).where("key <> ''").distinct()
    per_maker = keyed.groupBy("key", "maker").agg(F.count(F.lit(1)).alias("codes"), F.min("code").alias("first_code"))
    return per_maker.groupBy("key").agg(
        F.sort_array(F.collect_set(F.nullif("maker", F.lit("")))).alias("makers"),
        F.sum("codes").alias("codes"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("maker", "first_code")))).alias("code_by_maker"),
    )


def clone_key_flag(df: DataFrame, index: DataFrame, oem_hosts: Sequence[str], mpn: str = "mpn", url: str = "datasheet_url") -> DataFrame:
    """``clone_stop`` is true when several makers share the part number and the document is
    stored under the file name made from the part number, unless a maker's own host serves it."""
    from catalogflow.functions.keys import url_host
    from catalogflow.operators.gates import host_matches

    idx = index.select(F.col("key").alias("_ik"), F.size("makers").alias("_makers"))
    joined = df.join(idx, key_alnum(mpn) == F.col("_ik"), "left")
    by_mpn = _named_after(url, mpn)
    stop = (F.coalesce(F.col("_makers"), F.lit(0)) > 1) & nonblank(url) & by_mpn & ~host_matches(url_host(url), oem_hosts)
    return joined.withColumn("clone_makers", F.coalesce("_makers", F.lit(0))).withColumn("clone_stop", stop).drop("_ik", "_makers")


def _named_after(url: str, mpn: str) -> Column:
    return F.trim(object_name(url)) == key_filesafe(F.trim(mpn))


def scrub_clone_keys(
    df: DataFrame, index: DataFrame, oem_hosts: Sequence[str], url: str = "datasheet_url", others: Sequence[str] = (), mpn: str = "mpn"
) -> DataFrame:
    """Blank those document links, and in the same rows those of the columns ``others`` that have the same file name."""
    flagged = clone_key_flag(df, index, oem_hosts, mpn, url)
    blanked = {c: F.when(F.col("clone_stop") & _named_after(c, mpn), F.lit("")).otherwise(F.col(c)) for c in others}
    return flagged.withColumns({url: F.when(F.col("clone_stop"), F.lit("")).otherwise(F.col(url)), **blanked, "scrubbed": F.col("clone_stop")}).drop("clone_stop", "clone_makers")


def duplicate_primary(df: DataFrame, mpn: str = "mpn", slug: str = "slug", ord: str = "ord") -> DataFrame:
    """One primary per part number (case, blanks and hyphens ignored).

    The first row whose brand is its manufacturer, else the least (category, manufacturer,
    slug). Adds ``primary_slug``, ``group_size`` and ``is_primary``. The primary is a minimum
    over one sort key, so a large group is reduced inside the map tasks.
    """
    low = lambda c: F.lower(text(c))
    native = (low("brand") != "") & (low("brand") == low("manufacturer"))
    rank = F.struct(
        F.when(native, 0).otherwise(1).alias("a"),
        F.when(native, F.col(ord)).alias("b"),
        F.when(~native, F.struct(low("category").alias("c"), low("manufacturer").alias("m"), low(slug).alias("s"))).alias("d"),
        F.col(ord).alias("o"), F.col(slug).alias("slug"),
    )
    keyed = df.withColumn("_key", key_nospace_nohyphen(mpn))
    best = keyed.where("_key <> ''").groupBy("_key").agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("_n"))
    out = keyed.join(best, "_key", "left")
    return (
        out.withColumn("primary_slug", F.coalesce(F.col("_best.slug"), F.col(slug)))
        .withColumn("group_size", F.coalesce("_n", F.lit(1)))
        .withColumn("is_primary", F.col("primary_slug") == F.col(slug))
        .drop("_key", "_best", "_n")
    )


# ---- slugs ------------------------------------------------------------------------

def assign_slugs(df: DataFrame, base: str, ord: str = "ord", name: str = "url_slug") -> DataFrame:
    """The first owner of a base keeps it, later ones get ``-2``, ``-3`` … past names in use.

    A base may itself look like a numbered one (``a-2``). Then the two meet: whoever comes
    first owns the name, and later duplicates of ``a`` step over it. Per base this is settled
    from counts (how many duplicates came before the numbered base first appears), level by
    level of nesting, so no group of rows is ever handled in one task.
    """
    keyed = df.withColumn("_base", slug_base(base))
    rows = grouped_rank(keyed.where("_base <> ''"), ["_base"], [ord], "_n", "_size")
    rows = cut(rows)
    blank = keyed.where("_base = ''").drop("_base").withColumn(name, F.lit(""))
    facts = _numbered_bases(rows, ord)
    if facts is None:
        slug = F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", F.col("_n").cast("string")))
        done = rows.withColumn(name, slug)
    else:
        own = facts.select("_base", "_own")
        joined = rows.join(own, "_base", "left").withColumn("_own", F.coalesce("_own", F.lit(1)))
        plain = (F.col("_own") == 1) & (F.col("_n") == 1)
        # the others take the numbers from 2 on that no numbered base holds
        numbered = joined.where(~plain).withColumn("_d", (F.col("_n") - F.col("_own")).cast("long"))
        taken = facts.where("_reserved is not null").select("_base", F.explode("_reserved").alias("_number"))
        numbered = skip_taken(numbered, taken, "_base", "_d", "_number", 2, "_given")
        named = numbered.withColumn(name, F.concat_ws("-", "_base", F.col("_given").cast("string"))).drop("_d", "_given")
        done = joined.where(plain).withColumn(name, F.col("_base")).unionByName(named).drop("_own")
    return done.drop("_base", "_n", "_size").unionByName(blank)


def _numbered_bases(rows: DataFrame, ord: str) -> DataFrame | None:
    """Per base that is, or has, a numbered base: ``_own`` (1 if its first row owns the plain
    name) and ``_reserved`` (numbers other bases hold). None when no such base exists."""
    pattern = r"^(.+)-([1-9][0-9]*)$"
    firsts = rows.where("_n = 1").select("_base", F.col(ord).alias("_o"), "_size")
    child = firsts.where(F.col("_base").rlike(pattern)).select(
        F.col("_base").alias("child"), F.col("_o").alias("first"),
        F.regexp_extract("_base", pattern, 1).alias("parent"),
        F.regexp_extract("_base", pattern, 2).try_cast("bigint").alias("num"))
    parent = firsts.select(F.col("_base").alias("parent"), F.col("_size").alias("psize"))
    pairs = child.where("num >= 2").join(parent, "parent")
    # A number can matter only if the duplicates reach it.
    w = Window.partitionBy("parent").orderBy("num")
    pairs = pairs.withColumn("_i", F.row_number().over(w)).where("num <= psize + _i").drop("_i")
    pairs = cut(pairs)
    if pairs.isEmpty():
        return None

    # How many rows of the parent come before the numbered base first appears.
    touched = pairs.select("parent").distinct()
    marks = pairs.select(F.col("parent").alias("_base"), F.col("first").alias("_at"), F.lit(1).alias("_ev"), "child")
    own_rows = rows.join(touched, F.col("_base") == F.col("parent"), "left_semi").select(
        "_base", F.col(ord).alias("_at"), F.lit(0).alias("_ev"), F.lit(None).cast("string").alias("child"))
    line = grouped_rank(own_rows.unionByName(marks), ["_base"], ["_at", "_ev"], "_r").where("_ev = 1")
    ev = Window.partitionBy("_base").orderBy("_at")
    counts = line.select(F.col("_base").alias("parent"), "child", (F.col("_r") - F.row_number().over(ev)).alias("before"))
    pairs = cut(pairs.join(counts, ["parent", "child"]))

    state = pairs.select(F.col("parent").alias("_base")).distinct().join(
        pairs.select(F.col("child").alias("_base")).distinct(), "_base", "left_anti").withColumn("_own", F.lit(1))
    done = None
    while True:
        level = pairs.join(state, F.col("parent") == F.col("_base")).select("parent", "child", "num", "before", "_own")
        level = cut(level)
        if level.isEmpty():
            break
        fold = level.groupBy("parent").agg(
            F.first("_own").alias("_own"), F.sort_array(F.collect_list(F.struct("num", "before", "child"))).alias("xs"))
        reserved = F.aggregate(
            F.col("xs"), F.array().cast("array<bigint>"),
            lambda acc, x: F.when(x["before"] - F.col("_own") < x["num"] - 1 - F.size(acc), F.array_append(acc, x["num"])).otherwise(acc))
        settled = cut(fold.withColumn("_reserved", reserved).select("parent", "_own", "_reserved", "xs"))
        part = settled.select(F.col("parent").alias("_base"), "_own", "_reserved")
        done = part if done is None else done.unionByName(part)
        state = settled.select("_reserved", F.explode("xs").alias("x")).select(
            F.col("x.child").alias("_base"), F.array_contains("_reserved", F.col("x.num")).cast("int").alias("_own"))
        last = state
        done = done.unionByName(last.select("_base", "_own", F.lit(None).cast("array<bigint>").alias("_reserved")))
    return done.groupBy("_base").agg(F.min("_own").alias("_own"), F.max("_reserved").alias("_reserved"))


def assign_stable_slugs(df: DataFrame, deployed: DataFrame, ord: str = "ord", code: str = "supplier_reference") -> DataFrame:
    """Parts keep the slug they were published under.

    ``deployed``: ``code``, ``mpn``, ``manufacturer``, ``slug``. Exact codes claim their slug
    first. The others take the slug of their (part number, maker) if it is unique, else their
    given slug, else the plain part number, else part number and maker when the plain name is
    already spoken for; ``assign_slugs`` settles what still meets.
    """
    by_code = deployed.where(nonblank("code") & nonblank("slug")).groupBy(F.col("code").alias("_dc")).agg(F.min("slug").alias("_dslug"))
    pair = deployed.where(nonblank("slug")).groupBy(slug_alnum("mpn").alias("_dm"), F.lower(text("manufacturer")).alias("_dk")).agg(
        F.min("slug").alias("_lo"), F.max("slug").alias("_hi")).where("_lo = _hi and _dm <> '' and _dk <> ''").select("_dm", "_dk", F.col("_lo").alias("_pslug"))
    rows = (
        df.withColumn("_cm", slug_alnum("mpn"))
        .join(by_code, text(code) == F.col("_dc"), "left")
        .join(pair, (F.col("_cm") == F.col("_dm")) & (F.lower(text("manufacturer")) == F.col("_dk")), "left")
    )
    given = F.nullif(text("url_slug"), F.lit("")) if "url_slug" in df.columns else F.lit(None).cast("string")
    rows = (
        rows.withColumn("_pass", F.when(F.col("_dslug").isNotNull(), 1).otherwise(2))
        .withColumn("_fixed", F.coalesce(F.col("_dslug"), F.col("_pslug"), given))
        .withColumn("_at", F.struct("_pass", F.col(ord).alias("o")))
        .withColumn("_claim", slug_base(F.coalesce(F.col("_fixed"), F.col("_cm"))))
    )
    first = rows.groupBy(F.col("_claim").alias("_fc")).agg(F.min("_at").alias("_fat"))
    rows = rows.join(first, F.col("_cm") == F.col("_fc"), "left")
    branded = F.concat_ws("-", F.col("_cm"), F.nullif(slug_hyphen("manufacturer"), F.lit("")))
    seed = F.coalesce(F.col("_fixed"), F.when(F.col("_fat") < F.col("_at"), branded).otherwise(F.col("_cm")))
    keep = [c for c in df.columns if c != "url_slug"]
    seeded = rows.withColumn("seed", seed).select(*keep, "seed", "_at")
    return assign_slugs(seeded, "seed", "_at").drop("_at")


# ---- sets -------------------------------------------------------------------------

def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys in both, only in the first, only in the second, as (side, key)."""
    cols = a.columns
    tag = lambda d, s: d.select(F.lit(s).alias("side"), *cols)
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "left_only")).unionByName(tag(b.subtract(a), "right_only"))


def is_disjoint(a: DataFrame, b: DataFrame) -> bool:
    """No common row."""
    return a.intersect(b).isEmpty()


def scope_violations(written: DataFrame, requested: DataFrame, induced: DataFrame) -> DataFrame:
    """U4: keys written although neither requested nor induced."""
    return written.subtract(requested.unionByName(induced))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union."""
    return reduce(DataFrame.unionByName, frames).distinct()


def bag_union(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs, repeats kept."""
    return reduce(DataFrame.unionByName, frames)


def new_keys(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Keys that were not there before."""
    return current.subtract(previous)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key that is missing, extra or differs; blank equals null.

    ``status`` is missing (left only), extra (right only) or mismatch, ``fields`` the columns
    that differ. Both sides need unique keys.
    """
    l = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[text(F.col(c).cast("string")).alias(f"l_{c}") for c in cols], F.lit(True).alias("_in_l"))
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[text(F.col(c).cast("string")).alias(f"r_{c}") for c in cols], F.lit(True).alias("_in_r"))
    cond = reduce(lambda a, b: a & b, [F.col(f"_l_{k}") == F.col(f"_r_{k}") for k in keys])
    both = l.join(r, cond, "full_outer")
    fields = F.array_compact(F.array(*[F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), F.lit(c)) for c in cols]))
    status = F.when(F.col("_in_r").isNull(), "missing").when(F.col("_in_l").isNull(), "extra").when(F.size(fields) > 0, "mismatch").otherwise("equal")
    return both.select(
        *[F.coalesce(F.col(f"_l_{k}"), F.col(f"_r_{k}")).alias(k) for k in keys], status.alias("status"),
        F.when(status == "mismatch", F.array_join(fields, ",")).otherwise("").alias("fields"),
    )


def key_mode(mode: str, col: str) -> Column:
    return KEY_MODES[mode](col)
