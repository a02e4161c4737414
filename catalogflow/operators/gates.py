"""Filters, screens and gates.

A gate never changes which rows it sees: it returns rows with a verdict, or an exceptions
table (code, severity, mpn, message). What stops a batch is decided from those tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.attrs import replay_alternates, spec_count
from catalogflow.functions.keys import _col, key_alnum, key_nospace, key_upper, let, literal_map, nonblank, text, url_host
from catalogflow.functions.text import has_illegal_text
from catalogflow.operators.identity import lookup_with_fallback
from catalogflow.operators.ordering import last_occurrence, with_order
from catalogflow.schemas import MASTER_COLUMNS, REQUIRED_COLUMNS

# Part numbers that are test or placeholder data; the first hit is the reason.
SYNTHETIC_PATTERNS = (
    r"(?i)^(MCU|MOS|RES|CAP|IND|DIO|CON|XTAL|MEM|WIFI|MOD|REG|AMP|OP|LED|PWR|IC)\d{6}",
    r"100000\d{3}",
    r"^\d{6,}$",
    r"(?i)PLACEHOLDER",
    r"(?i)XXX$",
    r"(?i)_(TEST|SAMPLE|MOCK)$",
)
NUMERIC_PATTERN = r"^\d{6,}$"
FAKE_BRANDS = r"(?i)(Acme|Nova|Placeholder|Synthetic|Mock|Fake|TestCorp|DemoSemi|Injected)"
# Makers that number their parts with digits only.
NUMERIC_BRANDS = ("molex", "te connectivity")
# Category names that mean "not known".
UNKNOWN_CATEGORIES = ("", "uncategorized", "unknown", "unmapped", "none")

# Hosts of makers whose own document links are kept.
OEM_HOSTS = (
    "nxp.com", "nxp.com.cn", "molex.com", "ti.com", "texasinstruments.com", "analog.com", "microchip.com",
    "st.com", "infineon.com", "onsemi.com", "renesas.com", "intel.com", "amd.com",
)
STORAGE_HOSTS = ("r2.dev",)
SUPPLIER_HOSTS = ("lcsc.com",)
BROKEN_URL = r"(?i)placeholder|example\.com|#$|\bTEST\b"

# Exception codes and their severity.
SEVERITY = {
    "DUPLICATE_SKIP": "AUTO_SKIP", "DATASHEET_404": "AUTO_SKIP", "DATASHEET_INVALID": "AUTO_SKIP", "DATASHEET_TIMEOUT": "AUTO_SKIP",
    "R2_OBJECT_EXISTS": "AUTO_PASS",
    "SYNTHETIC_MPN": "AUTO_SKIP", "SOURCE_MISSING": "AUTO_SKIP", "R2_UPLOAD_ERROR": "AUTO_SKIP", "R2_TIMEOUT": "AUTO_SKIP", "R2_NETWORK": "AUTO_SKIP",
    "R2_AUTH_FAILED": "STOP", "LOCAL_HASH_UNSTABLE": "STOP", "REMOTE_HASH_MISMATCH": "STOP", "REMOTE_VERIFY_FAILED": "STOP",
    "BRAND_UNMAPPED": "WARNING", "SPEC_THIN": "WARNING", "ATTR_UNKNOWN": "WARNING", "EXEMPT_100MHZ": "WARNING",
    "RELATED_DRIFT": "WARNING", "DATASHEET_THIN": "WARNING", "UNMAPPED_CATEGORY": "WARNING",
    "NO_BACKUP": "STOP", "BACKUP_VERIFY_FAIL": "STOP", "DUPLICATE_ABORT": "STOP", "BATCH_SELF_DUPLICATE": "STOP", "MASS_DUPLICATE": "STOP",
    "MASTER_CORRUPT": "STOP", "CJK_LEAK": "STOP", "LCSC_LEAK": "STOP", "BUILD_COUNT_MISMATCH": "STOP", "R2_MASS_FAIL": "STOP",
    "POOL_WRITE_FAIL": "STOP", "AUDIT_FAIL": "STOP", "MANIFEST_ERROR": "STOP",
}
EXIT_OK, EXIT_STOP = 0, 10
MASS_FAILURE_RATE = 0.10


def exceptions(df: DataFrame, code, message, mpn="mpn", severity=None) -> DataFrame:
    """Rows of ``df`` as exception records."""
    code = F.lit(code) if isinstance(code, str) else code
    sev = severity if severity is not None else literal_map(SEVERITY.items())[code]
    return df.select(
        code.alias("code"), (F.lit(sev) if isinstance(sev, str) else sev).alias("severity"),
        _col(mpn).cast("string").alias("mpn"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


# ---- projection and intake (P1, P2) ---------------------------------------------

def project_master(df: DataFrame, columns: Sequence[str] = MASTER_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the MASTER columns, missing ones blank; ``keep`` names working columns beside them."""
    have = set(df.columns)
    return df.select(*keep, *[
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns])


def intake_filter(
    df: DataFrame, selector: DataFrame | None = None, exclude: DataFrame | None = None, category: str | None = None,
    require_document: bool = False, mpn: str = "mpn", document: str = "source_datasheet_url",
) -> DataFrame:
    """Adds ``drop_reason`` (blank for kept rows): the first rule of the ladder that fails."""
    rows = df.withColumn("_k", key_upper(mpn))
    steps: list[tuple[Column, str]] = [(F.col("_k") == "", "blank_mpn")]
    if selector is not None:
        rows = rows.join(selector.select(key_upper(mpn).alias("_sel")).distinct(), F.col("_k") == F.col("_sel"), "left")
        steps.append((F.col("_sel").isNull(), "not_selected"))
    if exclude is not None:
        rows = rows.join(exclude.select(key_upper(mpn).alias("_exc")).distinct(), F.col("_k") == F.col("_exc"), "left")
        steps.append((F.col("_exc").isNotNull(), "excluded"))
    if category:
        steps.append((F.lower(text("category")) != category.strip().lower(), "other_category"))
    if require_document:
        steps.append((~nonblank(document), "no_document"))
    reason = reduce(lambda acc, s: F.when(s[0], s[1]).otherwise(acc), reversed(steps), F.lit(""))
    return rows.withColumn("drop_reason", reason).select(*df.columns, "drop_reason")


def drop_counts(flagged: DataFrame) -> DataFrame:
    return flagged.where("drop_reason <> ''").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


# ---- synthetic data (P3, P4) ------------------------------------------------------

def numeric_mpn_exempt(mode: str, brand="brand", code="supplier_reference", name="description", source="source_kind", canonical=None) -> Column:
    """When an all-digit part number is a real one.

    ``build``: the maker numbers its parts so. ``intake``: the envelope source gives brand,
    code and name. ``index``: never.
    """
    if mode == "build":
        known = F.lower(text(brand)).isin(*NUMERIC_BRANDS)
        return known | F.lower(text(canonical)).isin(*NUMERIC_BRANDS) if canonical is not None else known
    if mode == "intake":
        return (text(source) == "lcsc_http_json") & nonblank(brand) & nonblank(code) & nonblank(name)
    if mode == "index":
        return F.lit(False)
    raise ValueError(f"unknown mode {mode!r}")


def synthetic_reason(mpn, brand=None, exempt: Column | None = None) -> Column:
    """The pattern or brand that marks a row as made up; blank for real rows.

    An exempt all-digit number is still checked against the other patterns and the brand,
    except in intake mode of the source, where the exemption settles the matter.
    """
    s = F.coalesce(_col(mpn), F.lit(""))
    exempt = F.lit(False) if exempt is None else exempt
    out = F.lit("")
    if brand is not None:
        out = F.when(F.coalesce(_col(brand), F.lit("")).rlike(FAKE_BRANDS), "fake brand")
        out = out.otherwise("")
    for i, pattern in reversed(list(enumerate(SYNTHETIC_PATTERNS, 1))):
        hit = s.rlike(pattern)
        if pattern == NUMERIC_PATTERN:
            hit = hit & ~exempt
        out = F.when(hit, F.lit(f"pattern {i}")).otherwise(out)
    return out


def is_unknown_category(c) -> Column:
    return F.lower(text(c)).isin(*UNKNOWN_CATEGORIES)


# ---- qualification (P7, P8) ---------------------------------------------------------

def missing_required(cols: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    """Name of the first blank required column, null if none."""
    return F.coalesce(*[F.when(~nonblank(c), F.lit(c)) for c in cols])


def qualify(df: DataFrame, known_brands: DataFrame | None = None, attributes: str = "attributes_json") -> DataFrame:
    """Adds ``verdict`` (ok, warn, reject), ``code`` and ``note``.

    Expects mpn, brand, manufacturer, description, category, needs_review and the family in
    ``family``; a controller needs two specs, any other family one, an unknown family two.
    """
    from catalogflow.functions.classify import family_l1

    minimum = F.when(text("family") == "Microcontroller", 2).when(text("family").isin(*family_l1()), 1).otherwise(2)
    rows, brand_known = df, F.lit(True)
    if known_brands is not None:
        known = known_brands.select(F.lower(F.trim("raw")).alias("_kb")).distinct()
        rows = df.join(known, F.lower(text("manufacturer")) == F.col("_kb"), "left")
        brand_known = F.col("_kb").isNotNull()
    syn = synthetic_reason("mpn", "brand")
    leak = has_illegal_text("description", attributes, "manufacturer", "brand")
    specs = spec_count(attributes)
    missing = missing_required()
    ladder = [
        (syn != "", "reject", "SYNTHETIC_MPN", syn),
        (missing.isNotNull(), "reject", "SPEC_THIN", F.concat(F.lit("missing required field "), missing)),
        (leak, "reject", "CJK_LEAK", F.lit("non-ASCII text")),
        ((text("category") == "Uncategorized") | F.coalesce(F.col("needs_review"), F.lit(False)), "warn", "UNMAPPED_CATEGORY", F.lit("held for review")),
        (specs < minimum, "warn", "SPEC_THIN", F.concat(specs.cast("string"), F.lit(" specs, minimum "), minimum.cast("string"))),
        (~brand_known, "warn", "BRAND_UNMAPPED", text("manufacturer")),
    ]
    pick = lambda i, last: reduce(lambda acc, r: F.when(r[0], F.lit(r[i]) if isinstance(r[i], str) else r[i]).otherwise(acc), reversed(ladder), F.lit(last))
    return rows.withColumns({"verdict": pick(1, "ok"), "code": pick(2, ""), "note": pick(3, "")}).drop("_kb")


# ---- hosts (P11, P25, J18, A30) ------------------------------------------------------

def host_matches(host: Column, names: Sequence[str]) -> Column:
    """The host itself or a subdomain; ``notti.com`` is not ``ti.com``."""
    return host.rlike(r"(?i)(^|\.)(" + "|".join(n.replace(".", r"\.") for n in names) + ")$")


def classify_host(url, storage=STORAGE_HOSTS, supplier=SUPPLIER_HOSTS, oem=OEM_HOSTS) -> Column:
    """struct<verdict, host>. The host decides first; a bad shape narrows every verdict
    except a supplier's, which is the more useful finding."""
    def verdict(x):
        u, host = x["url"], x["host"]
        by_host = (
            F.when(host_matches(host, storage), "OK_STORAGE").when(host_matches(host, supplier), "BAD_SUPPLIER")
            .when(host_matches(host, oem), "OK_OEM").otherwise("BAD_UNKNOWN"))
        shape = u.rlike(BROKEN_URL) | ~F.lower(u).startswith("https://")
        return let(by_host, lambda v: F.struct(
            F.when(u == "", "").when((v != "BAD_SUPPLIER") & shape, "BAD_SHAPE").otherwise(v).alias("verdict"), host.alias("host")))

    return let(F.struct(text(url).alias("url"), url_host(url).alias("host")), verdict)


def supplier_document_url(raw, supplier=SUPPLIER_HOSTS) -> Column:
    """P25: links to the supplier's own document store, others blank."""
    return F.when(host_matches(url_host(raw), supplier), text(raw)).otherwise("")


def storage_index(master: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Proven storage links by code and by part number; the first source row wins.

    ``master``: mpn, supplier_reference, datasheet_url, ord. ``mapping``: mpn, url, ord.
    """
    stored = master.select(
        "mpn", "supplier_reference", F.col("datasheet_url").alias("url"), F.lit(0).alias("src"), F.col("ord").cast("string").alias("at"), "ord")
    if mapping is not None:
        stored = stored.unionByName(mapping.select(
            "mpn", F.lit("").alias("supplier_reference"), "url", F.lit(1).alias("src"), F.col("ord").cast("string").alias("at"), "ord"))
    good = stored.where(classify_host("url")["verdict"] == "OK_STORAGE")
    first = lambda key: good.where(key != "").groupBy(key.alias("key")).agg(
        F.min(F.struct("src", "ord", "url")).alias("b")).select("key", F.col("b.url").alias("value"))
    return first(key_upper("supplier_reference")), first(key_upper("mpn"))


def host_actions(df: DataFrame, by_code: DataFrame, by_mpn: DataFrame, url: str = "datasheet_url") -> DataFrame:
    """SHIP, REWRITE (supplier link with a proven storage copy), STOP or NODATA per row."""
    rows = lookup_with_fallback(df.withColumn("_h", classify_host(url)), by_code, by_mpn, "supplier_reference", "mpn", "_new")
    v = F.col("_h.verdict")
    action = (
        F.when(v == "", "NODATA").when(v.isin("OK_STORAGE", "OK_OEM"), "SHIP")
        .when((v == "BAD_SUPPLIER") & (F.coalesce(F.col("_new"), F.lit("")) != ""), "REWRITE").otherwise("STOP"))
    rewritten = action == "REWRITE"
    return (
        rows.withColumn("verdict", v).withColumn("host", F.col("_h.host")).withColumn("action", action)
        .withColumn("rewrite_path", F.when(rewritten, F.col("_new_path")).otherwise(""))
        .withColumn(url, F.when(rewritten, F.col("_new")).otherwise(F.col(url)))
        .drop("_h", "_new", "_new_path")
    )


def host_histogram(df: DataFrame, url: str = "datasheet_url") -> DataFrame:
    """Links per verdict and host, blanks included."""
    return df.select(classify_host(url).alias("h")).groupBy(F.col("h.verdict").alias("verdict"), F.col("h.host").alias("host")).agg(
        F.count(F.lit(1)).alias("n"))


# ---- documents and provenance (A9, J19, J20) -------------------------------------------

def document_identity(df: DataFrame, ref: str = "document") -> DataFrame:
    """Findings (level, kind, mpn, maker).

    One maker with several documents: STOP. Several makers on one shared document: STOP.
    Several makers, each with its own: WARN, and WARN again for a maker with several.
    Built from distinct (part number, maker, document) counts in two steps; no list of rows.
    """
    keyed = df.select(key_nospace("mpn").alias("mpn"), key_alnum("manufacturer").alias("maker"), text(ref).alias("ref")).where("mpn <> ''").distinct()
    per_maker = keyed.groupBy("mpn", "maker").agg(
        F.sum(F.when(F.col("ref") != "", 1).otherwise(0)).alias("refs"))
    per_mpn = per_maker.groupBy("mpn").agg(F.count(F.lit(1)).alias("makers"))
    shared = keyed.where("ref <> ''").select("mpn", "ref").distinct().groupBy("mpn").agg(F.count(F.lit(1)).alias("all_refs"))
    facts = per_mpn.join(shared, "mpn", "left")
    one = per_maker.join(facts, "mpn").where("makers = 1 and refs > 1").select(
        F.lit("STOP").alias("level"), F.lit("DATASHEET_IDENTITY_FAIL").alias("kind"), "mpn", "maker")
    many = facts.where("makers > 1").select(
        F.when(F.col("all_refs") == 1, "STOP").otherwise("WARN").alias("level"),
        F.when(F.col("all_refs") == 1, "DATASHEET_IDENTITY_FAIL").otherwise("DATASHEET_CLONE_MPN").alias("kind"),
        "mpn", F.lit("").alias("maker"))
    extra = per_maker.join(facts, "mpn").where("makers > 1 and refs > 1").select(
        F.lit("WARN").alias("level"), F.lit("DATASHEET_CLONE_MPN").alias("kind"), "mpn", "maker")
    return one.unionByName(many).unionByName(extra)


def faq_provenance(df: DataFrame, raw: DataFrame, verified: DataFrame) -> DataFrame:
    """Adds ``faq_status``: sourced, verified (WARN), fabricated (STOP) or blank.

    ``raw``: ``code``, ``faqs``; ``verified``: ``mpn``.
    """
    have = raw.where(F.size("faqs") > 0).select(key_upper("code").alias("_fc")).distinct()
    ok = verified.select(key_upper("mpn").alias("_vm")).distinct()
    rows = df.join(have, key_upper("supplier_reference") == F.col("_fc"), "left").join(ok, key_upper("mpn") == F.col("_vm"), "left")
    status = (
        F.when(~nonblank("faq"), "").when(F.col("_vm").isNotNull(), "verified")
        .when(F.col("_fc").isNotNull(), "sourced").otherwise("fabricated"))
    return rows.withColumn("faq_status", status).drop("_fc", "_vm")


def alternates_as_is(df: DataFrame, raw: DataFrame, ord: str = "ord") -> DataFrame:
    """Adds ``alternates_status``: ok, FAIL (text differs from the source list) or WARN (no source).

    Of several source rows of a code the last by ``ord`` counts.
    """
    want = last_occurrence(with_order(raw, ord).where(nonblank("code")), [key_upper("code")], ord).select(
        key_upper("code").alias("_rc"), F.array_join(F.transform(replay_alternates("alternates"), lambda a: a["mpn"]), "; ").alias("_want"))
    rows = df.join(want, key_upper("supplier_reference") == F.col("_rc"), "left")
    status = (
        F.when(~nonblank("supplier_reference"), "").when(F.col("_rc").isNull(), "WARN")
        .when(text("alternative_parts") != F.coalesce("_want", F.lit("")), "FAIL").otherwise("ok"))
    return rows.withColumn("alternates_status", status).drop("_rc", "_want")


# ---- taxonomy (J12, P12, P13, A32, P22) --------------------------------------------------

def resolve_taxonomy(df: DataFrame, tops: DataFrame, l1: DataFrame, slug: str = "native_l1") -> DataFrame:
    """Level-1 slug to its top scope; unknown slugs are UNMAPPED under ``__UNMAPPED__``."""
    dim = l1.join(tops.select(F.col("slug").alias("_ts"), F.col("name").alias("_tn"), F.col("publish_status").alias("_tp")),
                  F.col("top_scope") == F.col("_ts"), "left").select(
        F.lower(F.trim("slug")).alias("_l"), F.col("top_scope").alias("_top"), F.col("en_display").alias("_name"),
        F.col("publish_status").alias("_p"), "_tn", "_tp")
    rows = df.join(dim, F.lower(text(slug)) == F.col("_l"), "left")
    found = F.col("_l").isNotNull()
    return (
        rows.withColumn("tax_status", F.when(found, "RESOLVED").otherwise("UNMAPPED"))
        .withColumn("top", F.when(found, F.col("_top")).otherwise("__UNMAPPED__"))
        .withColumn("top_name", F.coalesce("_tn", F.lit("")))
        .withColumn("l1_name", F.coalesce("_name", F.lit("")))
        .withColumn("publish_status", publish_status("_p", "_tp"))
        .drop("_l", "_top", "_name", "_p", "_tn", "_tp")
    )


def publish_status(own, top) -> Column:
    """Unknown counts as active; hidden beats review beats active."""
    a, b = F.lower(text(own)), F.lower(text(top))
    return F.when((a == "hidden") | (b == "hidden"), "hidden").when((a == "review") | (b == "review"), "review").otherwise("active")


def publish_gate(groups: DataFrame, tops: DataFrame, allow: Sequence[str] = (), l1: DataFrame | None = None, key: str = "slug") -> DataFrame:
    """Adds ``skip_reason`` (blank = kept): the top is not active and the group not allow-listed."""
    t = tops.select(F.col("slug").alias("_ts"), F.lower(F.coalesce("publish_status", F.lit("active"))).alias("_tp"))
    rows = groups.join(t, F.col("top") == F.col("_ts"), "left")
    top_state = F.coalesce(F.col("_tp"), F.lit("active"))
    allowed = F.col(key).isin(*allow) if allow else F.lit(False)
    reason = F.when((top_state != "active") & ~allowed, F.concat(F.lit("top:"), top_state))
    if l1 is not None:
        s = l1.select(F.col("slug").alias("_ls"), F.lower(F.coalesce("publish_status", F.lit("active"))).alias("_lp"))
        rows = rows.join(s, F.col("native_l1") == F.col("_ls"), "left")
        reason = reason.when(F.col("_lp").isin("hidden", "review") & ~allowed, F.concat(F.lit("l1:"), F.col("_lp")))
    return rows.withColumn("skip_reason", F.coalesce(reason, F.lit(""))).drop("_ts", "_tp", "_ls", "_lp")


def taxonomy_counters(resolved: DataFrame) -> DataFrame:
    """A32."""
    return resolved.groupBy("tax_status").agg(F.count(F.lit(1)).alias("n"))


def page_missing(expected: DataFrame, pages: DataFrame) -> DataFrame:
    """Expected pages that do not exist."""
    return expected.join(pages.select(F.col("slug").alias("_p")).distinct(), F.col("slug") == F.col("_p"), "left_anti")


def valid_code(c) -> Column:
    """P24."""
    return text(c).rlike("^C[0-9]+$")


def keep_valid_codes(df: DataFrame, code: str, refs: DataFrame | None = None) -> DataFrame:
    rows = df.where(valid_code(code))
    if refs is None:
        return rows
    return rows.join(refs.select(text("code").alias("_ref")).distinct(), text(code) == F.col("_ref"), "left_semi")


# ---- text scans (P18, J15) -----------------------------------------------------------------

def forbidden_tokens(
    df: DataFrame, key: str, texts: Sequence[str], rules: Sequence[tuple[str, str]], exemptions: DataFrame | None = None, around: int = 40
) -> DataFrame:
    """Every hit of every rule with up to ``around`` characters on both sides.

    ``rules`` are (name, pattern) literals, unrolled into one array per text: the rows are read
    once, whatever the number of rules. ``exemptions`` (key, field, token) take hits out.
    """
    def hits(c):
        body = F.coalesce(F.col(c), F.lit(""))
        per_rule = [_hits_of(body, name, pattern, around) for name, pattern in rules]
        return F.transform(F.concat(*per_rule), lambda h: F.struct(
            F.lit(c).alias("field"), h["rule"].alias("rule"), h["token"].alias("token"), h["context"].alias("context")))

    out = df.select(F.col(key).alias("key"), F.explode(F.concat(*[hits(c) for c in texts])).alias("h")).select("key", "h.*")
    if exemptions is None:
        return out
    e = exemptions.select(F.col("key").alias("_k"), F.col("field").alias("_f"), F.lower("token").alias("_t")).distinct()
    return out.join(e, (F.col("key") == F.col("_k")) & (F.col("field") == F.col("_f")) & (F.lower("token") == F.col("_t")), "left_anti")


def _hits_of(body: Column, name: str, pattern: str, around: int) -> Column:
    """All hits of one rule with their surroundings; hits close to each other are all kept."""
    tokens = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    between = F.split(body, pattern, -1)
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<rule:string,token:string,context:string>>").alias("out"))

    def step(acc, pair):
        at = acc["at"] + F.length(pair["gap"])
        left = F.greatest(at - around, F.lit(1))
        context = body.substr(left, at - left + F.length(pair["token"]) + around)
        hit = F.struct(F.lit(name).alias("rule"), pair["token"].alias("token"), context.alias("context"))
        return F.struct((at + F.length(pair["token"])).alias("at"), F.array_append(acc["out"], hit).alias("out"))

    pairs = F.zip_with(tokens, F.slice(between, F.lit(1), F.size(tokens)), lambda t, g: F.struct(t.alias("token"), g.alias("gap")))
    none = F.array().cast("array<struct<rule:string,token:string,context:string>>")
    return F.when(body.rlike(pattern), F.aggregate(pairs, start, step)["out"]).otherwise(none)


def dead_links(links: DataFrame, pages: DataFrame, site: str = "") -> DataFrame:
    """Adds ``link_status``: skip (other sites, anchors, mail), ok or dead.

    Links to ``site`` count as links inside it.
    """
    p = pages.select(F.regexp_replace("path", "/+$", "").alias("_p")).distinct()
    href = text("href")
    if site:
        href = F.regexp_replace(href, r"(?i)^https?://" + site.replace(".", r"\.") + "(?=/|$)", "")
    path = F.regexp_replace(F.regexp_replace(href, r"[?#].*$", ""), "/+$", "")
    skip = (href == "") | href.startswith("#") | ~href.startswith("/") | href.startswith("//")
    rows = links.withColumn("_path", path).join(p, F.col("_path") == F.col("_p"), "left")
    return rows.withColumn("link_status", F.when(skip, "skip").when(F.col("_p").isNotNull(), "ok").otherwise("dead")).drop("_path", "_p")


# ---- batch decisions (A19, A20, A22-A24, P28) ------------------------------------------------

def with_severity(exc: DataFrame) -> DataFrame:
    sev = literal_map(SEVERITY.items())
    return exc.withColumn("severity", F.coalesce("severity", sev[F.col("code")])) if "severity" in exc.columns else exc.withColumn("severity", sev[F.col("code")])


def gate_decision(exc: DataFrame) -> DataFrame:
    """One row: may the batch go on, exit code, counts per severity."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, 1).otherwise(0)), F.lit(0))
    return with_severity(exc).agg(
        F.count(F.lit(1)).alias("total"), n("STOP").alias("stop"), n("WARNING").alias("warning"), n("AUTO_SKIP").alias("skip"),
    ).withColumn("continue", F.col("stop") == 0).withColumn("exit_code", F.when(F.col("stop") > 0, EXIT_STOP).otherwise(EXIT_OK))


def batch_audit(exc: DataFrame, reconcile_status: str) -> DataFrame:
    """Pass if nothing stops and the reconciliation did not fail."""
    return gate_decision(exc).withColumn("audit", F.when((F.col("stop") == 0) & (F.lit(reconcile_status) != "FAIL"), "PASS").otherwise("FAIL"))


def asset_invariants(counts: DataFrame) -> DataFrame:
    """uploaded = new + existing, total = new + existing + failed."""
    stored = F.col("new_objects") + F.col("already_exists")
    return counts.withColumn("uploaded_ok", F.col("uploaded") == stored).withColumn(
        "total_ok", F.col("total") == stored + F.col("failed")).withColumn("valid", F.col("uploaded_ok") & F.col("total_ok"))


def mass_failure(ledger: DataFrame, failed: Column, rate: float = MASS_FAILURE_RATE) -> DataFrame:
    """A23."""
    n = F.coalesce(F.sum(F.when(failed, 1).otherwise(0)), F.lit(0))
    return ledger.agg(F.count(F.lit(1)).alias("total"), n.alias("failed")).withColumn(
        "failure_rate", F.coalesce(F.try_divide(F.col("failed"), F.col("total")), F.lit(0.0))
    ).withColumn("stop", F.col("failure_rate") > rate)


def reconcile_assets(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Per asset key: missing, hash mismatch, extra or ok.

    Remote is verified by size and metadata hash, else by content hash; an entity tag never counts.
    ``local``: key, size, sha256, sha256_again. ``remote``: key, size, meta_sha256, content_sha256.
    """
    r = remote.select(F.col("key").alias("_rk"), F.col("size").alias("_rs"), "meta_sha256", "content_sha256")
    both = local.join(r, F.col("key") == F.col("_rk"), "full_outer")
    proven = F.when(nonblank("meta_sha256"), (F.col("meta_sha256") == F.col("sha256")) & (F.col("_rs") == F.col("size"))).otherwise(
        F.col("content_sha256") == F.col("sha256"))
    status = (
        F.when(F.col("key").isNull(), "EXTRA").when(F.col("sha256") != F.col("sha256_again"), "LOCAL_HASH_UNSTABLE")
        .when(F.col("_rk").isNull(), "MISSING").when(F.coalesce(proven, F.lit(False)), "OK").otherwise("REMOTE_HASH_MISMATCH"))
    return both.select(F.coalesce("key", "_rk").alias("key"), status.alias("status"))


def reconcile_verdict(assets: DataFrame) -> DataFrame:
    """Counts and PASS or FAIL."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0))
    return assets.agg(
        n("OK").alias("ok"), n("MISSING").alias("missing"), n("REMOTE_HASH_MISMATCH").alias("mismatch"),
        n("LOCAL_HASH_UNSTABLE").alias("unstable"), n("EXTRA").alias("extra"),
    ).withColumn("verdict", F.when(F.col("missing") + F.col("mismatch") + F.col("unstable") == 0, "PASS").otherwise("FAIL"))


def rearm_failed(ledger: DataFrame) -> DataFrame:
    """Failed and stuck records go back to the state before, counters to zero.

    Downloads return to DISCOVERED; uploads to ``prior_status`` where known, else VERIFIED.
    """
    status = F.col("status")
    prior = F.nullif(text("prior_status"), F.lit("")) if "prior_status" in ledger.columns else F.lit(None).cast("string")
    back = F.when(status.isin("FAILED", "DOWNLOADING"), F.lit("DISCOVERED")).when(
        status.isin("UPLOAD_FAILED", "UPLOADING"), F.coalesce(prior, F.lit("VERIFIED")))
    hit = back.isNotNull()
    return ledger.withColumns({
        "retry_count": F.when(hit, 0).otherwise(F.col("retry_count")),
        "error_code": F.when(hit, F.lit(None)).otherwise(F.col("error_code")),
        "status": F.coalesce(back, status),
    })
