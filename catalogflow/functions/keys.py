"""Identity keys and slugs (key modes K1-K7, F1-F8, F38-F39).

The key modes are not interchangeable: every operator names the one it compares by.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python and Java disagree on what \s means; the wide class matches both engines' data.
_SPACE = r"[\s ]"


def text(c) -> Column:
    """Trimmed text; null and blank are the same value."""
    return F.coalesce(F.trim(_col(c)), F.lit(""))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` worked out once, however often ``fn`` mentions it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def literal_map(pairs) -> Column:
    """Fixed text-to-text table as one literal; the optimizer evaluates it once per plan."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in dict(pairs).items())), F.lit("\x01"), F.lit("\x02"))


def nonblank(c) -> Column:
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def key_upper(c) -> Column:
    """K1."""
    return F.upper(text(c))


def key_nospace(c) -> Column:
    """K2: keeps + - . / because they tell parts apart."""
    return F.regexp_replace(F.lower(text(c)), _SPACE + "+", "")


def key_nospace_nohyphen(c) -> Column:
    """K3."""
    return F.regexp_replace(F.lower(text(c)), r"[\s -]", "")


def key_alnum(c) -> Column:
    """K4."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def key_noparen(c) -> Column:
    """K5."""
    return F.regexp_replace(F.lower(text(c)), r"[\s ()\-]", "")


def key_filesafe(c) -> Column:
    """K6: one dash per character that a path or object store may not carry."""
    return F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), "[^a-z0-9._-]", "-")


def key_exact(c) -> Column:
    """K7."""
    return text(c)


KEY_MODES = {
    "upper": key_upper,
    "nospace": key_nospace,
    "nospace_nohyphen": key_nospace_nohyphen,
    "alnum": key_alnum,
    "noparen": key_noparen,
    "filesafe": key_filesafe,
    "exact": key_exact,
}


def identity_columns(mode: str, mpn="mpn", brand="manufacturer", code="supplier_reference") -> list[Column]:
    """Key columns for an identity mode: ``mpn``, ``mpn_brand`` or ``code``."""
    if mode == "mpn":
        return [key_upper(mpn).alias("_k0")]
    if mode == "mpn_brand":
        return [key_upper(mpn).alias("_k0"), text(brand).alias("_k1")]
    if mode == "code":
        return [text(code).alias("_k0")]
    raise ValueError(f"unknown identity mode {mode!r}")


def slug_alnum(c) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), "[^a-z0-9]", "")


def slug_hyphen(c) -> Column:
    dashed = F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def slug_category(c) -> Column:
    """Hyphenated name, ``sub`` when nothing is left of it."""
    return F.coalesce(F.nullif(slug_hyphen(c), F.lit("")), F.lit("sub"))


def slug_unicode(c) -> Column:
    """Hyphenated name that keeps letters and digits of any script."""
    dashed = F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), r"[^\p{L}\p{N}]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def slug_base(c) -> Column:
    """Characters a published slug may hold."""
    return F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), "[^a-z0-9-]", "")


def search_keys(c) -> Column:
    """the typed form and the stripped form of a part number."""
    return F.sort_array(F.array_distinct(F.array(F.lower(text(c)), key_alnum(c))))


def part_aliases(slug, clean, mpn) -> Column:
    """lower-case names a part answers to, blanks left out."""
    names = F.array(*[F.lower(text(c)) for c in (slug, clean, mpn)])
    return F.array_distinct(F.filter(names, lambda x: x != ""))


def acronyms(name) -> Column:
    """initials of the words, and the capitals of the name, both lower case."""
    words = F.split(F.coalesce(_col(name), F.lit("")), r"\s+")
    initials = F.lower(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))
    capitals = F.lower(F.regexp_replace(F.coalesce(_col(name), F.lit("")), "[^A-Z]", ""))
    return F.array(initials, capitals)


def split_list(c, pattern: str = ";") -> Column:
    """F8: parts of a delimited text, trimmed, blanks dropped, order kept."""
    parts = F.transform(F.split(F.coalesce(_col(c), F.lit("")), pattern), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def split_multi(c) -> Column:
    return split_list(c, ";")


def split_specs(c) -> Column:
    return split_list(c, ",")


def merge_lists_ci(a: Column, b: Column) -> Column:
    """U5, case-insensitive variant: ``b`` adds only names ``a`` does not hold yet."""
    return F.aggregate(
        F.concat(a, b),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(
            F.array_contains(F.transform(acc, lambda y: F.lower(y)), F.lower(x)), acc
        ).otherwise(F.array_append(acc, x)),
    )


def merge_semicolon(a, b) -> Column:
    return F.array_join(merge_lists_ci(split_multi(a), split_multi(b)), "; ")


# ---- ids, hashes, URLs -------------------------------------------------------

def batch_id(day, strategy, count) -> Column:
    """``YYYYMMDD_STRATEGY_COUNT``."""
    return F.concat_ws("_", F.date_format(_col(day), "yyyyMMdd"), F.upper(_col(strategy)), _col(count).cast("string"))


def parse_batch_id(c) -> Column:
    """Day, strategy and count of a batch id; null when it is not one."""
    pattern = r"^(\d{8})_([A-Z0-9]+)_(\d+)$"
    c = _col(c)
    parsed = F.struct(
        F.try_to_timestamp(F.regexp_extract(c, pattern, 1), F.lit("yyyyMMdd")).cast("date").alias("day"),
        F.regexp_extract(c, pattern, 2).alias("strategy"),
        F.regexp_extract(c, pattern, 3).try_cast("long").alias("count"),
    )
    return F.when(c.rlike(pattern) & F.try_to_timestamp(F.regexp_extract(c, pattern, 1), F.lit("yyyyMMdd")).isNotNull(), parsed)


def content_key(prefix: str, sha) -> Column:
    """``prefix/aa/<sha>.pdf``."""
    return F.concat(F.lit(prefix + "/"), F.substring(_col(sha), 1, 2), F.lit("/"), _col(sha), F.lit(".pdf"))


def object_name(url) -> Column:
    """Last path element without query, fragment and the .pdf ending, lower case."""
    path = F.regexp_replace(text(url), r"[?#].*$", "")
    return F.regexp_replace(F.lower(F.substring_index(path, "/", -1)), r"\.pdf$", "")


def url_host(url) -> Column:
    """Lower-case host; blank for blank or malformed addresses."""
    raw = text(url)
    full = F.when(raw.startswith("//"), F.concat(F.lit("https:"), raw)).otherwise(raw)
    return F.lower(F.coalesce(F.try_parse_url(full, F.lit("HOST")), F.lit("")))


def hash_choice(c, options: int, divisor: int = 1) -> Column:
    """repeatable choice of 0..options-1 from the SHA-256 of a part number."""
    seed = F.conv(F.substring(F.sha2(_col(c), 256), 1, 8), 16, 10).cast("long")
    return (F.floor(seed / F.lit(divisor)) % options).cast("int")
