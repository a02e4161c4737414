"""Text clean-up and predicates (P5, P6, P16-P19, F9-F29 in part)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow import rules
from catalogflow.functions.keys import _col, literal_map, text

# Symbols kept in otherwise ASCII text.
LEGAL_SYMBOLS = "±°"
# Technical symbols and their ASCII form.
UNIT_FOLD = (
    ("℃", "°C"), ("µ", "u"), ("μ", "u"), ("Ω", "Ohm"), ("Ω", "Ohm"), ("×", "x"),
    ("√", "sqrt"), ("²", "2"), ("³", "3"), ("·", "-"), (" ", " "), (" ", " "),
)
# Symbols that were decoded with the wrong code page, and what they stand for.
MOJIBAKE = {"卤": "±", "碌": "µ", "惟": "Ω", "掳": "°"}
MOJIBAKE_WIDE = {**MOJIBAKE, "：": ":"}

CJK = "[一-鿿]"
CJK_WIDE = r"[　-〿㐀-䶿一-鿿豈-﫿＀-￯]"

_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def _str(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def has_illegal_text(*cols, allow: str = LEGAL_SYMBOLS) -> Column:
    """P5: any character beyond ASCII other than the allowed symbols."""
    return F.concat_ws("", *[_str(c) for c in cols]).rlike(rf"[^\x00-\x7F{allow}]")


def has_cjk(c, wide: bool = False) -> Column:
    """P6."""
    return _str(c).rlike(CJK_WIDE if wide else CJK)


def is_ascii(c) -> Column:
    return _str(c).rlike(r"^[\x00-\x7F]+$")


def half_width(c) -> Column:
    """full-width ASCII characters and the ideographic space."""
    return F.translate(_str(c), _FULL, _HALF)


def _replace_all(c: Column, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def fold_units(c) -> Column:
    """F10."""
    return _replace_all(_str(c), UNIT_FOLD)


def collapse(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def ascii_gate(c) -> Column:
    """everything that is neither ASCII nor a legal symbol becomes one blank."""
    return collapse(F.regexp_replace(_str(c), rf"[^\x00-\x7F{LEGAL_SYMBOLS}]", " "))


def normalize_text(c) -> Column:
    """units, then width, then the gate."""
    return ascii_gate(half_width(fold_units(c)))


def ascii_only(c) -> Column:
    return F.trim(F.regexp_replace(_str(c), r"[^\x00-\x7F]", " "))


def repair_mojibake(c, colon: bool = True) -> Column:
    """F12."""
    table = MOJIBAKE_WIDE if colon else MOJIBAKE
    return F.translate(_col(c), "".join(table), "".join(table.values()))


def strip_cjk(c) -> Column:
    return F.regexp_replace(_col(c), CJK_WIDE, "")


def strip_control(c) -> Column:
    return F.regexp_replace(_col(c), r"[\x00-\x1f\x7f]", "")


def normalize_visible(c) -> Column:
    """repaired symbols, remaining CJK removed."""
    return strip_cjk(repair_mojibake(c))


def sanitize_desc(c) -> Column:
    """price, stock and availability phrases out of a description."""
    out = _str(c)
    # Phrases removed, in this order.
    for pattern in (
        r"(?i)From\s*\$\s*[\d.,]+",
        r"(?i),?\s*[\d,]+\s*in stock",
        r"(?i)in stock",
        r"(?i),?\s*[\d,]+\s*available",
    ):
        out = F.regexp_replace(out, pattern, "")
    return F.regexp_replace(normalize_visible(collapse(out)), r"^[ ,;]+|[ ,;]+$", "")


_HTML = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def escape_html(c) -> Column:
    """symbols repaired and control characters removed first."""
    return _replace_all(strip_control(repair_mojibake(_str(c), colon=False)), _HTML)


def unescape_html(c) -> Column:
    pairs = [(b, a) for a, b in _HTML[1:]] + [("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
    return _replace_all(_str(c), pairs)


def clean_package(c) -> Column:
    """package without its trailing body size; placeholders are blank."""
    s = text(c)
    short = F.when(s.endswith(")") & s.contains("("), F.trim(F.regexp_replace(s, r"\([^(]*\)$", ""))).otherwise(s)
    return F.when(s.isin("-", "SMD") | short.isin("-", "SMD"), F.lit("")).otherwise(short)


def display_package(c) -> Column:
    """body size kept for the specification table."""
    s = text(c)
    return F.when(s.isin("-", "SMD"), F.lit("")).when(s.contains("(") & s.endswith(")"), s).otherwise(clean_package(c))


def strip_count(c) -> Column:
    """name without a trailing count such as ``(1,234)``."""
    return F.trim(F.regexp_replace(_str(c), r"\s*\([\d,]+\)\s*$", ""))


# ---- FAQ text -----------------------------------------------------------------

def parse_faq(c) -> Column:
    """``Q: …?A: …`` text to an array of (question, answer)."""
    chunks = F.filter(F.transform(F.split(_str(c), r"Q\s*:"), lambda x: F.trim(x)), lambda x: x.contains("?") & x.contains("A:"))
    return F.transform(chunks, lambda x: F.struct(
        F.trim(F.substring_index(x, "?", 1)).alias("question"),
        F.trim(F.regexp_replace(_after(x, "?"), r"(?s)^.*?A:", "")).alias("answer"),
    ))


def _after(x: Column, mark: str) -> Column:
    return F.regexp_replace(x, r"(?s)^[^" + mark + "]*" + "\\" + mark, "")


def faq_text(pairs) -> Column:
    """F23, the other way."""
    return F.array_join(
        F.transform(_col(pairs), lambda p: F.concat(F.lit("Q: "), p["question"], F.lit("?A: "), p["answer"])), "; ")


def faq_offbrand(c) -> Column:
    """Mentions the supplier by name, or a price."""
    return _str(c).rlike(r"(?i)LCSC|\$\s?\d")


# Wording of commerce questions, which are not about the part itself.
PLATFORM_PATTERNS = (
    r"\$\s?\d",
    r"\bprice\b|\bpricing\b|\bcost\b|\bquote\b",
    r"\bin stock\b|\bstock level\b|\binventory\b|\bmoq\b|\bminimum order",
    r"\bbuy\b|\bpurchase\b|\border online\b|\border now\b|\bplace an order\b|\badd to cart\b|\bcheckout\b",
    r"\bshipping\b|\bshipment\b|\bdeliver\b|\bdelivery\b|\blead[- ]?time\b",
    r"\baccount\b|\blogin\b|\bregister\b|\bsign[- ]?in\b",
    r"\blcsc\b|our website|the website|\bmarketplace\b",
    r"\breturn policy\b|\bwarranty claim\b|\bcustomer service\b|\btrack my order\b",
)


def faq_platform(question, answer) -> Column:
    """About price, stock, orders, shipping or accounts."""
    return F.lower(F.concat_ws(" ", _str(question), _str(answer))).rlike("|".join(PLATFORM_PATTERNS))


def plain_words(c) -> Column:
    """Lower case, letters and digits only, one blank between words."""
    return collapse(F.regexp_replace(F.lower(_str(c)), "[^a-z0-9 ]", " "))


# Words that mean the same in a question.
FAQ_SYNONYMS = {
    "operational": "operating", "operation": "operating", "temp": "temperature", "temps": "temperature",
    "spec": "specification", "specs": "specification", "params": "parameters", "param": "parameter",
    "pkg": "package", "packaging": "package", "ic": "chip", "mcu": "microcontroller",
    "max": "maximum", "min": "minimum", "vol": "voltage", "curr": "current", "freq": "frequency",
}


def question_key(c) -> Column:
    """sorted set of synonym-folded words."""
    syn = literal_map(FAQ_SYNONYMS.items())
    words = F.filter(F.split(plain_words(c), " "), lambda w: w != "")
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.coalesce(syn[w], w))))


def same_question(a, b) -> Column:
    """same words, or one set of words inside the other."""
    ka, kb = question_key(a), question_key(b)
    covered = (F.size(F.array_except(ka, kb)) == 0) | (F.size(F.array_except(kb, ka)) == 0)
    return (plain_words(a) == plain_words(b)) | ((F.size(ka) > 0) & (F.size(kb) > 0) & covered)


# ---- concepts, product type, names --------------------------------------------

def concept(c) -> Column:
    """first concept whose phrase the key contains, else its normalised text."""
    s = F.regexp_replace(F.regexp_replace(F.lower(_str(c)), r"\([^)]*\)", " "), "[^a-z0-9 ]", " ")
    out = collapse(s)
    for label, phrases in reversed(rules.table("concept_rules")):
        hit = F.lit(False)
        for phrase in phrases.split("|"):
            hit = hit | s.contains(phrase)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def cosmetic(c) -> Column:
    """two spellings fixed for display."""
    return F.regexp_replace(F.replace(_str(c), F.lit("plusminus"), F.lit("+/-")), "(?i)degc", "degC")


# Wording that names a product type.
_TYPE_PATTERNS = (
    ("connector", r"connector|receptacle|header|terminal block|rj45|hdmi|usb connector"),
    ("mcu_ic", r"mcu|microcontroller|micro[- ]controller|mpu|fpga|dsp|asic|soc|processor|"
               r"\bcpu\b|integrated circuit|\bic\b|logic|memory|flash|eeprom|voltage regulator|"
               r"amplifier|adc|dac|op[- ]?amp|transistor|diode|mosfet|gate driver|led driver|"
               r"power management|switching|linear regulator"),
    ("module", r"module|modules|wifi|rf module|wireless|ethernet|lora|ble|bluetooth|"
               r"gps|gsm|lte|nb-iot|zigbee"),
)
# Wording of the two life cycle states.
_EOL = (r"\b(eol|obsolete|nrnd|discontinued|end[- ]of[- ]life|last[- ]time[- ]buy|"
        r"not recommended for new design)\b")
_SCARCE = r"(scarce|shortage|hard[- ]to[- ]find|allocated|long[- ]lead|low[- ]stock|out[- ]of[- ]stock)"


def product_type(subcategory, native_l1) -> Column:
    """type from the subcategory, else from the level-1 text."""
    def of(c):
        out = F.lit(None).cast("string")
        for label, pattern in reversed(_TYPE_PATTERNS):
            out = F.when(F.lower(_str(c)).rlike(pattern), F.lit(label)).otherwise(out)
        return out
    return F.coalesce(of(subcategory), of(native_l1), F.lit("other"))


def lifecycle(subcategory, native_l1) -> Column:
    """stated life cycle only; nothing is inferred from blanks."""
    blob = F.lower(F.concat_ws(" ", _str(subcategory), _str(native_l1)))
    return F.when(blob.rlike(_EOL), "eol").when(blob.rlike(_SCARCE), "scarce").otherwise("normal")


def keyword_category(c) -> Column:
    """category of the first keyword the lower-case name contains, else blank."""
    low = F.lower(_str(c))
    out = F.lit("")
    for keyword, category in reversed(rules.table("category_keywords")):
        out = F.when(low.contains(keyword), F.lit(category)).otherwise(out)
    return out


# Words of company introductions that end up in a brand field.
BLOB_WORDS = ("有限公司", "公司", "研发", "高新技术", "企业", "专注于", "是一家", "主要", "产品", "导体", "新能源")


def brand_blob(c, max_length: int = 40) -> Column:
    """A brand field that holds a description."""
    s = text(c)
    return (F.length(s) > max_length) | s.rlike("|".join(BLOB_WORDS))


def short_abbreviation(c) -> Column:
    """Three characters, or four capitals, do not identify a maker on their own."""
    s = text(c)
    return (F.length(s) <= 3) | s.rlike("^[A-Z]{1,4}$")


def owned_asset(c, prefixes) -> Column:
    """Links under one of the given prefixes."""
    out = F.lit(False)
    for p in prefixes:
        out = out | text(c).startswith(p)
    return out


def as_text(c) -> Column:
    """empty containers and spelled-out nulls are blank."""
    s = text(c)
    return F.when(s.isin("[]", "{}", "null", "None", "undefined"), F.lit("")).otherwise(s)


# ---- labels --------------------------------------------------------------------

_PLAIN_WORD = r"^[^\p{Lu}\d/\-]*\p{Ll}[^\p{Lu}\d/\-]*$"
# Words that stay lower case inside a label.
_SMALL_WORDS = ("a", "an", "as", "at", "and", "by", "de", "for", "from", "in", "into", "of", "on", "or",
                "per", "the", "to", "via", "with")


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))


def _title(c: Column) -> Column:
    return F.array_join(
        F.transform(F.regexp_extract_all(F.lower(c), F.lit("([a-z]+|[^a-z]+)"), F.lit(1)), _capital), "")


def _prose_title(c: Column) -> Column:
    pieces = F.regexp_extract_all(c, F.lit(r"(\s+|(?:\([^()]*\)|[^\s(])+|\()"), F.lit(1))

    def cased(piece, i):
        small = (i > 0) & piece.isin(*[w for w in _SMALL_WORDS if len(w) <= 3])
        return (
            F.when(~piece.rlike(_PLAIN_WORD) | small | ~piece.rlike(r"^\p{L}"), piece).otherwise(_capital(piece))
        )

    return F.array_join(F.transform(pieces, cased), "")


def human_label(c) -> Column:
    """mapped label, else prose in title case with abbreviations left as they are,
    else the key with underscores as blanks in title case."""
    k = text(c)
    labels = literal_map(rules.table("attribute_label"))
    return (
        F.when(k == "", k)
        .otherwise(F.coalesce(
            labels[k],
            F.when(k.contains(" "), _prose_title(k)).otherwise(_title(F.replace(k, F.lit("_"), F.lit(" ")))),
        ))
    )


# ---- translation ----------------------------------------------------------------

def longest_first(pairs) -> list[tuple[str, str]]:
    """Replacement rules by length of the text they replace; ties keep file order."""
    return sorted(pairs, key=lambda kv: -len(kv[0]))


def translate_value(c) -> Column:
    """substring rules longest first, then units, then width; blanks collapsed."""
    value = [(r[0], r[1] if len(r) > 1 else "") for r in rules.table("value_translation")]
    unit = [(r[0], r[1] if len(r) > 1 else "") for r in rules.table("unit_translation")]
    s = _replace_all(_str(c), longest_first(value) + longest_first(unit))
    return collapse(half_width(s))


def translate_key(c) -> Column:
    """curated dictionary, unknown names unchanged."""
    d = literal_map(rules.table("attribute_dictionary"))
    return F.coalesce(d[_col(c)], _col(c))
