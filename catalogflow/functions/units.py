"""Quantities.

``parse_quantity`` returns struct<kind, num, text>: ``single`` has a number in SI base
units, ``range`` and ``multi`` keep their text, null means no measurement. A range or a list
of values is never averaged into one number.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow.functions.keys import _col, let, text

# Unit (lower case) and its factor to the SI base unit.
UNITS = {
    "voltage": {"mv": 1e-3, "v": 1.0},
    "current": {"pa": 1e-12, "na": 1e-9, "µa": 1e-6, "ua": 1e-6, "μa": 1e-6, "ma": 1e-3, "a": 1.0},
    "frequency": {"ghz": 1e9, "mhz": 1e6, "khz": 1e3, "hz": 1.0},
    "data_rate": {"gbps": 1e9, "mbps": 1e6, "kbps": 1e3, "bps": 1.0},
    "resistance": {"mω": 1e-3, "kω": 1e3, "ω": 1.0},
    "capacitance": {"pf": 1e-12, "nf": 1e-9, "µf": 1e-6, "uf": 1e-6, "μf": 1e-6, "mf": 1e-3, "f": 1.0},
    "inductance": {"µh": 1e-6, "uh": 1e-6, "μh": 1e-6, "mh": 1e-3, "h": 1.0},
    "power": {"mw": 1e-3, "kw": 1e3, "w": 1.0},
}
MEMORY = {"KB": 1024, "MB": 1024**2, "GB": 1024**3}

_FRAGMENT = r"^\s*[-+]?[\d.]+\s*[\p{L}\p{N}_µμΩΩ%^°/*\s]*$"
QUANTITY = "struct<kind:string,num:double,text:string>"


def _quantity(kind: str, num=None, txt=None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        (num if num is not None else F.lit(None)).cast("double").alias("num"),
        (txt if txt is not None else F.lit(None)).cast("string").alias("text"),
    )


def _nothing() -> Column:
    return F.lit(None).cast(QUANTITY)


def _measurements(s: Column, sep: str) -> Column:
    return F.size(F.filter(F.split(s, sep), lambda p: p.rlike(_FRAGMENT)))


def is_multi_value(c) -> Column:
    """two or more measurements. Thousands separators and fractional watts do not count."""
    s = text(c)
    # Most values hold no separator at all; they are settled by this one test.
    return s.rlike("[;,/]") & let(F.regexp_replace(s, r"(?<=\d),(?=\d{3}(?!\d))", ""), lambda t: (
        (_measurements(t, ";") >= 2) | (_measurements(t, ",") >= 2)
        | (_measurements(F.regexp_replace(t, r"(?i)\d+\s*/\s*\d+\s*W(?![A-Za-z])", ""), "/") >= 2)))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def parse_quantity(c, units: dict[str, float]) -> Column:
    """F32 with one unit table."""
    return let(text(c), lambda s: _parse(s, units))


def _parse(s: Column, units: dict[str, float]) -> Column:
    alt = "|".join(units)
    canon = F.regexp_replace(F.translate(s, "–—", "~~"), r"(\d)\s*-\s*(?=\d)", "$1~")
    span = rf"(?iu)([\d.]+)\s*({alt})?\s*~\s*([\d.]+)\s*({alt})?"
    lo, lo_u, hi, hi_u = (F.regexp_extract(canon, span, i) for i in (1, 2, 3, 4))
    lo_unit = F.when(lo_u != "", lo_u).otherwise(hi_u)
    hi_unit = F.when(hi_u != "", hi_u).otherwise(lo_u)

    one = F.lit(rf"(?iu)([\d.]+)\s*({alt})")
    factor = F.create_map(*[F.lit(x) for kv in units.items() for x in kv])
    larger = [F.lit(x) for u, f in units.items() if f > 1 for x in (u, f"e{round(math.log10(f))}")]

    def scale(n: Column, u: Column) -> Column:
        # a larger unit moves the point of the text, since a product is a little below a whole number at times (2058.7 * 1e3)
        product = n.try_cast("double") * factor[F.lower(u)]
        return F.coalesce(F.concat(n, F.create_map(*larger)[F.lower(u)]).try_cast("double"), product) if larger else product

    scaled = F.zip_with(F.regexp_extract_all(s, one, F.lit(1)), F.regexp_extract_all(s, one, F.lit(2)), scale)
    loose = F.transform(F.regexp_extract_all(s, F.lit(r"([\d.]+)"), F.lit(1)), lambda n: n.try_cast("double"))
    number = let(scaled, lambda xs: (
        F.when(F.size(xs) > 0, _mean(xs))
        .when(s.rlike(f"(?iu){alt}"), let(loose, lambda ys: F.when(F.size(ys) > 0, _mean(ys))))
        .when(s.rlike(r"^\s*[\d.]+\s*$"), s.try_cast("double"))
    ))
    return (
        F.when(s == "", _nothing())
        .when(s.rlike("[~–—-]") & canon.rlike(span), _quantity("range", txt=F.concat(lo, lo_unit, F.lit("~"), hi, hi_unit)))
        .when(is_multi_value(s), _quantity("multi", txt=s))
        .otherwise(let(number, lambda n: F.when(n.isNotNull(), _quantity("single", num=n))))
    )


def map_number(q: Column, fn) -> Column:
    """apply to single numbers only; ranges and lists pass unchanged."""
    return let(q, lambda x: _map_number(x, fn))


def _map_number(q: Column, fn) -> Column:
    return F.when(q["kind"] == "single", F.struct(q["kind"].alias("kind"), fn(q["num"]).cast("double").alias("num"), q["text"].alias("text"))).otherwise(q)


def round_single(q: Column, digits: int) -> Column:
    return map_number(q, lambda n: F.round(n, digits))


def int_single(q: Column) -> Column:
    return map_number(q, lambda n: n.cast("long"))


def voltage(c) -> Column:
    return parse_quantity(c, UNITS["voltage"])


def voltage_condition(c) -> Column:
    """a value with a test condition keeps its text."""
    s = text(c)
    return F.when(s.contains("@"), _quantity("condition", txt=s)).otherwise(voltage(c))


def current(c) -> Column:
    return parse_quantity(c, UNITS["current"])


def frequency(c) -> Column:
    return parse_quantity(c, UNITS["frequency"])


def data_rate(c) -> Column:
    return parse_quantity(c, UNITS["data_rate"])


def resistance(c) -> Column:
    return parse_quantity(F.translate(text(c), "ΩΩ", "ωω"), UNITS["resistance"])


def capacitance(c) -> Column:
    return round_single(parse_quantity(c, UNITS["capacitance"]), 12)


def inductance(c) -> Column:
    return parse_quantity(F.replace(text(c), F.lit("Ω"), F.lit("")), UNITS["inductance"])


def power(c) -> Column:
    """Fractions of a watt such as ``1/4W`` are one value."""
    s = text(c)
    pattern = r"(?i)(\d+)\s*/\s*(\d+)\s*W"
    top = F.regexp_extract(s, pattern, 1).try_cast("double")
    bottom = F.regexp_extract(s, pattern, 2).try_cast("double")
    ratio = F.try_divide(top, bottom)
    return (
        F.when(is_multi_value(s), _quantity("multi", txt=s))
        .when(s.rlike(pattern), F.when(ratio.isNotNull(), _quantity("single", num=ratio)))
        .otherwise(parse_quantity(s, UNITS["power"]))
    )


def memory(c) -> Column:
    pattern = r"(?i)([\d.]+)\s*(KB|MB|GB)"
    s = text(c)
    factor = F.create_map(*[F.lit(x) for kv in MEMORY.items() for x in kv])
    n = F.regexp_extract(s, pattern, 1).try_cast("double") * factor[F.upper(F.regexp_extract(s, pattern, 2))]
    return F.when(s.rlike(pattern) & n.isNotNull(), _quantity("single", num=F.floor(n)))


def number(c) -> Column:
    """the first number; a list of measurements keeps its text."""
    s = text(c)
    n = F.regexp_extract(s, r"([\d.]+)", 1).try_cast("double")
    return F.when(is_multi_value(s), _quantity("multi", txt=s)).when(n.isNotNull(), _quantity("single", num=n))


def whole_number(c) -> Column:
    """integer part of the first number."""
    return F.regexp_extract(text(c), r"(\d+(?:\.\d+)?)", 1).try_cast("double").cast("long")


def plain(c) -> Column:
    s = text(c)
    return F.when(s != "", _quantity("text", txt=s))


PARSERS = {
    "voltage": voltage, "current": current, "frequency": frequency, "data_rate": data_rate,
    "resistance": resistance, "capacitance": capacitance, "inductance": inductance, "power": power,
    "memory": memory, "number": number, "text": plain,
}


def parse_kind(value: Column, kind: Column) -> Column:
    """Parse with the parser that a rule table names in ``kind``."""
    out = _nothing()
    for name, fn in PARSERS.items():
        out = F.when(kind == name, fn(value)).otherwise(out)
    return out


def quantity_text(q: Column) -> Column:
    return F.coalesce(q["text"], q["num"].cast("string"))


def dash_range(c) -> Column:
    """a dash between two measurements becomes ``~``; other dashes stay."""
    side = r"(\d[\d.]*\s*[A-Za-zµΩ%°]*)"
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), side + r"\s*[–—-]\s*" + side, "$1~$2")


# ---- facts in a controller description -------------------------------------------

def mcu_facts(description) -> Column:
    """flash, RAM, I/O, package and supply range from free text."""
    d = text(description)

    def grab(pattern, i=1):
        return F.nullif(F.regexp_extract(d, pattern, i), F.lit(""))

    # Wording of the five facts.
    package = (r"(?i)(LQFP|QFP|QFN|TQFP|TFBGA|UQFN|VQFN|WLCSP|LGA|BGA|SOIC|SSOP|TSOP|SOP|MSOP|DFN|TSSOP)[-\s]?(\d+)")
    named = r"(?i)operating voltage\s*(\d+\.?\d*)\s*-\s*(\d+\.?\d*)\s*V"
    bare = r"(\d+\.?\d*)\s*-\s*(\d+\.?\d*)\s*V"
    vmin = F.coalesce(grab(named, 1), grab(bare, 1)).try_cast("double")
    vmax = F.coalesce(grab(named, 2), grab(bare, 2)).try_cast("double")
    return F.struct(
        grab(r"(?i)(\d+(?:\.\d+)?)\s*KB\s*Flash").try_cast("double").cast("long").alias("flash"),
        grab(r"(?i)(\d+)\s*\+?\s*\d*\s*KB\s*(?:SRAM|RAM)").try_cast("long").alias("ram"),
        grab(r"(\d+)\s*I/O").try_cast("long").alias("io"),
        F.concat_ws("-", F.upper(grab(package, 1)), grab(package, 2)).alias("package"),
        vmin.alias("vmin"), vmax.alias("vmax"),
        F.when((vmin != 0) & (vmax != 0), F.round((vmin + vmax) / 2, 2)).alias("voltage"),
    )


# ---- display (F30) ----------------------------------------------------------------

def format_number(x: Column) -> Column:
    """Up to three decimals, no trailing zeros."""
    return F.regexp_replace(F.format_string("%.3f", x), r"\.?0+$", "")


# The powers of ten that a double holds exactly; the factor that cuts a double into two halves of 26 bits.
_POWERS, _HALVES = tuple(10.0**i for i in range(23)), 2.0**27 + 1


def _product_less(u: Column, v: Column, w: Column) -> Column:
    """u * v - w, whose sign is exact where the product is next to ``w``: the rounding error of the product is worked out from halves of both factors (Dekker)."""
    high = lambda x: x * F.lit(_HALVES) - (x * F.lit(_HALVES) - x)
    facts = F.struct(u.alias("u"), v.alias("v"), (u * v).alias("p"), high(u).alias("uh"), high(v).alias("vh"))

    def less(x: Column) -> Column:
        ul, vl = x["u"] - x["uh"], x["v"] - x["vh"]
        error = ul * vl - (((x["p"] - x["uh"] * x["vh"]) - ul * x["vh"]) - x["uh"] * vl)
        return (x["p"] - w) + error

    return let(facts, less)


def format_scientific(x: Column, digits: int = 9) -> Column:
    """``%.9e`` as C and SQL write it, rounded from the double itself and at an exact half to an even digit.

    Java rounds the shortest text of a double: 1000000.1235 lies below that half, but its text is rounded up. Only where that text ends on a half are the
    double and the half compared, exactly from 1e-12 up to 1e33; beyond that Java's rounding stays.
    """
    longer = F.format_string(f"%.{digits + 1}e", x)

    def rounded_down(t: Column) -> Column:
        half = F.regexp_replace(F.substring_index(t, "e", 1), "[-.]", "").cast("double")
        shift = F.lit(digits + 1) - F.substring_index(t, "e", -1).cast("int")
        facts = F.struct(F.abs(x).alias("x"), half.alias("half"), shift.alias("shift"), F.get(F.array(*[F.lit(p) for p in _POWERS]), F.abs(shift)).alias("power"))
        above = let(facts, lambda f: F.when(f["shift"] >= 0, _product_less(f["x"], f["power"], f["half"])).otherwise(-_product_less(f["half"], f["power"], f["x"])))
        return (t.cast("double") == x) & let(above, lambda d: (d < 0) | ((d == 0) & t.rlike(r"[02468]\.?5e")))

    return let(longer, lambda t: F.when(t.contains("5e") & rounded_down(t), F.replace(t, F.lit("5e"), F.lit("e"))).otherwise(F.format_string(f"%.{digits}e", x)))


# Smallest number shown in a unit, the number one unit stands for, the unit.
# The last row of a table is used for everything smaller.
_SCALES = {
    "data_rate": ((1e9, 1e9, " Gbps"), (1e6, 1e6, " Mbps"), (1e3, 1e3, " kbps"), (None, 1.0, " bps")),
    "bytes": ((1024.0**3, 1024.0**3, " GB"), (1024.0**2, 1024.0**2, " MB"), (1024.0, 1024.0, " KB"), (None, 1.0, " B")),
    "hz": ((1e9, 1e9, " GHz"), (1e6, 1e6, " MHz"), (1e3, 1e3, " kHz"), (None, 1.0, " Hz")),
    "ns": ((1e6, 1e6, " ms"), (1e3, 1e3, " µs"), (None, 1.0, " ns")),
    "ohm": ((1e3, 1e3, "kΩ"), (1.0, 1.0, "Ω"), (None, 1e-3, "mΩ")),
    "ampere": ((1.0, 1.0, " A"), (1e-3, 1e-3, " mA"), (None, 1e-6, " µA")),
    "henry": ((1.0, 1.0, " H"), (1e-3, 1e-3, " mH"), (1e-6, 1e-6, " µH"), (1e-9, 1e-9, " nH"), (None, 1.0, " H")),
    "farad": ((1e-3, 1e-3, " mF"), (1e-6, 1e-6, " µF"), (1e-9, 1e-9, " nF"), (None, 1e-12, " pF")),
    "title_bytes": ((1e6, 1e6, " MB"), (1024.0, 1024.0, " KB"), (None, 1.0, " B")),
}
_SIGNED = ("ampere", "henry", "farad")
_ZERO = {"ampere": "0 A", "henry": "0 µH", "farad": "0 F"}
_SCALE_TYPE = "struct<one:double,unit:string>"


def _scale(one: float, unit: str) -> Column:
    return F.struct(F.lit(float(one)).alias("one"), F.lit(unit).alias("unit"))


def _pick_scale(name: str, num: Column) -> Column:
    """Row of a scale table for a number."""
    size = F.abs(num) if name in _SIGNED else num
    *steps, last = _SCALES[name]
    out = _scale(last[1], last[2])
    for limit, one, unit in reversed(steps):
        out = F.when(size >= limit * (1 - 1e-9) if name == "farad" else size >= limit, _scale(one, unit)).otherwise(out)
    return out


def _show(num: Column, scale: Column) -> Column:
    return let(scale, lambda x: F.concat(format_number(num / x["one"]), x["unit"]))


def format_scaled(name: str, num: Column) -> Column:
    shown = _show(num, _pick_scale(name, num))
    return F.when(num == 0, F.lit(_ZERO[name])).otherwise(shown) if name in _ZERO else shown


# The spellings of a temperature span, its reference point, a condition and a worded span; what may be left of a cut list.
_SPAN = r"(\+?-?\d+(?:\.\d+)?)\s*degC\s*~\s*(\+?-?\d+(?:\.\d+)?)\s*degC"
_POINT = r"(@\((?:Tj|TJ|Ta|TA)\))"
_CONDITION = r"(\w+)@(\d+(?:\.\d+)?)\s*degC"
_WORDED = r"(-?\d+(?:\.\d+)?)\s*°?C\s+to\s+(\+?-?\d+(?:\.\d+)?)\s*°?C"
_UNIT = r"(?<=[\d±+\-/])degC"
_CUT_ENDS = r"^-\s*;(?:\s*;)?\s*|^;\s*|;?\s*-$"


def _temperature_shapes() -> list[tuple[str, str, bool]]:
    """(pattern, how it is shown, whether the text without cut ends must be the whole of it), in the order they are tried."""
    spans = []
    for n in (1, 2):
        shown = "; ".join(f"${2 * k + 1}°C ~ ${2 * k + 2}°C" for k in range(n))
        listed = r"\s*;\s*".join([_SPAN] * n)
        spans += [(f"^{listed}{_POINT}$", f"{shown} ${2 * n + 1}", True), (f"^{listed}$", shown, True)]
    return [*spans, (_CONDITION, "$1 @ $2°C", False), (_WORDED, "$1°C ~ $2°C", False)]


def format_temperature(c) -> Column:
    """Temperature shapes only; null for anything else."""
    facts = F.struct(text(c).alias("whole"), F.regexp_replace(text(c), _CUT_ENDS, "").alias("core"))

    def shown(x: Column) -> Column:
        unit_only = F.when(x["whole"].rlike(_UNIT), F.replace(x["whole"], F.lit("degC"), F.lit("°C")))
        rows = [(x["core" if bare else "whole"], pattern, template) for pattern, template, bare in _temperature_shapes()]
        named = reduce(lambda rest, r: F.when(r[0].rlike(r[1]), F.regexp_replace(*r)).otherwise(rest), reversed(rows), unit_only)
        return F.when(x["whole"].rlike("degC|°C"), named)

    return let(facts, shown)


# Key suffix and the unit its values already carry, or the scale that picks one.
_DIRECT_UNITS = (
    ("_bits", " bit"), ("_db", " dB"), ("_mm", " mm"), ("_nv", " nV"), ("_uv", " µV"), ("_vus", " V/µs"),
    ("_v", " V"), ("_volt", " V"), ("_mohm", " mΩ"), ("_pf", " pF"), ("_uh", " µH"), ("_w", " W"),
)
_SUFFIX_SCALES = (("_bytes", "bytes"), ("_hz", "hz"), ("_ns", "ns"), ("_a", "ampere"), ("_ohm", "ohm"), ("_h", "henry"))


def format_value(key, value) -> Column:
    """display text of an attribute value, unit chosen by the key."""
    raw = _col(value).cast("string")
    s = text(value)
    facts = F.struct(
        F.lower(text(key)).alias("k"), s.alias("s"), raw.alias("raw"),
        F.when(s.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), s.try_cast("double")).alias("num"))
    return F.when(raw.isNotNull(), F.coalesce(format_temperature(value), let(facts, _by_suffix)))


def _by_suffix(x: Column) -> Column:
    k, s, num, raw = x["k"], x["s"], x["num"], x["raw"]
    farad = (k == "capacitance") | k.endswith("_coss")
    rows = [(farad, _pick_scale("farad", num)), (k == "data_rate", _pick_scale("data_rate", num))]
    rows += [(k == "gate_charge_c", _scale(1, " nC")), (k == "tolerance", _scale(1, " %"))]
    rows += [(k.endswith(e), _scale(1, u)) for e, u in _DIRECT_UNITS]
    rows += [(k.endswith(e), _pick_scale(name, num)) for e, name in _SUFFIX_SCALES]
    scale = reduce(lambda acc, r: F.when(r[0], r[1]).otherwise(acc), reversed(rows), F.lit(None).cast(_SCALE_TYPE))
    bit = r"(?i)^[+]?(-?\d+(?:\.\d+)?)\s*bit$"
    zero = F.when(farad, F.lit("0 F")).when(k.endswith("_a"), F.lit("0 A")).when(k.endswith("_h"), F.lit("0 µH"))
    return (
        F.when(s.rlike(bit), F.concat(format_number(F.regexp_extract(s, bit, 1).try_cast("double")), F.lit(" bit")))
        .when(num.isNull(), raw)
        .otherwise(F.coalesce(F.when(num == 0, zero), _show(num, scale), raw))
    )


def title_value(key, value) -> Column:
    """Display value for a title: a bare number gets the unit its key implies."""
    facts = F.struct(format_value(key, value).alias("shown"), F.lower(text(key)).alias("k"))
    return let(facts, lambda x: let(F.struct(
        x["shown"].alias("shown"), x["k"].alias("k"),
        F.when(F.trim(x["shown"]).rlike(r"^-?\d+(\.\d+)?$"), F.trim(x["shown"]).try_cast("double")).alias("num")), _implied_unit))


def _implied_unit(x: Column) -> Column:
    shown, k, num = x["shown"], x["k"], x["num"]
    # Words in a key and what a bare number under it is measured in.
    volt = k.rlike("voltage|vds|vceo|vgs|vrrm|vreverse|vforward|vf") & ~k.contains("current")
    amp = k.rlike("current|id_|ic_|ib_|iq_") & ~k.contains("voltage")
    rows = [
        (k.rlike("frequency|clock|speed"), _pick_scale("hz", num)), (k.contains("memory"), _pick_scale("title_bytes", num)),
        (volt, F.lit(" V")), (amp, F.lit(" A")), (k.rlike("rds|resistance|impedance|dcr"), _pick_scale("ohm", num)),
        (k.contains("capacitance"), _pick_scale("farad", num)), (k.contains("inductance"), F.lit(" µH")),
        (k.contains("power") | k.endswith("_w"), F.lit(" W")),
    ]
    plain = {2, 3, 6, 7}
    out = shown
    for i, (cond, v) in reversed(list(enumerate(rows))):
        out = F.when(cond, F.concat(F.trim(shown), v) if i in plain else _show(num, v)).otherwise(out)
    return F.when(num.isNull(), shown).otherwise(out)
