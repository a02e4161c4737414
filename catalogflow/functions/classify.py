"""Classification rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow import rules
from catalogflow.functions import units
from catalogflow.functions.attrs import json_map, to_variant
from catalogflow.functions.keys import _col, let, literal_map, text
from catalogflow.functions.text import ascii_only, collapse, has_illegal_text, is_ascii, normalize_text

UNCATEGORIZED = "Uncategorized"

# Families, and the level-1 slug each belongs to.
FAMILY_L1 = {
    "Microcontroller": "microcontrollers",
    "Voltage Regulator": "power-management",
    "Diode": "diodes",
    "Capacitor": "capacitors",
    "Interface IC": "interface-ics",
    "Operational Amplifier": "amplifiers-comparators",
    "MOSFET": "transistors",
    "Transistor": "transistors",
    "Logic IC": "logic-ics",
    "Resistor": "resistors",
    "Inductor": "inductors-coils-transformers",
}
# Parent catalogs that settle the family before any other signal.
PARENT_FAMILY = {"logic": "Logic IC", "amplifiers/comparators": "Operational Amplifier"}
# Unmapped English keys and description phrases that name one family only.
UNMAPPED_FINGERPRINT = (
    ("impedance @ frequency", "Inductor"),
    ("forward voltage", "Diode"),
    ("drain-source voltage", "MOSFET"),
    ("gate charge", "MOSFET"),
    ("collector-emitter breakdown voltage", "Transistor"),
)
PHRASE_FINGERPRINT = (
    ("ferrite bead", "Inductor"),
    ("dc dc switching", "Voltage Regulator"),
    ("switching regulator", "Voltage Regulator"),
    ("buck converter", "Voltage Regulator"),
    ("boost converter", "Voltage Regulator"),
)
# Enumerations and their English form.
ENUM = {
    "正": "Positive", "负": "Negative", "共阴": "Common Cathode", "共阳": "Common Anode",
    "单": "Single", "双": "Dual", "是": "Yes", "否": "No", "轨到轨": "Rail-to-Rail",
    "逻辑低": "Logic Low", "逻辑高": "Logic High", "增强型": "Enhancement", "耗尽型": "Depletion",
    "n沟道": "N-Channel", "p沟道": "P-Channel", "n-channel": "N-Channel", "p-channel": "P-Channel",
    "npn": "NPN", "pnp": "PNP",
}


def _map(d: dict) -> Column:
    return literal_map(d.items())


def family_l1() -> dict[str, str]:
    """Families with their level-1 slugs, added ones included."""
    return FAMILY_L1 | rules.mapping_of_added("family_l1")


def _parent_family() -> dict[str, str]:
    return PARENT_FAMILY | rules.mapping_of_added("parent_family")


def first_match(subject: Column, table, test) -> Column:
    """Value of the first rule whose pattern holds, null when none does."""
    out = F.lit(None).cast("string")
    for pattern, value in reversed(table):
        out = F.when(test(subject, pattern), F.lit(value)).otherwise(out)
    return out


def enum_value(c) -> Column:
    """mapped enumeration, other ASCII text as it is, the rest null."""
    s = text(c)
    return F.coalesce(_map(ENUM)[s], F.when(is_ascii(s), s))


def native_l1(parent, leaf) -> Column:
    """leaf override, then parent, else blank. Nothing is guessed."""
    norm = lambda c: F.lower(collapse(F.coalesce(_col(c), F.lit(""))))
    return F.coalesce(
        _map(rules.mapping("native_l1_leaf"))[norm(leaf)], _map(rules.mapping("native_l1_parent"))[norm(parent)], F.lit(""))


def detect_family(parent_catalog, catalog_name, category, description, attributes_json) -> Column:
    """struct<family, level, value, confidence>; the first level that answers wins."""
    low = lambda c: F.lower(text(c))
    rlike = lambda s, p: s.rlike(p)
    by_parent = _map(_parent_family())[low(parent_catalog)]
    by_catalog = first_match(low(catalog_name), rules.table("catalog_patterns"), rlike)
    by_category = _map({f.lower(): f for f in family_l1()})[low(category)]
    by_text = first_match(low(description), rules.table("description_patterns"), rlike)
    keys = F.json_object_keys(_col(attributes_json))
    by_key = F.lit(None).cast("string")
    hit_key = F.lit(None).cast("string")
    for key, family in reversed(rules.table("attribute_fingerprint")):
        by_key = F.when(F.array_contains(keys, key), F.lit(family)).otherwise(by_key)
        hit_key = F.when(F.array_contains(keys, key), F.lit(key)).otherwise(hit_key)

    def found(family, level, value, confidence):
        return F.struct(family.alias("family"), F.lit(level).alias("level"), value.alias("value"), F.lit(confidence).alias("confidence"))

    raw = lambda c: F.coalesce(_col(c), F.lit(""))
    unknown = found(F.lit(UNCATEGORIZED), "none", F.when(raw(catalog_name) != "", raw(catalog_name)).otherwise(raw(category)), "none")
    return (
        F.when(by_parent.isNotNull(), found(by_parent, "L0_parentCatalogName", raw(parent_catalog), "high"))
        .when(by_catalog.isNotNull(), found(by_catalog, "L1_catalogName", raw(catalog_name), "high"))
        .when(by_category.isNotNull(), found(by_category, "L2_category", raw(category), "high"))
        .when(by_text.isNotNull(), found(by_text, "L3_description", raw(description), "medium"))
        .when(by_key.isNotNull(), found(by_key, "L4_attributes", hit_key, "medium"))
        .otherwise(unknown)
    )


def detect_by_english_keys(canonical, unmapped, description) -> Column:
    """struct<family, level, matched> from canonical keys, unmapped keys, phrases; null if none."""
    canon_keys = F.map_keys(_col(canonical))
    other_keys = F.transform(F.map_keys(_col(unmapped)), lambda k: F.lower(k))
    has = lambda keys: (lambda _, k: F.array_contains(keys, k))
    table = [
        ("L4_en_attrs", rules.table("canonical_fingerprint"), has(canon_keys)),
        ("L4_en_attrs_unmapped", UNMAPPED_FINGERPRINT, has(other_keys)),
        ("L4_desc", PHRASE_FINGERPRINT, lambda s, p: s.contains(p)),
    ]
    out = F.lit(None).cast("struct<family:string,level:string,matched:string>")
    for level, pairs, test in reversed(table):
        for key, family in reversed(pairs):
            hit = F.struct(F.lit(family).alias("family"), F.lit(level).alias("level"), F.lit(key).alias("matched"))
            out = F.when(F.coalesce(test(F.lower(text(description)), key), F.lit(False)), hit).otherwise(out)
    return out


# ---- family projections (F44) -----------------------------------------------------

def _round_by(q: Column, rounding: Column) -> Column:
    """Round single numbers by the digits a rule names; ``int`` drops the fraction."""
    def rounded(num):
        out = F.when(rounding == "int", F.when(num >= 0, F.floor(num)).otherwise(F.ceil(num)).cast("double"))
        for digits in sorted({r[3] for r in rules.table("families") if r[3] not in ("", "int")}):
            out = out.when(rounding == digits, F.round(num, int(digits)))
        return out.otherwise(num)

    return units.map_number(q, rounded)


def _enum_quantity(c: Column) -> Column:
    value = enum_value(c)
    return F.when(F.coalesce(value, F.lit("")) != "", units.plain(value))


def _source_rules(family: Column) -> Column:
    """Projection rules of the row's family: array<struct<key, kind, rounding, sources>>."""
    def row(r):
        return F.struct(F.lit(r[1]).alias("key"), F.lit(r[2]).alias("kind"), F.lit(r[3]).alias("rounding"),
                        F.array(*[F.lit(x) for x in r[4].split("|")]).alias("sources"))

    by_family: dict[str, list[Column]] = {}
    for r in rules.table("families"):
        if r[4]:
            by_family.setdefault(r[0], []).append(row(r))
    pairs = [x for name, rows in by_family.items() for x in (F.lit(name), F.array(*rows))]
    return F.create_map(*pairs)[family]


def source_projection(family, attrs) -> Column:
    """Entries (key, q) of the row's family from source-language attributes. The rules are
    data inside one expression, so the plan does not grow with the number of families."""
    attrs = _col(attrs)

    def parse(rule):
        values = F.transform(rule["sources"], lambda s: F.when(
            rule["kind"] == "enum", _enum_quantity(attrs[s])).otherwise(units.parse_kind(attrs[s], rule["kind"])))
        return F.struct(rule["key"].alias("key"),
                        _round_by(F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0)), rule["rounding"]).alias("q"))

    return F.transform(_source_rules(_col(family)), parse)


def mcu_projection(description, core, bits, frequency, mpn) -> list[tuple[str, Column]]:
    """Controller facts: core and clock from attributes, the rest from the description."""
    facts = units.mcu_facts(description)
    n = lambda c, factor=1: F.when(c.isNotNull(), F.struct(
        F.lit("single").alias("kind"), (c * factor).cast("double").alias("num"), F.lit(None).cast("string").alias("text")))
    package = F.nullif(facts["package"], F.lit(""))
    return [
        ("core", units.plain(clean_core(core, mpn))),
        ("frequency_hz", n(F.nullif(units.whole_number(frequency), F.lit(0)), 1_000_000)),
        ("flash_bytes", n(F.nullif(facts["flash"], F.lit(0)), 1024)),
        ("ram_bytes", n(F.nullif(facts["ram"], F.lit(0)), 1024)),
        ("io_count", n(facts["io"])),
        ("voltage_v", n(facts["voltage"])),
        ("package", F.when(package.isNotNull(), units.plain(package))),
    ]


def assemble(entries) -> Column:
    """Quantities to map<string,variant>; blanks and text that is not publishable are left out."""
    return let(entries, _publishable)


def _publishable(entries: Column) -> Column:
    kept = F.filter(entries, lambda e: e["q"].isNotNull() & ~has_illegal_text(e["q"]["text"]))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), to_variant(e["q"]).alias("value"))))


def project_source(family, attributes_json, description, mpn) -> Column:
    """F44 for source-language rows; the family of the row picks the projection."""
    attrs = json_map(attributes_json)
    mcu = F.array(*[F.struct(F.lit(k).alias("key"), q.alias("q")) for k, q in mcu_projection(
        description, attrs["CPU内核"], attrs["CPU位数"], attrs["CPU最大主频"], mpn)])
    entries = F.when(_col(family) == "Microcontroller", mcu).otherwise(source_projection(family, attrs))
    return F.coalesce(assemble(entries), F.create_map().cast("map<string,variant>"))


def project_english(family, canonical) -> Column:
    """F44 for English rows: rounding rules of the family on the canonical map.

    Keys outside the family stay, as do ranges and lists; where a family reads a second key
    when its own is missing, the value appears under the family's key too.
    """
    m = _col(canonical)
    digits: dict[str, dict[str, str]] = {}
    alternates: dict[str, list[tuple[str, str]]] = {}
    for name, key, _, rounding, _, english in rules.table("families"):
        if rounding:
            digits.setdefault(name, {})[key] = rounding
        sources = english.split("|")
        if len(sources) > 1:
            alternates.setdefault(name, []).append((key, sources[1]))

    fam = _col(family)
    rule = F.create_map().cast("map<string,string>")
    for name, d in digits.items():
        rule = F.when(fam == name, _map(d)).otherwise(rule)

    def value(k, v):
        num = F.try_variant_get(v, "$", "double")
        numeric = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|DECIMAL)")
        fraction = F.schema_of_variant(v).rlike("^(DOUBLE|DECIMAL)")  # rounding to digits leaves whole numbers whole
        r = rule[k]
        out = F.when(numeric & (r == "int"), num.cast("long").cast("variant"))
        for n in sorted({int(x) for d in digits.values() for x in d.values() if x != "int"}):
            out = out.when(fraction & (r == str(n)), F.round(num, n).cast("variant"))
        return out.otherwise(v)

    extra = F.create_map().cast("map<string,variant>")
    for name, pairs in alternates.items():
        entries = F.array(*[F.struct(F.lit(k).alias("key"), m[src].alias("value")) for k, src in pairs])
        fill = F.filter(entries, lambda e: ~F.map_contains_key(m, e["key"]) & e["value"].isNotNull()
                        & F.schema_of_variant(e["value"]).rlike("^(BIGINT|DOUBLE|DECIMAL)"))
        extra = F.when(fam == name, F.map_from_entries(fill)).otherwise(extra)
    return F.transform_values(F.map_concat(extra, m), value)


# ---- controller cores and names (F19) ----------------------------------------------

def clean_core(core, mpn) -> Column:
    s = text(core)
    return F.when(s == "", "").when(is_ascii(s), s).when(F.upper(text(mpn)).startswith("TMS320"), "C28x").otherwise("")


# Core names and the subcategory they give.
CORES = (
    ("risc-v", "32-bit RISC-V MCU"), ("cortex-m7", "32-bit ARM Cortex-M7 MCU"), ("cortex-m4", "32-bit ARM Cortex-M4 MCU"),
    ("cortex-m3", "32-bit ARM Cortex-M3 MCU"), ("cortex-m0", "32-bit ARM Cortex-M0+ MCU"),
    ("cortex-m23", "32-bit ARM Cortex-M23 MCU"), ("cortex-m33", "32-bit ARM Cortex-M33 MCU"),
)


# Further core names; ``%s`` stands for the width. The last ones are asked for after the maker's part numbers.
CORE_FAMILIES = (
    ("avr", "%s-bit AVR MCU"), ("stm8", "8-bit STM8 MCU"), ("msp430", "16-bit MSP430 MCU"), ("c28x", "32-bit C28x DSC"), ("c2000", "32-bit C28x DSC"),
    ("pic", "%s-bit PIC MCU"), ("8051", "8-bit 8051 MCU"),
)
CORE_PART_PREFIX = (("TMS320", "32-bit C28x DSC"),)
OLD_CORES = (("arm926", "32-bit ARM926EJ-S MPU"), ("arm7tdmi", "32-bit ARM7TDMI MCU"))
CORE_DEFAULT, CORE_WIDTH_ONLY, CORE_WIDTH = "Microcontroller", "%s-bit MCU", "8"


def core_subcategory(core, bits, mpn) -> Column:
    """the first table that names the core or part decides."""
    name, part = F.lower(F.coalesce(_col(core), F.lit(""))), F.upper(text(mpn))
    width = F.nullif(_col(bits).cast("string"), F.lit("0"))
    sized = lambda template, w: F.replace(template, F.lit("%s"), w)
    holds = lambda s, p: s.contains(p)
    named = F.coalesce(first_match(name, CORES + CORE_FAMILIES, holds), first_match(part, CORE_PART_PREFIX, lambda s, p: s.startswith(p)), first_match(name, OLD_CORES, holds))
    return F.coalesce(sized(named, F.coalesce(width, F.lit(CORE_WIDTH))), sized(F.lit(CORE_WIDTH_ONLY), width), F.lit(CORE_DEFAULT))


# Per family the key of the subcategory, its wording, its default, and the
# facts a description lists with their format.
DESCRIPTION = {
    "Voltage Regulator": ("output_type", "%s", "Voltage Regulator", (("output_type", "%s"), ("output_voltage_v", "%.2f V"), ("output_current_a", "%.3f A"))),
    "Diode": ("config", "%s", "Diode", (("config", "%s"), ("vf_v", "%.2f V Vf"), ("vreverse_v", "%.1f V reverse"))),
    "Capacitor": ("temp_coef", "%s Capacitor", "Ceramic Capacitor", (("capacitance", "%s F"), ("rated_voltage_v", "%.1f V"), ("temp_coef", "%s"))),
    "Interface IC": ("interface", "%s", "Interface IC", (("interface", "%s"), ("data_rate", "%s bps"), ("working_voltage_v", "%.2f V"))),
    "Operational Amplifier": ("num_amps", "%s-Channel Op Amp", "Operational Amplifier", (("num_amps", "%s-channel"), ("gbw_hz", "GBW %s Hz"))),
    "MOSFET": ("chan_type", "%s MOSFET", "MOS MOSFET", (("chan_type", "%s"), ("vdss_v", "%.1f V"), ("id_a", "%.2f A"))),
    "Transistor": ("tran_type", "%s Transistor", "BJT Transistor", (("tran_type", "%s"), ("vceo_v", "%.1f V"), ("ic_a", "%.2f A"))),
    "Logic IC": ("function", "%s", "Logic IC", (("function", "%s"), ("supply_v", "%.2f V"), ("tpd_ns", "%s ns propagation"))),
    "Resistor": ("rtype", "%s Resistor", "Chip Resistor", (("resistance_ohm", "%s Ω"), ("max_voltage_v", "%.1f V"), ("power_w", "%s W"))),
    "Inductor": (None, "", "Power Inductor", (("inductance_h", "%s H"), ("rated_current_a", "%.3f A rated"))),
    "Microcontroller": ("core", "%s MCU", "Microcontroller", (("core", "%s"), ("flash_bytes", "%s B Flash"), ("io_count", "%s I/O"))),
}


def family_text(family, attrs, brand, mpn) -> Column:
    """struct<subcategory, description, keywords>; empty pieces are dropped."""
    m, fam = _col(attrs), _col(family)

    def shown(key, fmt):
        v = m[key]
        num, txt = F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "string")
        if "%." in fmt:  # numbers only; ranges and lists keep their text
            pattern = fmt.split(" ")[0]
            piece = F.coalesce(F.when(num.isNotNull(), F.format_string(pattern, num)), txt)
            return F.when(v.isNotNull(), F.concat(piece, F.lit(fmt[len(pattern):])))
        return F.when(v.isNotNull(), F.replace(F.lit(fmt), F.lit("%s"), txt))

    sub, pieces = F.lit(UNCATEGORIZED), F.array().cast("array<string>")
    for name, (key, fmt, default, facts) in DESCRIPTION.items():
        named = F.coalesce(shown(key, fmt), F.lit(default)) if key else F.lit(default)
        sub = F.when(fam == name, named).otherwise(sub)
        pieces = F.when(fam == name, F.array(*[shown(k, f) for k, f in facts])).otherwise(pieces)
    head = F.concat_ws(" ", _col(brand), _col(mpn))
    description = ascii_only(F.array_join(F.concat(F.array(head), F.filter(pieces, lambda p: F.coalesce(p, F.lit("")) != "")), " - "))
    keywords = ascii_only(F.array_join(F.filter(F.array(_col(mpn), sub, fam), lambda x: F.coalesce(x, F.lit("")) != ""), "; "))
    return F.struct(sub.alias("subcategory"), F.rtrim(F.regexp_replace(description, r"\.+$", "")).alias("description"), keywords.alias("keywords"))


def category_row(l1, detected) -> Column:
    """struct<category, needs_review>: the level-1 slug is the published category; a
    blank one holds the row for review."""
    return F.struct(
        F.when(_col(l1) != "", _col(l1)).otherwise(F.lit(UNCATEGORIZED)).alias("category"),
        (_col(l1) == "").alias("needs_review"), detected.alias("detected"))


def family_conflict(category, l1) -> Column:
    """P10: the family's own level-1 slug differs, both known."""
    implied = _map(family_l1())[_col(category)]
    return F.coalesce(implied.isNotNull() & (text(l1) != "") & (implied != _col(l1)), F.lit(False))


# Wording used to guess a type in review reports only.
_NO_FAMILY = " (no supported 11-family mapping)"
_AMBIGUOUS = " (ambiguous -> kept Uncategorized)"
_INFERRED = (
    (("connector", "header", "housing", "terminal", "contact"), "Connector" + _NO_FAMILY),
    (("switch",), "Switch / tactile" + _NO_FAMILY),
    (("fuse",), "Fuse / PTC" + _NO_FAMILY),
    (("memory",), "Memory" + _NO_FAMILY),
    (("rtc", "real-time clock"), "Real-Time Clock" + _NO_FAMILY),
    (("isola",), "Digital Isolator" + _NO_FAMILY),
    (("igbt",), "IGBT" + _NO_FAMILY),
    (("triac", "thyristor"), "TRIAC / Thyristor" + _NO_FAMILY),
    (("dsp",), "DSP" + _NO_FAMILY),
    (("digital-to-analog", "digital to analog", "converter"), "DAC / data converter" + _NO_FAMILY),
    (("touch",), "Capacitive-touch IC" + _NO_FAMILY),
    (("mems",), "MEMS sensor / IMU" + _NO_FAMILY),
    (("thermostat", "thermo"), "Thermostat / sensor" + _NO_FAMILY),
    (("filter",), "RF filter" + _NO_FAMILY),
    (("splitter",), "RF power splitter" + _NO_FAMILY),
    (("rf ",), "RF component" + _NO_FAMILY),
    (("shield",), "RFI shield" + _NO_FAMILY),
    (("hot swap",), "Hot-swap / power controller" + _AMBIGUOUS),
    (("supervisor",), "Voltage supervisor" + _AMBIGUOUS),
    (("voltage monitor",), "Voltage monitor" + _AMBIGUOUS),
    (("power management",), "Power-management IC" + _AMBIGUOUS),
)


def inferred_type(description) -> Column:
    """F70."""
    table = [(word, label) for words, label in _INFERRED for word in words]
    guess = first_match(F.lower(text(description)), table, lambda s, p: s.contains(p))
    return F.coalesce(guess, F.lit("unclear / no high-confidence 11-family signal"))


def english_text(c) -> Column:
    return normalize_text(c)
