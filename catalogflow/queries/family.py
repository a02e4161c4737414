"""Queries over family projections (F18-F20, F36, F37, F42, F44): all eleven families, from source attributes and from English ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import classify, units
from catalogflow.queries.registry import query

# Of each family: source attributes (``#`` is the part's key), and the canonical keys with a number in SQL or a quoted text. Values cover first and
# second source keys, rounding, ranges and lists that are not rounded, enumerations with and without an English form.
FAMILIES = (
    ("Microcontroller", {"CPU内核": "ARM Cortex-M3", "CPU最大主频": "#MHz"},
     {"core": "'ARM Cortex-M3'", "frequency_hz": "nullif(ord,0)*1e6", "flash_bytes": "nullif(ord,0)*1024", "ram_bytes": "20480", "io_count": "7", "voltage_v": "2.8", "package": "'LQFP-48'"}),
    ("Voltage Regulator", {"输出类型": "单", "输出电压": "#.12346V", "输出极性": "正", "输出电流": "#mA", "工作电压": "3V~#V", "开关频率": "#.7kHz", "通道数": "2.9", "精度": "±#%"},
     {"output_type": "'Single'", "output_voltage_v": "ord+0.1235", "polarity": "'Positive'", "output_current_a": "ord/1000", "working_voltage_v": "'3V~'||ord||'V'", "switching_freq_hz": "ord*1000+700", "channels": "2", "tolerance": "ord"}),
    ("Diode", {"二极管配置": "共阴", "整流电流": "#mA", "正向压降(Vf)": "550mV", "直流反向耐压（Vr）": "#V", "反向恢复时间(trr)": "35.9ns", "极性": "某某"},
     {"config": "'Common Cathode'", "forward_current_a": "ord/1000", "vf_v": "0.55", "vreverse_v": "ord", "trr_ns": "35"}),
    ("Capacitor", {"容值": "#nF", "额定电压": "#V", "温度系数": "X7R", "精度": "±10%", "等效串联电阻(ESR)": "12.3456789mΩ"},
     {"capacitance": "ord*1e-9", "rated_voltage_v": "ord", "temp_coef": "'X7R'", "tolerance": "10", "esr_ohm": "0.012346"}),
    ("Interface IC", {"数据速率": "#Mbps", "类型": "RS-485", "元件数": "4", "工作电压": "5V"}, {"data_rate": "ord*1e6", "interface": "'RS-485'", "elem_count": "4", "working_voltage_v": "5"}),
    ("Operational Amplifier", {"放大器数": "2", "增益带宽积(GBW)": "#kHz", "共模抑制比(CMRR)": "90dB", "轨到轨": "是", "静态电流(Iq)": "#uA"},
     {"num_amps": "2", "gbw_hz": "ord*1e3", "cmrr_db": "90", "rail_to_rail": "'Yes'", "iq_a": "ord*1e-6"}),
    ("MOSFET", {"漏源电压(Vdss)": "#V", "连续漏极电流(Id)": "5.8A", "类型": "n沟道", "耗散功率(Pd)": "1/4W", "阈值电压(Vgs(th))": "1.23456V", "导通电阻": "28mΩ"},
     {"vdss_v": "ord", "id_a": "5.8", "chan_type": "'N-Channel'", "pd_w": "0.25", "vgs_th_v": "1.2346", "rds_on_ohm": "0.028"}),
    ("Transistor", {"集电极电流(Ic)": "#0mA", "晶体管类型": "npn", "集射极击穿电压(Vceo)": "#V", "可控硅类型": "某某"}, {"ic_a": "ord/100", "tran_type": "'NPN'", "vceo_v": "ord"}),
    ("Logic IC", {"工作电压": "2.5V", "功能": "AND Gate", "逻辑单元数": "4.9", "传播延迟(tpd)": "#.5ns", "拉电流(IOH)": "1mA;#mA"}, {"supply_v": "2.5", "function": "'AND Gate'", "gates": "4", "tpd_ns": "ord+0.5", "ioh_a": "'1mA;'||ord||'mA'"}),
    ("Resistor", {"阻值": "#kΩ", "电阻类型": "厚膜", "最大工作电压": "#V", "功率": "250mW"}, {"resistance_ohm": "ord*1e3", "max_voltage_v": "ord", "power_w": "0.25"}),
    ("Inductor", {"电感值": "#uH", "额定电流": "#mA", "直流电阻(DCR)": "#mΩ", "线路数": "1"}, {"inductance_h": "ord*1e-6", "rated_current_a": "ord/1000", "dcr_ohm": "ord/1000", "lines": "1"}),
)
_FACTS = "x #KB Flash 20KB SRAM 7 I/O LQFP-48 2.0-3.6V"


def _attributes_sql() -> str:
    parts = []
    for i, (family, _, out) in enumerate(FAMILIES):
        for key, value in out.items():
            text = value if value.startswith("'") else f"format('{{:.9e}}', CAST({value} AS DOUBLE))"
            parts.append(f"SELECT ord, '{family}' AS family, '{key}' AS key, {text} AS value FROM parts_v WHERE ord%11={i}")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"


def _sources(spark, sf):
    """Each part in one family by its key, with the attributes of that family as JSON text."""
    n, turn = F.col("ord").cast("string"), (F.col("ord") % len(FAMILIES)).cast("int")
    family = F.array(*[F.lit(f) for f, *_ in FAMILIES])[turn]
    text = F.array(*[F.to_json(F.create_map(*[F.lit(x) for pair in given.items() for x in pair])) for _, given, _ in FAMILIES])[turn]
    p = b.dealt(b.parts(spark, sf)).withColumns({"family": family, "j": F.replace(text, F.lit("#"), n), "facts": F.replace(F.lit(_FACTS), F.lit("#"), n)})
    return p.withColumn("a", classify.project_source("family", "j", "facts", "mpn"))


def _shown(v):
    return F.when(F.schema_of_variant(v) == "STRING", v.cast("string")).otherwise(units.format_scientific(F.try_variant_get(v, "$", "double")))


@query(b.sql(_attributes_sql(), "parts_v"))
def family_attributes(spark, sf):
    rows = _sources(spark, sf).select("ord", "family", F.explode("a").alias("key", "v"))
    return rows.select("ord", "family", "key", _shown(F.col("v")).alias("value"))


def _fact(fmt: str, value: str) -> str:
    return f"printf('{fmt}', CAST({value} AS DOUBLE))"


# subcategory, pieces of the description after the name, in SQL
_TEXTS = (
    ("'ARM Cortex-M3 MCU'", ["'ARM Cortex-M3'", "CAST(nullif(ord,0)*1024 AS VARCHAR)||' B Flash'", "'7 I/O'"]),
    ("'Single'", ["'Single'", _fact("%.2f", "ord+0.1235") + "||' V'", _fact("%.3f", "ord/1000") + "||' A'"]),
    ("'Common Cathode'", ["'Common Cathode'", "'0.55 V Vf'", "ord||'.0 V reverse'"]),
    ("'X7R Capacitor'", ["NULL", "ord||'.0 V'", "'X7R'"]),
    ("'RS-485'", ["'RS-485'", "(ord*1000000)||' bps'", "'5.00 V'"]),
    ("'2-Channel Op Amp'", ["'2-channel'", "'GBW '||(ord*1000)||' Hz'"]),
    ("'N-Channel MOSFET'", ["'N-Channel'", "ord||'.0 V'", "'5.80 A'"]),
    ("'NPN Transistor'", ["'NPN'", "ord||'.0 V'", _fact("%.2f", "ord/100") + "||' A'"]),
    ("'AND Gate'", ["'AND Gate'", "'2.50 V'", "ord||'.5 ns propagation'"]),
    ("'Chip Resistor'", ["NULL", "ord||'.0 V'", "'0.25 W'"]),
    ("'Power Inductor'", ["NULL", _fact("%.3f", "ord/1000") + "||' A rated'"]),
)


def _texts_sql() -> str:
    parts = [
        f"SELECT ord, {sub} AS subcategory, concat_ws(' - ', 'Br '||mpn, {', '.join(pieces)}) AS description, concat_ws('; ', mpn, {sub}, '{FAMILIES[i][0]}') AS keywords FROM parts_v WHERE ord%11={i}"
        for i, (sub, pieces) in enumerate(_TEXTS)
    ]
    return " UNION ALL ".join(parts)


@query(b.sql(_texts_sql(), "parts_v"))
def family_texts(spark, sf):
    """F20; capacitance, resistance and inductance are left out of the attributes here, since their text is that of a binary fraction."""
    kept = F.map_filter("a", lambda k, v: ~k.isin("capacitance", "resistance_ohm", "inductance_h"))
    p = _sources(spark, sf).withColumn("a", kept)
    return p.select("ord", classify.family_text("family", F.col("a"), F.lit("Br"), F.col("mpn")).alias("t")).select("ord", "t.*")


# family found, by what, for canonical keys, unmapped keys, phrases and nothing
_ENGLISH = (
    ('{"vdss_v":1}', "{}", "x", "MOSFET", "L4_en_attrs"),
    ("{}", '{"Impedance @ Frequency":"1"}', "x", "Inductor", "L4_en_attrs_unmapped"),
    ("{}", '{"y":"1"}', "A DC DC Switching part #", "Voltage Regulator", "L4_desc"),
    ("{}", "{}", "ferrite bead", "Inductor", "L4_desc"),
    ("{}", '{"forward voltage":"1","y":"2"}', "ferrite bead", "Diode", "L4_en_attrs_unmapped"),
    ("{}", "{}", "nothing #", None, None),
)


@query(b.sql("SELECT ord, CASE ord%6 " + " ".join(f"WHEN {i} THEN {'NULL' if f is None else repr(f)}" for i, (*_, f, _l) in enumerate(_ENGLISH)) + " END AS family, CASE ord%6 "
             + " ".join(f"WHEN {i} THEN {'NULL' if lv is None else repr(lv)}" for i, (*_, lv) in enumerate(_ENGLISH)) + " END AS level FROM parts_v", "parts_v"))
def family_by_english_keys(spark, sf):
    """every level answers, an earlier one before a later one."""
    turn = (F.col("ord") % len(_ENGLISH)).cast("int")
    at = lambda i: F.array(*[F.lit(row[i]) for row in _ENGLISH])[turn]
    p = b.parts(spark, sf).withColumns({"c": at(0), "u": at(1), "d": at(2)})
    text_map = lambda c: F.from_json(c, "map<string,string>")
    found = classify.detect_by_english_keys(text_map("c"), text_map("u"), "d")
    return p.select("ord", found["family"].alias("family"), found["level"].alias("level"))


@query(b.sql("""SELECT ord, CASE ord%3 WHEN 0 THEN '5.1235' WHEN 1 THEN '3V~5V' ELSE '7' END AS voltage, CASE WHEN ord%3=2 THEN '12' ELSE 'none' END AS channels, CASE WHEN ord%3=0 THEN 'kept' ELSE '' END AS other FROM parts_v""", "parts_v"))
def family_english(spark, sf):
    """F44 on English rows: numbers are rounded by the family's rule, ranges stay, keys outside the family stay."""
    turn = (F.col("ord") % 3).cast("int")
    j = F.array(F.lit('{"output_voltage_v":5.12346,"odd":"kept"}'), F.lit('{"output_voltage_v":"3V~5V"}'), F.lit('{"output_voltage_v":7,"channels":12.9}'))[turn]
    m = classify.project_english(F.lit("Voltage Regulator"), F.from_json(j, "map<string,variant>"))
    p = b.parts(spark, sf).withColumn("m", m)
    text = lambda k: F.col("m")[k].cast("string")
    return p.select("ord", text("output_voltage_v").alias("voltage"), F.coalesce(text("channels"), F.lit("none")).alias("channels"), F.coalesce(text("odd"), F.lit("")).alias("other"))
