"""Rule matrices: quantities, display, hosts, labels, attributes, families."""

import json

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import attrs, classify, keys, markup, text, units
from catalogflow.operators import gates, json_tree


def column(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_quantities(spark):
    values = ["4V~80V", "3V;5V", "100mV", "0.8-5V", "1.8V;2.5V;3.3V", "1500", "ripple", ""]
    got = column(spark, values, units.voltage("s").alias("q"))
    simple = [None if q is None else (q["kind"], q["num"], q["text"]) for (q,) in got]
    assert simple == [("range", None, "4V~80V"), ("multi", None, "3V;5V"), ("single", 0.1, None), ("range", None, "0.8V~5V"),
                      ("multi", None, "1.8V;2.5V;3.3V"), ("single", 1500.0, None), None, None]


@pytest.mark.parametrize("parser,value,want", [
    ("capacitance", "100nF", 1e-7), ("resistance", "10kΩ", 10000.0), ("inductance", "4.7µH", 4.7e-6), ("data_rate", "1Mbps", 1e6),
    ("frequency", "1MHz", 1e6), ("current", "150mA", 0.15), ("power", "200mW", 0.2), ("power", "1/4W", 0.25), ("memory", "64KB", 65536.0), ("frequency", "2058.7kHz", 2058700.0), ("frequency", "4.35GHz", 4350000000.0), ("number", "1", 1.0)])
def test_typed_parsers(spark, parser, value, want):
    ((q,),) = column(spark, [value], units.PARSERS[parser]("s"))
    assert q["kind"] == "single" and abs(q["num"] - want) <= abs(want) * 1e-12


def test_multi_value(spark):
    values = ["3V;5V", "16/32 Bit", "1,000V", "1/4W", "1.5V/us", "4V~80V", "1.25V@150mA", "1;2", ""]
    assert [r[0] for r in column(spark, values, units.is_multi_value("s"))] == [True, True, False, False, False, False, False, True, False]


def test_display(spark):
    rows = [("capacitance", "1e-7", "100 nF"), ("iq_a", "0.0025", "2.5 mA"), ("flash_bytes", "1048576", "1 MB"), ("resistance_ohm", "10000", "10kΩ"),
            ("resistance_ohm", "0.047", "47mΩ"), ("inductance_h", "0.00011999999999999999", "120 µH"), ("vf_v", "0.55", "0.55 V"), ("slew_rate_vus", "5", "5 V/µs"),
            ("operating_temp", "-40degC~+125degC@(Tj)", "-40°C ~ +125°C @(Tj)"), ("life", "6000hrs@105degC", "6000hrs @ 105°C"),
            ("temp", "-40°C to +85°C", "-40°C ~ +85°C"), ("tc", "+/-100ppm/degC", "+/-100ppm/°C"), ("dac", "8bit", "8 bit"), ("x", "text", "text"), ("tpd_ns", "1500", "1.5 µs"), ("tolerance", "5", "5 %")]
    df = spark.createDataFrame(rows, "k string, v string, want string").withColumn("got", units.format_value("k", "v"))
    assert [(r["k"], r["got"]) for r in df.collect()] == [(k, w) for k, _, w in rows]


def test_labels_and_concepts(spark):
    values = ["number of channels", "Maximum I2C Clock", "with bracket", "io_count", "sample_rate", "Propagation Delay tpHL", "output type (built-in)"]
    assert [r[0] for r in column(spark, values, text.human_label("s"))] == [
        "Number of Channels", "Maximum I2C Clock", "With Bracket", "Number of I/O", "Sample Rate", "Propagation Delay tpHL", "Output Type (built-in)"]
    assert [r[0] for r in column(spark, ["Gate Charge(Qg)", "Wire colour"], text.concept("s"))] == ["qg", "wire colour"]


def test_text(spark):
    assert column(spark, ["±10%", "温度", "45°"], text.has_illegal_text("s")) == [(False,), (True,), (False,)]
    assert column(spark, ["100Ω　５Ｖ 温 25℃"], text.normalize_text("s")) == [("100Ohm 5V 25°C",)]
    assert column(spark, ["卤5% 电阻"], text.normalize_visible("s")) == [("±5% ",)]
    assert column(spark, ["Chip From $ 1.20, 3,000 in stock"], text.sanitize_desc("s")) == [("Chip",)]
    assert column(spark, ["LQFP-48(7x7)", "SMD", "SOT-23"], text.clean_package("s")) == [("LQFP-48",), ("",), ("SOT-23",)]
    assert column(spark, ["Power MOSFETs", "Widget", ""], text.keyword_category("s")) == [("MOSFET",), ("",), ("",)]
    ((pairs,),) = column(spark, ["Q: Max?A: 5V;  Q: Min?A: 1V"], text.parse_faq("s"))
    assert [(p["question"], p["answer"]) for p in pairs] == [("Max", "5V;"), ("Min", "1V")]
    assert column(spark, ["operational temp range"], text.same_question(F.col("s"), F.lit("Operating temperature range"))) == [(True,)]
    assert column(spark, ["discontinued MCU", "usb connector"], text.product_type("s", F.lit("")), text.lifecycle("s", F.lit(""))) == [("mcu_ic", "eol"), ("connector", "normal")]


def test_keys(spark):
    assert column(spark, [" nRF 24L01+(a)-b/c "], *[keys.KEY_MODES[m]("s").alias(m) for m in keys.KEY_MODES]) == [(
        "NRF 24L01+(A)-B/C", "nrf24l01+(a)-b/c", "nrf24l01+(a)b/c", "nrf24l01abc", "nrf24l01+ab/c", "-nrf-24l01--a--b-c-", "nRF 24L01+(a)-b/c")]
    ((b1,), (b2,)) = column(spark, ["20260830_MCU_20", "2026_x_1"], keys.parse_batch_id("s"))
    assert (str(b1["day"]), b1["strategy"], b1["count"]) == ("2026-08-30", "MCU", 20) and b2 is None
    assert column(spark, ["http://h/x/AB12.PDF?q=1"], keys.object_name("s"), keys.url_host("s")) == [("ab12", "h")]


def test_hosts(spark):
    cases = [("https://pub-1.r2.dev/d/C1.pdf", "OK_STORAGE"), ("https://www.ti.com/x.pdf", "OK_OEM"), ("https://notti.com/x.pdf", "BAD_UNKNOWN"),
             ("http://datasheet.lcsc.com/x.pdf", "BAD_SUPPLIER"), ("https://example.com/d.pdf", "BAD_SHAPE"), ("http://www.nxp.com/x.pdf", "BAD_SHAPE"), ("", "")]
    assert [r[0] for r in column(spark, [u for u, _ in cases], gates.classify_host("s")["verdict"])] == [v for _, v in cases]


def test_synthetic(spark):
    values = ["MCU100000123", "1234567", "AB_TEST", "ABXXX", "xPLACEHOLDERy", "LM358", "1909763-1"]
    got = [r[0] for r in column(spark, values, gates.synthetic_reason("s"))]
    assert [bool(x) for x in got] == [True, True, True, True, True, False, False]
    assert column(spark, ["1234567"], gates.synthetic_reason("s", exempt=gates.numeric_mpn_exempt("build", F.lit("Molex")))) == [("",)]


def test_family_rules(spark):
    df = spark.createDataFrame([
        ("Logic", "x", "", "", "{}"), ("", "Schottky Diodes", "", "", "{}"), ("", "", "MOSFET", "", "{}"), ("", "", "", "an LDO part", "{}"),
        ("", "", "", "", '{"容值":"1"}'), ("", "Widgets", "", "", "{}")], "p string, c string, cat string, d string, j string")
    got = [(r["f"]["family"], r["f"]["level"][:2]) for r in df.select(classify.detect_family("p", "c", "cat", "d", "j").alias("f")).collect()]
    assert got == [("Logic IC", "L0"), ("Diode", "L1"), ("MOSFET", "L2"), ("Voltage Regulator", "L3"), ("Capacitor", "L4"), ("Uncategorized", "no")]
    df = spark.createDataFrame([("diodes", "TVS  Diodes"), ("Diodes ", "Zener"), ("x", "y")], "p string, l string")
    assert [r[0] for r in df.select(classify.native_l1("p", "l")).collect()] == ["circuit-protection", "diodes", ""]


def test_source_projection(spark):
    cases = [
        ("MOSFET", {"漏源电压(Vdss)": "30V", "连续漏极电流(Id)": "5.8A", "类型": "n沟道", "导通电阻": "28mΩ"}, {"vdss_v": 30, "id_a": 5.8, "chan_type": "N-Channel", "rds_on_ohm": 0.028}),
        ("Capacitor", {"容值": "100nF", "精度": "±10%", "额定电压": "4V~50V", "温度系数": "X7R"}, {"capacitance": 1e-7, "tolerance": 10, "rated_voltage_v": "4V~50V", "temp_coef": "X7R"}),
        ("Diode", {"直流反向耐压(Vr)": "40V", "二极管配置": "双", "极性": "未知"}, {"vreverse_v": 40, "config": "Dual"}),
        ("Microcontroller", {"CPU内核": "ARM Cortex-M3", "CPU最大主频": "72MHz"}, {"core": "ARM Cortex-M3", "frequency_hz": 72000000, "flash_bytes": 65536, "ram_bytes": 20480, "io_count": 37, "voltage_v": 2.8, "package": "LQFP-48"}),
        ("Uncategorized", {"容值": "1nF"}, {})]
    df = spark.createDataFrame([(f, json.dumps(a, ensure_ascii=False), "64KB Flash 20KB SRAM 37 I/O LQFP-48 2.0-3.6V", "X") for f, a, _ in cases], "f string, j string, d string, m string")
    got = [json.loads(r[0]) for r in df.select(F.to_json(classify.project_source("f", "j", "d", "m"))).collect()]
    assert got == [w for _, _, w in cases]


def test_english_projection(spark):
    df = spark.createDataFrame([("Logic IC", '{"working_voltage_v":3.33333,"x":1.23456789,"iol_a":"1A;2A"}')], "f string, j string")
    got = json.loads(df.select(F.to_json(classify.project_english("f", attrs.variant_map("j")))).first()[0])
    assert got == {"working_voltage_v": 3.33333, "supply_v": 3.3333, "x": 1.23456789, "iol_a": "1A;2A"}


def test_alternates_attributes(spark):
    ((alts,),) = column(spark, ['[{"mpn":" KEEP-ME ","type":""},{"mpn":""},null]'], attrs.parse_alternates("s"))
    assert [a.asDict() for a in alts] == [{"mpn": "KEEP-ME", "manufacturer": "", "lcsc": "", "type": "Similar", "package": ""}]
    assert column(spark, ['{"a":1,"b":"","c":null,"d":[]}', "[1]", "{"], attrs.spec_count("s")) == [(1,), (0,), (0,)]
    ((m,),) = column(spark, ['{"Clock":"1","freq":"2","x":"3"}'], attrs.alias_attribute_keys(attrs.json_map("s")))
    assert m == {"frequency_hz": "2", "x": "3"}
    got = column(spark, ['{"k":"1"}', '[{"k":"a","v":"1"}]', '[["a","2"],["b"]]', "nope"], attrs.attributes_from_any("s"))
    assert [r[0] for r in got] == [{"k": "1"}, {"a": "1"}, {"a": "2", "b": ""}, {}]
    ((m,),) = column(spark, ['{"Voltage":"5"}'], attrs.merge_attributes(attrs.json_map("s"), F.create_map(F.lit("voltage"), F.lit("9"), F.lit("Pitch"), F.lit("1"))))
    assert m == {"Voltage": "5", "Pitch": "1"}
    assert column(spark, ['{"a":{"cost":1}}', '{"a":1}'], attrs.leaked_keys("s")) == [(["cost"],), ([],)]
    d = json_tree.isolate_keys_in(spark.createDataFrame([('{"a":{"costPrice":3,"b":1}}',)], "s string"), "s", "d").first()["d"]
    assert json.loads(d["public"]) == {"a": {"b": 1}} and [(x["path"], x["value"]) for x in d["isolated"]] == [("a.costPrice", "3")]
    ((t,),) = column(spark, ['{"vdss_v":"30","id_a":"5.8","RDS(on)":"28mΩ;30","Package":"SOT-23"}'], attrs.top_attributes(attrs.json_map("s"), F.lit("MOSFET")))
    assert t == ["30 V", "5.8 A", "28mΩ"]


def test_faqs(spark):
    df = spark.sql("select array(named_struct('question','Max temp?','answer','85'),named_struct('question','max TEMP','answer','86'),"
                   "named_struct('question','Price?','answer','$ 3'),named_struct('question','How to buy','answer','x')) q")
    m = df.select(attrs.merge_faqs("q").alias("m")).first()["m"]
    assert [f["answer"] for f in m["faqs"]] == ["85"] and (m["offbrand"], m["platform"], m["repeated"]) == (1, 1, 1)


PAGE = """<html><title> A  page </title><h1>Part <b>X1</b></h1><!-- 注释 --><p data-zh="中">Hi</p>
<script type="application/ld+json">{"@graph":[{"@type":"Product","description":"A chip, 5 in stock","brand":{"name":"TI"}},
{"@type":"FAQPage","mainEntity":[{"name":"Q1?","acceptedAnswer":{"text":"<b>A1</b>"}}]}]}</script>
<script>{"@type":"PropertyValue","name":"Pitch","value":"1mm"},{"@type":"PropertyValue","name":"pitch","value":"2mm"}</script>
<h2>Applications</h2><ul><li> Motor <i>drive</i></li><li></li></ul></section>
<h2>Alternative Parts</h2><table><a href="/product-detail/C2.html">B-2</a><a href="/product-detail/C1.html">X1</a><a href="/product-detail/C3.html">x 1</a><a href="/product-detail/C2.html">again</a></table>
<script id="__NEXT_DATA__" type="x">{&quot;props&quot;:{&quot;pageProps&quot;:{&quot;webData&quot;:{&quot;productCode&quot;:&quot;C1&quot;}}}}</script></html>"""


def test_markup(spark):
    (r,) = column(spark, [PAGE], markup.property_pairs("s"), markup.page_description("s"), markup.page_faq("s"), markup.page_brand("s"),
                  markup.list_after_heading("s"), markup.alternate_anchors("s", F.lit("C1"), F.lit("X1")), markup.title("s"), markup.first_heading("s"),
                  text.has_cjk(markup.mask_for_scan("s")), markup.page_error_class(F.lit(200), "s", F.lit("C1")), markup.page_error_class(F.lit(200), "s", F.lit("C9")))
    assert [(p["name"], p["value"]) for p in r[0]] == [("Pitch", "1mm")]
    assert r[1] == "A chip"
    assert [(f["question"], f["answer"]) for f in r[2]] == [("Q1?", "A1")]
    assert r[3] == "TI" and r[4] == ["Motor drive"]
    assert [(a["code"], a["mpn"]) for a in r[5]] == [("C2", "B-2")]
    assert r[6:] == ("A page", "Part X1", False, "", "c_number_mismatch")


def test_forbidden_tokens_keep_close_hits(spark):
    df = spark.createDataFrame([("a", "TEST and TEST again PLACEHOLDER")], "k string, t string")
    rules = [("t", r"\bTEST\b"), ("p", "PLACEHOLDER")]
    hits = gates.forbidden_tokens(df, "k", ["t"], rules).collect()
    assert sorted(h["token"] for h in hits) == ["PLACEHOLDER", "TEST", "TEST"]
    exempt = spark.createDataFrame([("a", "t", "placeholder")], "key string, field string, token string")
    assert gates.forbidden_tokens(df, "k", ["t"], rules, exempt).count() == 2


def test_temperature_shapes(spark):
    cases = {"-40degC ~ +85degC;-55degC~125degC@(TA)": "-40°C ~ +85°C; -55°C ~ 125°C @(TA)", "-;-40degC~85degC": "-40°C ~ 85°C", "-40degC~85degC;-": "-40°C ~ 85°C",
             "a 1@2degC b 3@4degC": "a 1 @ 2°C b 3 @ 4°C", "25degC": "25°C", "x degC": None, "25 °C": None, "volts": None}
    assert [t for (t,) in column(spark, list(cases), units.format_temperature("s"))] == list(cases.values())


def test_core_names(spark):
    rows = [("ARM Cortex-M3", "32", "x", "32-bit ARM Cortex-M3 MCU"), ("AVR", None, "x", "8-bit AVR MCU"), ("PIC", "16", "x", "16-bit PIC MCU"), ("arm926", "32", "TMS320F", "32-bit C28x DSC"),
            ("arm926", "32", "x", "32-bit ARM926EJ-S MPU"), ("other", "16", "x", "16-bit MCU"), (None, "0", None, "Microcontroller")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, core string, bits string, mpn string, want string")
    got = df.select("i", "want", classify.core_subcategory("core", "bits", "mpn").alias("got")).orderBy("i").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_scientific_as_c_writes_it(spark):
    """Numbers on a half of the last digit shown: the double lies below it, above it or on it. Java alone rounds all of them up."""
    import random

    draw = random.Random(4)
    values = [1000000.1235, -1000000.1235, 1000000000.5, 1000000001.5, 0.0, 5e-12, 1e300, 123.0, float("inf")]
    values += [float(f"{draw.choice('-+')}{draw.randrange(10**9, 10**10)}5e{draw.randrange(-22, 23)}") for _ in range(2000)]
    values += [1000000 + i + 0.1235 for i in range(1000)]
    df = spark.createDataFrame([(v, "Infinity" if v == float("inf") else f"{v:.9e}") for v in values], "v double, want string")
    assert df.withColumn("got", units.format_scientific(F.col("v"))).where("got IS DISTINCT FROM want").collect() == []


def test_family_attributes_of_large_keys(spark, tmp_path):
    """A part whose voltage lies on a half of the tenth digit."""
    from catalogflow.queries.family import family_attributes

    spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(11).withColumn("p_partkey", F.col("p_partkey") % 11 + 1_000_000).write.parquet(f"{tmp_path}/part.parquet")
    got = family_attributes(spark, str(tmp_path)).where("ord = 1000000 AND key = 'output_voltage_v'").collect()
    assert [r["value"] for r in got] == ["1.000000123e+06"]
