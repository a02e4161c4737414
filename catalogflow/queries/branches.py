"""Queries whose input reaches every branch of a function or gate: the case is chosen by the part's key, the values vary with it."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import attrs, classify, text, units
from catalogflow.operators import aggregates, gates
from catalogflow.queries.registry import query

def case(*texts):
    """The text of the part's case, ``#`` replaced by the part's key; None is null."""
    picked = F.array(*[F.lit(t).cast("string") for t in texts])[(F.col("ord") % len(texts)).cast("int")]
    return F.replace(picked, F.lit("#"), F.col("ord").cast("string"))


def cases(spark, sf, *texts, name="s"):
    return b.parts(spark, sf).withColumn(name, case(*texts))


def pick(*values: str) -> str:
    """The same choice in SQL, of SQL expressions."""
    return f"CASE ord%{len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def pairs(m):
    """Entries of a map in the order of their keys, as text."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"].cast("string"), F.lit("")).alias("value")))
    return F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


# ---- text (F12, F23, F25, F26, F28, F29, P17, P19, P24) ------------------------------------

@query(b.sql(f"""SELECT ord, {pick("'What is it '||ord||'|thing '||ord||';,Why|so'", "''", "''", "'Two lines|a'||chr(10)||'b'")} AS pairs, {pick("'Q: What is it '||ord||'?A: thing '||ord||';; Q: Why?A: so'", "''", "''", "'Q: Two lines?A: a'||chr(10)||'b'")} AS again FROM parts_v""", "parts_v"))
def faq_texts(spark, sf):
    p = cases(spark, sf, "Q: What is it #?A: thing #; Q: Why?A: so", "no questions # Q: half", None, "Q : Two lines ? A: a\nb").withColumn("f", text.parse_faq("s"))
    return p.select("ord", F.array_join(F.transform("f", lambda x: F.concat_ws("|", x["question"], x["answer"])), ",").alias("pairs"), text.faq_text("f").alias("again"))


@query(b.sql(f"""SELECT ord, {pick("'vds'", "'vgsth'", "'foo bar '||ord", "''", "'x y'")} AS concept, {pick("'Drain Source Voltage (Vdss)'", "'Gate Threshold'", "'Foo-Bar '||ord", "''", "'X (5 degC) +/- Y'")} AS shown FROM parts_v""", "parts_v"))
def concepts(spark, sf):
    p = cases(spark, sf, "Drain Source Voltage (Vdss)", "Gate Threshold", "Foo-Bar #", None, "X (5 DEGC) plusminus Y").withColumn("c", F.replace("s", F.lit("plusminus "), F.lit("")))
    return p.select("ord", text.concept("c").alias("concept"), text.cosmetic("s").alias("shown"))


@query(b.sql(f"""SELECT ord, {pick("'connector'", "'mcu_ic'", "'module'", "'module'", "'other'", "'other'")} AS type, {pick("'normal'", "'eol'", "'scarce'", "'normal'", "'eol'", "'normal'")} AS lifecycle FROM parts_v""", "parts_v"))
def product_types(spark, sf):
    p = cases(spark, sf, "USB Connector #", "Obsolete MOSFET", "Bluetooth, Hard to Find", "plain #", "last time buy", None).withColumn("l1", case("mcu", "x", "mcu", "RF Modules", "", None))
    return p.select("ord", text.product_type("s", "l1").alias("type"), text.lifecycle("s", "l1").alias("lifecycle"))


@query(b.sql(f"""SELECT ord, {pick("'Microcontroller'", "'Memory IC'", "''", "''")} AS category, {pick("'ST MCU'", "'Flash Memory'", "'(12) Thing '||ord||' (1a)'", "''")} AS name FROM parts_v""", "parts_v"))
def names_and_categories(spark, sf):
    p = cases(spark, sf, "ST MCU (1,234)", "Flash Memory  (#)", "(12) Thing # (1a)", None)
    return p.select("ord", text.keyword_category("s").alias("category"), text.strip_count("s").alias("name"))


@query(b.sql(f"""SELECT ord, {pick('true', 'true', 'false', 'false', 'false', 'false')} AS blob, {pick('false', 'false', 'true', 'true', 'false', 'true')} AS short, {pick('true', 'false', 'true', 'false', 'false', 'false')} AS owned, {pick('true', 'false', 'true', 'false', 'false', 'false')} AS valid FROM parts_v""", "parts_v"))
def brand_and_link_checks(spark, sf):
    """P17, P19, P24; ``C12 `` is a code with a blank, ``c12`` is none."""
    p = cases(spark, sf, "Maker of many things and of part number # too", "深圳某某公司", "TI", "ABCD", "Abcd #", None)
    p = p.withColumn("u", case(" https://own/x/#", "https://other/x", "https://cdn/#", "x https://own/x/", "https://own", None)).withColumn("c", case("C#", "c#", " C12 ", "C1a", "C", None))
    return p.select("ord", text.brand_blob("s").alias("blob"), text.short_abbreviation("s").alias("short"), text.owned_asset("u", ["https://own/x/", "https://cdn/"]).alias("owned"), F.coalesce(gates.valid_code("c"), F.lit(False)).alias("valid"))


@query(b.sql("SELECT ord, cid FROM parts_v WHERE size%3=0 AND size>20", "parts_v"))
def codes_kept(spark, sf):
    p = b.parts(spark, sf).withColumn("cid", F.when(F.col("size") % 3 == 0, F.col("cid")).otherwise(F.concat(F.lit("X"), "cid")))
    refs = b.parts(spark, sf).where("size > 20").select(F.concat(F.lit(" "), "cid").alias("code"))
    return gates.keep_valid_codes(p, "cid", refs).select("ord", "cid")


# ---- attributes (F16, F50-F54, F60) ----------------------------------------------------------

@query(b.sql(f"""SELECT ord, {pick("'Pitch=1;Voltage='||ord", "'Pitch=1;VOLTAGE='||ord", "''")} AS merged, {pick("'core=M'||ord||';frequency_hz=2'", "'frequency_hz='||ord", "'x='||ord")} AS aliased FROM (SELECT * FROM parts_v)""", "parts_v"))
def attributes_merged(spark, sf):
    """keys in another letter case, several old names of one key, nothing on either side."""
    p = cases(spark, sf, '{"Voltage":"#"}', None, None, name="old").withColumn("new", case('{"voltage":"9","Pitch":"1","PITCH":"2"}', '{"VOLTAGE":"#","voltage":"8","Pitch":"1"}', "{}")).withColumn(
        "a", case('{"Clock":"1","freq":"2","core":"M#"}', '{"frequency_hz":"1","Frequency":"#"}', '{"x":"#"}'))
    return p.select("ord", pairs(attrs.merge_attributes(attrs.json_map("old"), attrs.json_map("new"))).alias("merged"), pairs(attrs.alias_attribute_keys(attrs.json_map("a"))).alias("aliased"))


@query(b.sql(f"""SELECT ord, {pick("'Surge Current='||ord||' °C'", "'X=1 Form A (SPST, NO)'", "'无名=未知'||ord", "''")} AS translated, {pick('0', '0', '2', '0')} AS residual,
  {pick("'Surge Current='||ord||' ℃'", "'X=1 Form A (SPST, NO)'", "'n=5'", "''")} AS published FROM parts_v""", "parts_v"))
def attributes_translated(spark, sf):
    """Known keys and values, an unknown name, numbers, nothing."""
    p = cases(spark, sf, '{"surge_current_a":"# ℃"}', '{"X":"一组常开:1A(单刀单掷-常开)"}', '{"无名":"未知#","n":5}', "{}").withColumn("t", attrs.translate_attributes(F.replace("s", F.lit(',"n":5'), F.lit(""))))
    return p.select("ord", pairs(F.col("t")).alias("translated"), attrs.residual_count("t").alias("residual"), pairs(attrs.publish_attributes("s")).alias("published"))


@query(b.sql(f"""SELECT ord, {pick("'P'||ord||'|B|C1|Similar|SOT;Q|||Exact|'", "''", "''", "''")} AS alternates FROM parts_v""", "parts_v"))
def alternates_parsed(spark, sf):
    """a filled list with entries to drop, an empty one, text that is no list, null."""
    p = cases(spark, sf, '[{"mpn":" P# ","manufacturer":"B","lcsc":"C1","type":" ","package":"SOT"},{"mpn":""},null,{"mpn":"Q","type":"Exact"}]', "[]", "{", None)
    return p.select("ord", F.array_join(F.transform(attrs.parse_alternates("s"), lambda a: F.concat_ws("|", a["mpn"], a["manufacturer"], a["lcsc"], a["type"], a["package"])), ";").alias("alternates"))


@query(b.sql(f"""SELECT ord, {pick("'Vds='||ord||';a=1'", "'Pitch='||ord||';a=1'", "'a=1'")} AS specs, {pick("'motors,lamps '||ord", "'motors'", "''")} AS lines FROM (SELECT * FROM parts_v)""", "parts_v"))
def enrichment_merged(spark, sf):
    """a new concept, a concept the part has under another name, nothing new; lines that differ in case and points only."""
    p = cases(spark, sf, '{"a":"1","Vds":"#"}', '{"a":"1"}', '{"a":"1"}', name="old").withColumn("new", case('{"Drain Source Voltage":"9"}', '{"Pitch":"#"}', "{}"))
    lines = F.split(case("motors|Motors.|lamps #", "motors|MOTORS", ""), r"\|")
    old, more = F.filter(F.slice(lines, 1, 1), lambda x: x != ""), F.slice(lines, 2, 9)
    return p.select("ord", pairs(attrs.merge_enrichment(attrs.json_map("old"), attrs.json_map("new"))).alias("specs"), F.array_join(attrs.merge_lines(old, more), ",").alias("lines"))


# ---- quantities (F33, F36, F37) --------------------------------------------------------------

_TYPED = (
    # parser, values with # for the key, and the number or text that comes out in SQL
    ("current", units.current, ("#mA", "2.5A", "1A~#A", None), ("CAST(ord*0.001 AS VARCHAR)", "'2.5'", "'1A~'||ord||'A'", "NULL")),
    ("frequency", units.frequency, ("#MHz", "1.5GHz", "#kHz", ""), ("ord*1e6", "1.5e9", "ord*1e3", "NULL")),
    ("data_rate", units.data_rate, ("#Mbps", "1Gbps", "#kbps", "x"), ("ord*1e6", "1e9", "ord*1e3", "NULL")),
    ("resistance", units.resistance, ("#kΩ", "10Ω", "#mΩ", "x"), ("ord*1e3", "10", "ord*1e-3", "NULL")),
    ("capacitance", units.capacitance, ("#nF", "10uF", "#pF", "x"), ("ord*1e-9", "1e-5", "ord*1e-12", "NULL")),
    ("inductance", units.inductance, ("#uH", "1mH", "#nH", "x"), ("ord*1e-6", "1e-3", "ord", "NULL")),
    ("power", units.power, ("1/4W", "#mW", "#W", "x"), ("0.25", "ord*1e-3", "ord", "NULL")),
    ("memory", units.memory, ("#KB", "2MB", "1GB", "# bytes"), ("ord*1024", "2097152", "1073741824", "NULL")),
)


def _typed_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT ord, '{name}' AS kind, {pick(*[v if v == 'NULL' or chr(39) in v or 'CAST' in v else f'format({chr(39)}{{:.6e}}{chr(39)}, CAST({v} AS DOUBLE))' for v in out])} AS value FROM parts_v" for name, _, _, out in _TYPED)
    return b.sql(f"SELECT ord, kind, value FROM ({rows})", "parts_v")


@query(_typed_sql().replace("CAST(ord*0.001 AS VARCHAR)", "format('{:.6e}', ord*0.001)").replace("'2.5'", "'2.500000e+00'"))
def typed_quantities(spark, sf):
    """Eight parsers on units large and small, a range, a unit that is not in the table (nH), and text that is no quantity."""
    p = b.parts(spark, sf)
    shown = lambda q: F.when(q["kind"] == "single", F.format_string("%.6e", q["num"])).otherwise(q["text"])
    each = F.array(*[F.struct(F.lit(name).alias("kind"), shown(parse(case(*values))).alias("value")) for name, parse, values, _ in _TYPED])
    return p.select("ord", F.explode(each).alias("x")).select("ord", "x.*")


@query(b.sql(f"""SELECT ord, {pick('ord', 'NULL', 'NULL')} AS flash, {pick('20', 'NULL', 'NULL')} AS ram, {pick('ord', 'NULL', 'NULL')} AS io, {pick("'LQFP-48'", "'QFN-'||ord", "''")} AS package, {pick('2.8', '2.65', 'NULL')} AS voltage FROM parts_v""", "parts_v"))
def controller_facts(spark, sf):
    p = cases(spark, sf, "ARM #KB Flash 20KB SRAM # I/O LQFP-48 Operating Voltage 2.0-3.6V, 1-5V", "qfn # 1.8 - 3.5V", "nothing here")
    f = units.mcu_facts("s")
    return p.select("ord", f["flash"].alias("flash"), f["ram"].alias("ram"), f["io"].alias("io"), f["package"].alias("package"), f["voltage"].alias("voltage"))


# ---- gates and reports (A19, A20, O4, P4, F43) ------------------------------------------------

@query("""WITH n AS (SELECT user_id%3 AS part, count(*) AS total, count(*) FILTER (WHERE event_type='error' AND user_id%3=0) AS stop, count(*) FILTER (WHERE event_type='view') AS warning, count(*) FILTER (WHERE event_type='click') AS skip FROM events GROUP BY 1)
  SELECT part, total, stop, warning, skip, stop=0 AS "continue", CASE WHEN stop=0 AND part<>1 THEN 'PASS' ELSE 'FAIL' END AS audit FROM n""")
def batch_audits(spark, sf):
    """Three batches: one with stops, one whose reconciliation failed, one that passes."""
    e = b.read(spark, sf, "events").withColumn("part", F.col("user_id") % 3)
    code = F.when((F.col("event_type") == "error") & (F.col("part") == 0), "CJK_LEAK").when(F.col("event_type") == "view", "BRAND_UNMAPPED").when(F.col("event_type") == "click", "DUPLICATE_SKIP").otherwise("R2_OBJECT_EXISTS")
    e = e.select("part", code.alias("code"), F.lit("m").alias("mpn"), F.lit("").alias("message"))
    out = None
    for part, status in ((0, "PASS"), (1, "FAIL"), (2, "PASS")):
        one = gates.batch_audit(e.where(F.col("part") == part), status).select(F.lit(part).alias("part"), "total", "stop", "warning", "skip", "continue", "audit")
        out = one if out is None else out.unionByName(one)
    return out


@query(b.sql("""SELECT slug, n, row_number() OVER (ORDER BY n DESC, slug) AS pos FROM (SELECT lower(manufacturer) AS slug, count(*) AS n FROM parts_v GROUP BY 1)""", "parts_v"))
def subcategories_in_order(spark, sf):
    """The position in the output is part of the result."""
    g = b.parts(spark, sf).groupBy(F.lower("manufacturer").alias("slug")).agg(F.count(F.lit(1)).alias("n"))
    ordered = aggregates.subcategory_order(g)
    w = F.struct((-F.col("n")).alias("n"), "slug")
    listed = ordered.agg(F.collect_list(F.struct("slug", "n")).alias("l"), F.array_sort(F.collect_list(w)).alias("_check"))
    return listed.select(F.posexplode("l").alias("p", "x")).select("x.slug", "x.n", (F.col("p") + 1).alias("pos"))


@query(b.sql(f"""SELECT ord, {pick("'pattern 3'", "''", "'pattern 3'", "''")} AS built, {pick("'pattern 3'", "'pattern 3'", "''", "''")} AS taken, {pick("'pattern 3'", "'pattern 3'", "'pattern 3'", "''")} AS indexed FROM parts_v""", "parts_v"))
def numeric_part_numbers(spark, sf):
    """Part numbers of digits only, from a maker that numbers its parts so, from an envelope, and from neither."""
    p = cases(spark, sf, "1234567", "1234567", "7654321", "A#", name="mpn").withColumn("brand", case("Some", gates.NUMERIC_BRANDS[0].upper(), "Some", "Some")).withColumn("source_kind", case("csv", "csv", "lcsc_http_json", "csv"))
    p = p.withColumns({"supplier_reference": F.col("cid")})
    reason = lambda mode: gates.synthetic_reason("mpn", None, gates.numeric_mpn_exempt(mode))
    return p.select("ord", reason("build").alias("built"), reason("intake").alias("taken"), reason("index").alias("indexed"))


@query(b.sql(f"""SELECT ord, {pick("'diodes'", "'Uncategorized'")} AS category, {pick('false', 'true')} AS needs_review, {pick("'Diode'", "'Resistor'")} AS detected FROM parts_v""", "parts_v"))
def category_rows(spark, sf):
    p = cases(spark, sf, "diodes", "", name="l1").withColumn("d", case("Diode", "Resistor"))
    return p.select("ord", classify.category_row("l1", F.col("d")).alias("r")).select("ord", "r.*")
