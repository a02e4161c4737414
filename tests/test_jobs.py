"""Jobs on small fixtures: the merge fixture, release, waves, streams, neighbours, search."""

import random

from pyspark.sql import functions as F

from catalogflow.operators import gates, identity, logs, merge, ordering
from catalogflow.plans import publish, release, search
from catalogflow.schemas import LEDGER, MASTER_COLUMNS
from catalogflow.streaming import jobs


def offers(spark, rows):
    cols = ["mpn", "manufacturer", "subcategory", "alternative_parts", "attributes_json", "source"]
    data = [(i, *[r.get(c, "") for c in cols]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "ord long, " + ", ".join(f"{c} string" for c in cols))


GOLDEN = [
    {"mpn": "nRF24L01", "manufacturer": "Nordic", "source": "LCSC"}, {"mpn": "nRF24L01+", "manufacturer": "Nordic", "source": "LCSC"},
    {"mpn": "TLV320ADC3101", "manufacturer": "TI", "source": "LCSC"}, {"mpn": "OPA2345", "manufacturer": "Texas Instr.", "source": "LCSC"},
    {"mpn": "WEIRDCHIP-1", "manufacturer": "WeirdCo", "source": "LCSC"}, {"mpn": "LM358", "manufacturer": "TI", "attributes_json": '{"legacy_speed":"1"}', "source": "LCSC"},
    {"mpn": "BADJSON-1", "manufacturer": "TI", "attributes_json": "{bad", "source": "LCSC"},
    {"mpn": "STM32F103C8T6", "manufacturer": "ST", "source": "LCSC"}, {"mpn": "STM32F103C8T6", "manufacturer": "STMicroelectronics", "source": "Huaqiang"},
    {"mpn": "TWOSUB-A", "manufacturer": "TI", "alternative_parts": "X1; Y2", "source": "LCSC"},
    {"mpn": "twosub -A", "manufacturer": "TI", "subcategory": "Regulator", "alternative_parts": "Y2;Z3", "source": "LCSC"},
    {"mpn": " ", "manufacturer": "TI"}, {"mpn": "NOSOURCE", "manufacturer": "TI"}, {"mpn": "NOBRAND-1", "source": "LCSC"},
]
ALIASES = [("ti", "Texas Instruments"), ("texas instr.", "Texas Instruments"), ("st", "STMicroelectronics"), ("stmicroelectronics", "STMicroelectronics"), ("nordic", "Nordic")]


def test_golden_merge(spark):
    alias = spark.createDataFrame(ALIASES, "raw string, canonical string")
    allowed = spark.createDataFrame([("frequency_hz",)], "key string")
    df = offers(spark, GOLDEN)
    out = merge.merge_offers(df.repartition(6), alias, allowed)
    g = {r["mpn"]: r for r in out.groups.collect()}
    assert len(g) == 11
    assert g["OPA2345"]["manufacturer"] == g["TLV320ADC3101"]["manufacturer"] == "Texas Instruments"
    assert g["STM32F103C8T6"]["sources"] == ["LCSC", "Huaqiang"]
    assert g["TWOSUB-A"]["subcategory"] == "Regulator" and g["TWOSUB-A"]["alternative_parts"] == "X1;Y2;Z3"
    assert g["NOSOURCE"]["sources"] == [] and g["LM358"]["unknown_attr"] == ["legacy_speed"]
    review = {(r["mpn"], r["reason"], r["detail"]) for r in out.review.collect()}
    assert review == {("WEIRDCHIP-1", "unknown_manufacturer", "raw=WeirdCo"), ("NOBRAND-1", "missing_manufacturer", "empty manufacturer"),
                      ("LM358", "unknown_attribute_key", "key=legacy_speed")}
    s = out.stats.first()
    assert (s["rows_kept"], s["groups_out"], s["merged_dups"], s["brand_unmatched"], s["brand_missing"]) == (13, 11, 2, 1, 1)
    slugs = {r["mpn"]: r["url_slug"] for r in identity.assign_slugs(out.groups.withColumn("b", F.regexp_replace(F.lower("mpn"), "[^a-z0-9]", "")), "b").collect()}
    assert slugs["nRF24L01"] == "nrf24l01" and slugs["nRF24L01+"] == "nrf24l01-2"


def test_merge_ignores_partitioning(spark):
    alias = spark.createDataFrame(ALIASES, "raw string, canonical string")
    rng = random.Random(1)
    rows = [{"mpn": f"P{rng.randrange(5)}", "manufacturer": rng.choice(["TI", "ST"]), "source": rng.choice("abc"), "subcategory": rng.choice(["", "x", "y"])} for _ in range(80)]
    df = offers(spark, rows)
    read = lambda d: sorted(map(str, merge.merge_offers(d, alias).groups.select("mpn", "manufacturer", "subcategory", "sources", "offers").collect()))
    assert read(df.coalesce(1)) == read(df.orderBy(F.rand(5)).repartition(7))


def master_rows(spark, names, **kw):
    base = spark.createDataFrame([(i, n, "TI", "d") for i, n in enumerate(names)], "ord long, mpn string, manufacturer string, description string")
    for c in MASTER_COLUMNS:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(kw.get(c, "")))
    return base.select("ord", *MASTER_COLUMNS)


def test_release_append_then_nothing_new(spark, tmp_path):
    kw = {"brand": "TI", "native_l1": "diodes", "attributes_json": '{"a":1,"b":2}'}
    master = master_rows(spark, [f"M{i}" for i in range(54)], **kw)
    cands = master_rows(spark, [f"N{i}" for i in range(10)] + ["M1", "M2"], **kw)
    plan = release.plan_release(master, cands)
    s = plan.summary.first()
    assert (s["stops"], s["new"], s["duplicates"], s["before_count"], s["after_count"]) == (0, 10, 2, 54, 64)
    from catalogflow.operators.aggregates import table_fingerprint

    print_before = table_fingerprint(gates.project_master(master)).first()
    refused = release.apply_release(spark, plan, master, print_before, str(tmp_path / "no"), approved=False)
    assert not refused.ok
    done = release.apply_release(spark, plan, master, print_before, str(tmp_path / "v1"), approved=True)
    assert done.ok and done.rows == 64
    stored = spark.read.parquet(str(tmp_path / "v1")).withColumn("ord", F.monotonically_increasing_id())
    again = release.plan_release(stored, cands).summary.first()
    assert (again["new"], again["duplicates"], again["stops"]) == (0, 12, 0)


def test_release_stops(spark):
    master = master_rows(spark, ["A"], native_l1="diodes")
    bad = master_rows(spark, ["X1", "MCU100000123", "X2", "X2"], brand="TI", native_l1="diodes", attributes_json='{"a":1,"b":2}', faq="Q: a?A: b", supplier_reference="C5")
    raw = spark.createDataFrame([("C9", "Z", "TI", [], [])], "code string, mpn string, manufacturer string, faqs array<struct<question string, answer string>>, "
                                "alternates array<struct<productModel string, brandNameEn string, productCode string, type string, encapStandard string>>")
    kinds = {r["kind"] for r in release.plan_release(master, bad, raw).findings.where("level = 'STOP'").collect()}
    assert {"SYNTHETIC_MPN", "FAQ_FABRICATED_FAIL", "BATCH_SELF_DUPLICATE"} <= kinds


def test_gates(spark):
    counts = spark.createDataFrame([(27, 17, 10, 27, 0), (44, 44, 44, 44, 0), (44, 27, 17, 44, 0)], "uploaded int, new_objects int, already_exists int, total int, failed int")
    assert [r["valid"] for r in gates.asset_invariants(counts).collect()] == [True, False, True]
    ledger = spark.createDataFrame([("a", "FAILED", 3), ("b", "UPLOADING", 1), ("c", "VERIFIED", 0)], "mpn string, status string, retry_count int").withColumn("error_code", F.lit("X"))
    assert [(r["status"], r["retry_count"]) for r in gates.rearm_failed(ledger).orderBy("mpn").collect()] == [("DISCOVERED", 0), ("VERIFIED", 0), ("VERIFIED", 0)]
    assert "status" in LEDGER.names
    docs = spark.createDataFrame([("p1", "a", "u1"), ("p1", "a", "u2"), ("p2", "a", "u"), ("p2", "b", "u"), ("p3", "a", "u1"), ("p3", "b", "u2"), ("p4", "a", "u")], "mpn string, manufacturer string, document string")
    got = {(r["level"], r["kind"], r["mpn"]) for r in gates.document_identity(docs).collect()}
    assert got == {("STOP", "DATASHEET_IDENTITY_FAIL", "p1"), ("STOP", "DATASHEET_IDENTITY_FAIL", "p2"), ("WARN", "DATASHEET_CLONE_MPN", "p3")}


def test_related_neighbours_against_walk(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("xyz"), f"s{rng.randrange(12)}") for i in range(40)]
    want, done = {}, {}
    groups = {}
    for i, g, s in rows:
        groups.setdefault(g, []).append(s)
    for g, pool in groups.items():
        for i, s in enumerate(pool):
            if s in done:
                continue
            out, j, steps = [], i + 1, 0
            while len(out) < 6 and steps < len(pool) + 6:
                other = pool[j % len(pool)]
                j, steps = j + 1, steps + 1
                if other != s:
                    out.append(other)
            done[s] = out
    want = {s: o for s, o in done.items() if o}
    df = spark.createDataFrame(rows, "ord long, g string, slug string").repartition(4)
    got = {}
    for r in identity.related_neighbours(df, "g", "slug").orderBy("slug", "rank").collect():
        got.setdefault(r["slug"], []).append(r["neighbour"])
    assert got == want


def test_search_against_full_scan(spark):
    entries = [("1", "PART", "AMS1117-3.3", ["ams111733"], "/a"), ("2", "PART", "LM358", [], "/b"), ("3", "MANUFACTURER", "Texas Instruments", [], "/m"), ("4", "CATEGORY", "Op Amps", [], "/c")]
    e = spark.createDataFrame(entries, "entry_id string, type string, label string, aliases array<string>, url string")
    q = spark.createDataFrame([(x,) for x in ["lm358", "ams1117", "ti", "a", "amps", "358", "zzz", "oa"]], "query string")
    got = {(r["query"], r["entry_id"]): r["score"] for r in search.search(e, q).collect()}
    full = e.crossJoin(q).withColumn("s", search.best_score(F.col("query"), F.concat(F.array("label"), "aliases"))).where("s is not null")
    assert got == {(r["query"], r["entry_id"]): r["s"] for r in full.collect()}
    routed = {r["query"]: r["url"] for r in search.route(search.search(e, q), q).collect()}
    assert routed["lm358"] == "/b" and routed["ams1117"] == "/search/?q=ams1117" and routed["ti"] == "/m" and routed["zzz"] == "/search/?q=zzz"


def test_search_candidates_grow_like_matches(spark):
    """Codes that share all their runs of three characters, and names that many entries bear."""
    e = spark.range(20000).select(F.concat(F.lit("p"), "id").alias("entry_id"), F.lit("PART").alias("type"), F.lit("Large Ring").alias("label"),
                                  F.array(F.concat(F.lit("c"), F.col("id") + 1000000), F.lit("largering"), F.lit("Large Ring")).alias("aliases"), F.lit("").alias("url"))
    q = spark.range(0, 20000, 100).select(F.concat(F.lit("c"), F.col("id") + 1000000).alias("query"))
    pieces, names = search._pieces(q), search._uses(e).select("name").distinct()
    frequency = search._name_grams(names).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    assert search._name_grams(names).join(search._rarest(pieces, frequency), "g").count() == 200
    found = search.search(e, q.unionByName(spark.createDataFrame([("large",)], "query string"))).groupBy("query").count().groupBy("count").count()
    assert {r[0]: r[1] for r in found.collect()} == {1: 200, 20000: 1}


def test_change_plan_cases(spark):
    page = spark.createDataFrame([("a", "A", "1"), ("b", "B", "1"), ("c", "C", "1"), ("d", "D", "1")], "slug string, mpn string, v string")
    old = publish.build_keys(page.where("slug <> 'd'").withColumn("v", F.when(F.col("slug") == "b", "0").otherwise("1")), ["v"])
    edges = spark.createDataFrame([("a", "d")], "source string, target string")
    plan = publish.change_plan(publish.build_keys(page, ["v"]), old, edges)
    assert sorted((r["slug"], r["action"], r["kind"]) for r in plan.collect()) == [
        ("a", "UPDATE", "dependency-induced"), ("b", "UPDATE", "direct"), ("c", "SKIP", ""), ("d", "CREATE", "")]
    asked = spark.createDataFrame([("d",)], "slug string")
    assert [r["slug"] for r in publish.unexpected_writes(plan, asked).collect()] == ["b"]


def test_ranks_and_slices(spark):
    df = spark.range(5000).withColumn("ord", F.col("id")).withColumn("mpn", F.concat(F.lit("P"), F.col("id").cast("string"))).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("mpn")))
    sizes = ordering.slice_manifest(ordering.plan_slices(df)).collect()
    assert len(sizes) == 10 and {r["n"] for r in sizes} == {500}
    spread = ordering.global_rank(df.repartition(5), ["ord"], "r", partitions=7)
    assert spread.where("r <> ord + 1").count() == 0 and spread.count() == 5000
    r = ordering.grouped_rank(df, ["k"], ["ord"], "r", "n", partitions=7).where("k = 'hot'").agg(F.max("r"), F.countDistinct("r"), F.max("n")).first()
    assert tuple(r) == (1667, 1667, 1667)
    tree = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, 1, "d"), (5, 3, "e")], "ord long, level int, id string")
    assert [(x["l1_id"], x["l2_id"]) for x in ordering.carry_parent(tree).orderBy("ord").collect()] == [("a", None), ("a", "b"), ("a", "b"), ("d", None), ("d", None)]
    dup = spark.createDataFrame([(1, "x", "1"), (2, "x", "2"), (3, "x", "3"), (4, "x", "2")], "ord long, base string, id string")
    assert [x["seo_slug"] for x in ordering.unique_seo_slugs(dup).orderBy("ord").collect()] == ["x", "x-2", "x-3", "x-4"]


def test_log_states(spark):
    log = spark.createDataFrame([("b", 1, "INTAKE"), ("b", 2, "QUALIFICATION"), ("b", 3, "BUILT"), ("c", 1, "INTAKE"), ("c", 2, "FAILED"), ("c", 3, "INTAKE")], "k string, t int, s string")
    assert [(r["k"], r["before"], r["s"]) for r in logs.validate_transitions(log, "k", ["t"], "s").collect()] == [("b", "QUALIFICATION", "BUILT")]
    codes = spark.createDataFrame([("h", i, c) for i, c in enumerate([429, 429, 200, 500, 500, 500, 500, 500, 429])], "k string, t int, c int").withColumn("kind", logs.status_class(F.col("c")))
    got = sorted((r["kind"], r["length"]) for r in logs.error_streaks(codes, "k", ["t"], "kind", ["429", "5xx"], 2).collect())
    assert got == [("429", 2), ("5xx", 5)]


def test_stream_restart_adds_nothing(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "ord long, mpn string, manufacturer string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(src))
    def run():
        jobs.incremental_intake(jobs.read_files(spark, str(src), spark.createDataFrame([], schema).schema), out, cp).awaitTermination()
        return sorted(r["mpn"] for r in spark.read.parquet(out).collect())
    write([(1, "A", "TI"), (2, "a", "TI"), (3, "B", "TI")])
    assert run() == ["A", "B"]
    assert run() == ["A", "B"]
    write([(4, "B", "TI"), (5, "C", "TI")])
    assert run() == ["A", "B", "C"]


def test_fingerprint_deals_rows_into_no_fixed_number_of_tasks(spark, sf):
    from catalogflow.queries import jobs

    plan = jobs.table_fingerprint(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan and "REPARTITION_BY_NUM" not in plan


def test_introduction_of_equal_order(spark):
    df = spark.createDataFrame([("C0", "m")], "cid string, mpn string")
    for texts in (["About a", "About b"], ["About b", "About a"]):
        raw = spark.createDataFrame([(0, "C0", t) for t in texts], "ord long, key string, introduction string").coalesce(1)
        assert [r["introduction"] for r in identity.own_introduction(df, raw, "cid", "mpn").collect()] == ["About b"]


def test_merge_takes_first_filled_value_and_sources_by_place(spark):
    """Each column from the first offer that has it, whichever others it lacks; sources in the order of a place of nested fields."""
    rows = [(2, 1, "P", "a", "", "", "s2"), (1, 2, "P", "a", "", "k2", "s1"), (1, 1, "P", "a", "", "", "s3"), (3, 0, "P", "a", "d3", "k3", "s2"), (2, 2, "P", "a", "d2", "", ""), (1, 0, "Q", "b", "", "", "")]
    df = spark.createDataFrame(rows, "x long, y long, mpn string, manufacturer string, description string, keywords string, source string")
    df = df.withColumn("ord", F.struct(F.struct("x").alias("u"), "y")).drop("x", "y")
    m = merge.merge_offers(df.repartition(3), spark.createDataFrame([("a", "A")], "raw string, canonical string")).groups
    got = {r["mpn"]: (r["manufacturer"], r["offers"], r["description"], r["keywords"], list(r["sources"]), r["ord"]["y"]) for r in m.collect()}
    assert got == {"P": ("A", 5, "d2", "k2", ["s3", "s1", "s2"], 1), "Q": ("b", 1, None, None, [], 0)}
    # whole rows are grouped by what they have, not by source
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert any("Aggregate" in line and "_filled" in line and "min_by" in line for line in plan.splitlines())
    assert not any("Aggregate" in line and "_source" in line and "min_by" in line for line in plan.splitlines())


def test_costly_rows_are_dealt_out(spark, sf):
    """A table of one split is worked on by many tasks: the texts of families and the facts of pages."""
    from catalogflow import bindings as b
    from catalogflow.queries import family
    from catalogflow.queries import jobs as job_queries

    assert b.parts(spark, sf).rdd.getNumPartitions() == 1
    assert b.tasks_for(b.parts(spark, sf), rows=2) == b.parts(spark, sf).count() // 2
    least = 4 * spark.sparkContext.defaultParallelism
    assert family.family_texts(spark, sf).rdd.getNumPartitions() == least
    plan = job_queries.page_records(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and f", {least}" in plan


def test_listings_are_dealt_out_by_lines(spark, sf, monkeypatch):
    """Tasks grow with the order lines, and the rows stay as they are."""
    from catalogflow import bindings as b

    lines = b.read(spark, sf, "lineitem").count()
    assert b.listing_tasks(spark, sf) is None and b.listing_tasks(spark, sf, lines // 20) >= 20
    few = b.master(spark, sf)
    want = sorted(map(tuple, few.collect()))
    tasks = b.listing_tasks
    monkeypatch.setattr(b, "listing_tasks", lambda spark, sf: tasks(spark, sf, lines // 20))
    many = b.master(spark, sf)
    held = many.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
    assert sorted(map(tuple, many.collect())) == want
    assert held[0] >= 18 and held[1] < len(want) / 8


def test_enrich_by_code_deals_each_side_once(spark):
    raw = spark.range(300).select(F.col("id").alias("ord"), F.concat(F.when(F.col("id") < 150, "c").otherwise(" C"), (F.col("id") % 100).cast("string")).alias("rc"), (F.col("id") * 7).alias("known"))
    raw = raw.unionByName(spark.createDataFrame([(-1, " ", 5), (-2, None, 6)], "ord long, rc string, known long"))
    df = spark.range(120).select(F.when(F.col("id") < 118, F.concat(F.lit("C"), F.col("id").cast("string"))).when(F.col("id") < 119, "").alias("code"))
    want = sorted([(f"C{i}", i * 7 if i < 100 else None) for i in range(118)] + [("", None), (None, None)], key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (None, 23):
            out = identity.enrich_by_code(df, raw, "code", "rc", ["known"], partitions=n)
            assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
            assert sorted(map(tuple, out.collect()), key=str) == want
        assert out.rdd.getNumPartitions() == 23
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_catalog_build_merges_once(spark):
    """Offers are gone through once for the parts and once for their sources, not again for the slugs."""
    seen = spark.sparkContext.accumulator(0)

    def told(name):
        seen.add(1)
        return name

    offers = spark.createDataFrame([(1, "M-1", "maker", "s2", "C1"), (2, "m-1", "Maker", "s1", "C1"), (3, "M 1", "MAKER", "s2", "C3"), (4, "M-1", "other", "s1", "C4")],
                                   "ord long, mpn string, manufacturer string, source string, supplier_reference string")
    offers = offers.withColumn("manufacturer", F.udf(told)("manufacturer")).withColumns({"native_l1": F.lit("a"), "description": F.lit("d")})
    alias = spark.createDataFrame([("maker", "Maker")], "raw string, canonical string")
    none = spark.createDataFrame([], "code string, mpn string, manufacturer string, slug string")
    tops = spark.createDataFrame([("t", "T", "active")], "slug string, name string, publish_status string")
    l1 = spark.createDataFrame([("a", "t", "A", "active")], "slug string, top_scope string, en_display string, publish_status string")
    records = publish.catalog_build(offers, alias, none, tops, l1).records
    got = sorted((r["mpn"], r["manufacturer"], r["url_slug"], r["top"], r["offers"], r["sources"]) for r in records.collect())
    assert got == [("M 1", "Maker", "m1-maker", "t", 1, ["s2"]), ("M-1", "Maker", "m1", "t", 2, ["s2", "s1"]), ("M-1", "other", "m1-other", "t", 1, ["s1"])]
    assert seen.value <= 2 * 4
