import json

import pytest
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.sinks import files as sinks
from catalogflow.sources import files as src


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_master_with_byte_order_mark(spark, tmp_path):
    p = write(tmp_path / "m.csv", '﻿mpn,manufacturer,description\nA1,TI,"two\nlines"\n')
    df = src.read_master(spark, p, ("mpn", "manufacturer", "description"))
    assert df.columns[0] == "mpn"
    assert df.collect()[0]["description"] == "two\nlines"
    assert [r["mpn"] for r in src.scan_keys(df).collect()] == ["A1"]
    with pytest.raises(src.SchemaMismatch):
        src.read_master(spark, p, ("manufacturer", "mpn", "description"))


def test_jsonl_keeps_good_lines_and_counts_damaged(spark, tmp_path):
    p = write(tmp_path / "log.jsonl", '{"mpn":"A"}\n{"mpn":"B"\n{"mpn":"C"}\n')
    good, bad = src.read_jsonl_tolerant(spark, p, schemas.strings("mpn"))
    assert sorted(r["mpn"] for r in good.collect()) == ["A", "C"]
    assert bad.count() == 1


def envelope(code, model, **extra):
    product = {
        "productCode": code, "productModel": model, "brandNameEn": "TI", "catalogName": "Leaf", "catalogId": 7,
        "parentCatalogName": "Diodes", "wmCatalogNameEn": "Schottky Diodes", "productNameEn": "Diode", "eccn": "EAR99",
        "isRohsCert": True, "rohsCertType": "RoHS3", "htsMap": {"US": "1", "CN": "2", "JP": "3"},
        "productImages": ["", " http://x/y.jpg "],
        "paramVOList": [
            {"paramName": "x", "paramNameEn": "Voltage - Forward(Vf@If)", "paramValueEn": "550mV@1A", "isMain": True, "sort": 1},
            {"paramName": "容值", "paramNameEn": "", "paramValue": "100nF"},
            {"paramName": "x", "paramNameEn": "Tolerance", "paramValueEn": "±10%"},
        ],
        "parentCatalogList": [{"catalogId": 1, "catalogNameEn": "Root"}, {"catalogId": 2, "catalogNameEn": "Leaf"}],
        "faqs": [{"question": "Max temp?", "answer": "125"}],
    }
    product.update(extra)
    return {"c_number": code, "source_raw": {
        "main_product": product, "overviewData": {"productIntroEn": "An intro", "pdfApplicationAreasEn": "Power"},
        "alternatePartList": [{"productModel": "B2", "brandNameEn": "ST"}, {"productModel": " "}]}}


def test_envelopes(spark, tmp_path):
    (tmp_path / "C1.json").write_text(json.dumps(envelope("C1", "A1"), indent=1), encoding="utf-8")
    (tmp_path / "C2.json").write_text("{broken", encoding="utf-8")
    (tmp_path / "other.json").write_text("{}", encoding="utf-8")
    good, bad = src.read_envelopes(spark, str(tmp_path))
    assert [r["key"] for r in bad.collect()] == ["C2"]
    r = src.flatten_envelope(good).collect()[0]
    assert (r["key"], r["mpn"], r["supplier_sku"]) == ("C1", "A1", "C1")
    assert r["description"] == "Diode - An intro"
    assert json.loads(r["attributes_json"]) == {"vf_v": "550mV@1A", "capacitance": 1e-7}
    assert json.loads(r["attributes_json_unmapped"]) == {"Tolerance": "±10%"}
    assert r["alternative_parts"] == "B2"
    assert json.loads(r["alternative_parts_detail"]) == [{"mpn": "B2", "manufacturer": "ST", "lcsc": "", "type": "Similar", "package": ""}]
    assert r["source_image_url"] == "http://x/y.jpg"
    assert json.loads(r["lcsc_parent_chain"]) == [{"id": 1, "name": "Root"}, {"id": 7, "name": "Leaf"}]
    assert (r["lcsc_depth"], r["lcsc_parent_name"]) == ("2", "Root")


def test_alias_map_last_row_wins(spark, tmp_path):
    p = write(tmp_path / "alias.tsv", "TI\tTexas\nti\tTexas Instruments\nX\t\n\tY\n")
    assert {r["raw"]: r["canonical"] for r in src.read_alias_map(spark, p).collect()} == {"ti": "Texas Instruments"}


def test_lexicon_ledger_taxonomy_overrides(spark, tmp_path):
    p = write(tmp_path / "lex.json", json.dumps({"keys": {"a": "A"}, "value_map": [{"zh": "b", "en": "B"}]}))
    assert [tuple(r) for r in src.read_lexicon(spark, p, "keys").collect()] == [("a", "A")]
    assert [tuple(r) for r in src.read_lexicon(spark, p, "value_map").collect()] == [("b", "B")]
    for body in ([{"mpn": "A", "status": "FAILED"}], {"records": [{"mpn": "A", "status": "FAILED"}]}):
        q = write(tmp_path / "ledger.json", json.dumps(body))
        spark.catalog.clearCache()
        assert [(r["mpn"], r["status"]) for r in src.read_ledger(spark, q).collect()] == [("A", "FAILED")]
    t = write(tmp_path / "tax.json", json.dumps({"top_scopes": [{"slug": "t", "name": "T", "publish_status": "Review"}], "l1_categories": [{"slug": "l", "top_scope": "t"}]}))
    tops, l1 = src.read_taxonomy(spark, t)
    assert tops.collect()[0]["publish_status"] == "review" and l1.collect()[0]["publish_status"] == "active"
    assert src.read_overrides(spark, str(tmp_path / "none.csv")).count() == 0


def test_latest_snapshot_patch_documents(spark, tmp_path):
    write(tmp_path / "m_20260101.csv", "mpn,v\na,1\n")
    write(tmp_path / "m_20260201.csv", "mpn,v\na,2\nA,3\nb,4\n")
    df = src.latest_snapshot(spark, str(tmp_path), "m_*.csv", schemas.strings("mpn", "v"))
    assert sorted((r["mpn"], r["v"]) for r in df.collect()) == [("A", "3"), ("b", "4")]
    with pytest.raises(src.SchemaMismatch):
        src.read_patch(spark, str(tmp_path / "m_20260101.csv"), ["mpn", "faq"])
    body = b"%PDF-1.4" + b"x" * 2000 + b"%%EOF"
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "abc__C1.pdf").write_bytes(body)
    (tmp_path / "sub" / "bad.pdf").write_bytes(b"x" * 2000)
    docs = {r["doc_id"]: r for r in src.index_documents(spark, str(tmp_path)).withColumn("e", src.document_error("content")).collect()}
    assert docs["C1"]["size"] == len(body) and docs["C1"]["e"] == "" and docs["bad"]["e"] == "NO_PDF_MARK"


def test_enrichment(spark, tmp_path):
    write(tmp_path / "a1.content.json", '{"schema_version":"1","x":1}')
    write(tmp_path / "b.content.json", '{"x":1}')
    write(tmp_path / "c.content.json", "{")
    ok, skipped = src.read_enrichment(spark, str(tmp_path))
    assert {r["name"]: r["reason"] for r in skipped.collect()} == {"b": "no schema_version", "c": "invalid JSON"}
    df = spark.createDataFrame([("a1", "Z"), ("q", "A1"), ("n", "N")], "url_slug string, mpn string")
    got = {r["url_slug"]: r["enrich_fp"] for r in src.attach_enrichment(df, ok).collect()}
    assert got["a1"] == got["q"] != "NO_ENRICH" and got["n"] == "NO_ENRICH"


def test_ranked_feed(spark):
    products = [{"productCode": "C1", "productModel": "M", "brandNameEn": "B", "catalogName": "Power MOSFET", "pdfUrl": "http://d/x.pdf?t=1",
                 "productImages": ["http://i/1.jpg?x"], "paramVOList": [{"paramName": "a", "paramValue": "1"}, {"paramName": "", "paramValue": "2"}]}]
    schema = "page int, products array<struct<productCode string, productModel string, brandNameEn string, catalogName string, pdfUrl string, productImages array<string>, paramVOList array<struct<paramName string, paramValue string>>>>"
    r = src.flatten_ranked_feed(spark.createDataFrame([(2, products)], schema)).collect()[0]
    assert (r["rank"], r["category"], r["attributes_json"], r["source_image_url"], r["source_datasheet_url"]) == (101, "MOSFET", '{"a":"1"}', "http://i/1.jpg", "http://d/x.pdf")


def test_append_validated(spark, tmp_path):
    cols = list(schemas.MASTER_COLUMNS)
    def rows(*mpns, **kw):
        base = spark.createDataFrame([(m, "TI", "d") for m in mpns], "mpn string, manufacturer string, description string")
        for c in cols:
            if c not in base.columns:
                base = base.withColumn(c, F.lit(kw.get(c, "")))
        return base.select(*cols)
    old = rows("A", "B")
    ok = sinks.append_validated(spark, old, rows("C"), str(tmp_path / "s1"))
    assert ok.ok and ok.rows == 3
    bad = sinks.append_validated(spark, old, rows("B"), str(tmp_path / "s2"))
    assert not bad.ok and bad.problems == ["duplicate identity: 1"] and not (tmp_path / "s2").exists()
    changed = sinks.append_validated(spark, old, rows("C"), str(tmp_path / "s3"), updated=rows("A", "B", keywords="k"))
    assert not changed.ok and changed.problems == ["pre-existing rows modified: 2"]
    allowed = sinks.append_validated(spark, old, rows("C"), str(tmp_path / "s4"), updated=rows("A", "B", keywords="k"), allow_updates=old.select("mpn"))
    assert allowed.ok


def test_writers(spark, tmp_path):
    urls = spark.range(200).select(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("url"), "id")
    one = sinks.url_shards(urls, ["id"])
    assert [r["file"] for r in sinks.url_index(one).collect()] == ["sitemap_parts"]
    many = sinks.url_shards(urls, ["id"], size=90)
    assert sorted((r["file"], r["n"]) for r in sinks.url_index(many).collect()) == [("sitemap_parts_1", 90), ("sitemap_parts_2", 90), ("sitemap_parts_3", 20)]
    sinks.write_url_shards(many, str(tmp_path / "u"))
    assert spark.read.text(str(tmp_path / "u")).count() == 200
    batches = spark.createDataFrame([("b1", "A"), ("b2", "B")], "batch_id string, mpn string")
    sinks.write_candidates(batches, str(tmp_path / "c"))
    sinks.write_candidates(batches.where("batch_id='b1'").withColumn("mpn", F.lit("Z")), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "c")).select("batch_id", "mpn").collect()) == [("b1", "Z"), ("b2", "B")]
    sinks.append_log(batches, str(tmp_path / "l"))
    sinks.append_log(batches, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 4
    s = sinks.search_shards(urls, ["id"], size=150)
    sinks.write_search_shards(s, str(tmp_path / "s"), ["id"])
    assert sorted(r["n"] for r in sinks.shard_manifest(s, "url").collect()) == [50, 150]


def test_listing_and_reading_of_shards(spark, tmp_path):
    """Files in the folder and in its shards, listed and read by many tasks; other names and folders, hidden files and files of no text."""
    from catalogflow import bindings
    from catalogflow.sinks.files import write_documents

    rows = [(f"C{i}.json", b'{"c_number":"C%d"}' % i if i else b"\xff") for i in range(50)]
    written = write_documents(bindings.dealt(spark.createDataFrame(rows, "name string, content binary").coalesce(1), "name"), str(tmp_path), shards=7)
    assert written.rdd.getNumPartitions() > 8 and written.count() == 50
    assert len(list(tmp_path.iterdir())) == 7
    for name in ("C900.json", "X1.json", "_C1.json", ".C2.json", "other/C901.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text('{"c_number":"%s"}' % name)
    for path in (str(tmp_path), f"file://{tmp_path}"):
        read = src.scan_envelopes(spark, path)
        assert read.rdd.getNumPartitions() > 8
        assert {r["key"]: r["damaged"] is None for r in read.collect()} == {f"C{i}": i > 0 for i in range(50)} | {"C900": True}
    assert src.scan_envelopes(spark, str(tmp_path), names="^C4").count() == 11
