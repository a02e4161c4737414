"""Extension points: added families, table functions."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from catalogflow import rules, sql
from catalogflow.functions import classify
from catalogflow.functions.families import Attribute, Family, registered
from catalogflow.operators import logs
from catalogflow.operators.gates import qualify

RELAY = Family("Relay", "relays", parents=("logic",), catalogs=("relay",), descriptions=(r"\bcoil\b",), keys=("线圈",), attributes=(Attribute("coil_v", "voltage", "1", ("线圈",)),))


def test_family_is_known_inside_only(spark):
    rows = [("Logic", "", "", "", "{}"), ("", "Signal Relay", "", "", "{}"), ("", "", "relay", "", "{}"), ("", "", "", "a coil", "{}"), ("", "", "", "", '{"线圈":"5V"}'), ("", "MLCC", "", "", "{}")]
    df = spark.createDataFrame(rows, "p string, c string, k string, d string, j string").coalesce(1)
    families = lambda: [r[0] for r in df.select(classify.detect_family("p", "c", "k", "d", "j")["family"]).collect()]
    before = families()
    tables = {n: rules.table(n) for n in ("families", "catalog_patterns")}
    with registered(RELAY):
        assert families() == ["Relay"] * 5 + ["Capacitor"]
        built = df.select(F.to_json(classify.project_source(F.lit("Relay"), F.lit('{"线圈":"12.34V"}'), "d", F.lit("M"))).alias("a"))
        assert classify.family_l1()["Relay"] == "relays"
        conflicts = df.limit(1).select(classify.family_conflict(F.lit("Relay"), F.lit("diodes")), classify.family_conflict(F.lit("Relay"), F.lit("relays")))
    # a column built inside keeps what it was built with
    assert built.first()["a"] == '{"coil_v":12.3}' and conflicts.first()[:] == (True, False)
    assert families() == before and "Relay" not in classify.family_l1()
    assert {n: rules.table(n) for n in tables} == tables


def test_extensions_nest_and_end_on_errors(spark):
    with pytest.raises(RuntimeError):
        with registered(RELAY):
            with registered(Family("Other", "other", catalogs=("relay",))):
                assert rules.table("catalog_patterns")[:2] == (("relay", "Other"), ("relay", "Relay"))
            assert rules.table("catalog_patterns")[0] == ("relay", "Relay")
            raise RuntimeError
    assert "Relay" not in {r[1] for r in rules.table("catalog_patterns")}
    with pytest.raises(ValueError):
        registered(RELAY, RELAY)


def test_added_family_qualifies_with_one_attribute(spark):
    df = spark.createDataFrame([("Relay",), ("Nothing",)], "family string").withColumns({c: F.lit("x") for c in ("mpn", "manufacturer", "brand", "description", "category", "keywords")}).withColumn("attributes_json", F.lit('{"a":1}')).withColumns({"clean_mpn": F.lit("x"), "native_l1": F.lit("l"), "datasheet_url": F.lit(""), "supplier_reference": F.lit("C1"), "source_kind": F.lit(""), "needs_review": F.lit(False)})
    with registered(RELAY):
        got = {r["family"]: r["code"] for r in qualify(df).select("family", "code").collect()}
    assert got["Relay"] == "" and got["Nothing"] == "SPEC_THIN"


def test_streaks_in_sql(spark):
    sql.register(spark)
    kinds = ["e", "e", "v", "v", "v", "x", "e", None, "e", "e", "e"]
    log = spark.createDataFrame([(k, i, kind) for k in (None, 1, 2) for i, kind in enumerate(kinds[: 11 if k != 2 else 1])], "key int, at int, kind string").repartition(4)
    got = spark.sql("SELECT * FROM error_streaks(TABLE({log}) PARTITION BY key ORDER BY (at), 'e,v', 2)", log=log)
    want = logs.error_streaks(log.where("key IS NOT NULL"), "key", ["at"], "kind", ["e", "v"], 2).select("key", "kind", "length", "from_at", "to_at")
    assert sorted(map(tuple, got.where("key IS NOT NULL").collect())) == sorted(map(tuple, want.collect()))
    assert got.where("key IS NULL").count() == 3
    assert spark.sql("SELECT * FROM error_streaks(TABLE({log}) PARTITION BY key ORDER BY (at), 'e', 2)", log=log.limit(0)).count() == 0
    with pytest.raises(AnalysisException, match="needs a column at"):
        spark.sql("SELECT * FROM error_streaks(TABLE({log}) PARTITION BY (key), 'e', 2)", log=log.drop("at")).collect()


def test_nodes_in_sql(spark):
    sql.register(spark)
    nodes = spark.createDataFrame([("a", "n1", 3, 1), ("a", "n2", 1, 2), ("a", "n3", 2, 3), ("a", "n4", 3, 4), ("a", "n5", 1, 5), ("a", "n6", 3, 6)], "key string, id string, level int, o int")
    got = spark.sql("SELECT id, l1_id, l2_id FROM carry_parent(TABLE({nodes}) PARTITION BY key ORDER BY (o))", nodes=nodes)
    assert sorted(map(tuple, got.collect()), key=str) == [("n1", None, None), ("n2", "n2", None), ("n3", "n2", "n3"), ("n4", "n2", "n3"), ("n5", "n5", None), ("n6", "n5", None)]
