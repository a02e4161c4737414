"""JSON as rows against a recursive walk written out here."""

import json
import random

from pyspark.sql import functions as F

from catalogflow.functions.attrs import INTERNAL_KEYS
from catalogflow.operators import json_tree


def tree(rng, depth):
    turn = rng.random()
    if depth == 0 or turn < 0.2:
        return rng.choice([1, -5, "x", "costPrice", '"costPrice": 1', "", None, True, {}, [], "é\n\"q\""])
    if turn < 0.5:
        return [tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    names = ["a", "b", "c d", 'q"', "é", *INTERNAL_KEYS[:3]]
    return {k: tree(rng, depth - 1) for k in rng.sample(names, rng.randrange(6))}


def walk(node, path, found):
    if isinstance(node, dict):
        kept = {}
        for key, value in node.items():
            here = f"{path}.{key}" if path else key
            if key in INTERNAL_KEYS:
                found.append((here, key, value))
            else:
                kept[key] = walk(value, here, found)
        return kept
    if isinstance(node, list):
        return [walk(v, f"{path}[{i}]", found) for i, v in enumerate(node)]
    return node


def test_isolated_at_any_depth(spark):
    rng = random.Random(3)
    texts = [json.dumps(tree(rng, rng.randrange(8)), ensure_ascii=bool(i % 2)) for i in range(120)]
    texts += [None, "", "{", '{"costPrice":', '{"costPrice": 1, "costPrice": 2}', texts[0], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, s string").repartition(4)
    got = {r["ord"]: r["out"] for r in json_tree.isolate_keys_in(df, "s", "out").collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        found = []
        try:
            if i >= 120:
                raise ValueError
            want = walk(json.loads(text), "", found)
        except ValueError:
            if i < 125:
                assert got[i]["public"] == text and got[i]["isolated"] == []
            continue
        assert json.loads(got[i]["public"]) == want
        assert sorted((x["path"], x["key"]) for x in got[i]["isolated"]) == sorted(f[:2] for f in found)
        assert [json.loads(x["value"]) for x in sorted(got[i]["isolated"], key=lambda x: x["path"])] == [v for _, _, v in sorted(found, key=lambda f: f[0])]


def test_no_python_and_no_rows(spark):
    empty = spark.createDataFrame([], "ord long, s string")
    out = json_tree.isolate_keys_in(empty, "s", "out")
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().toString()
    assert json_tree.leaked_keys_in(empty, "ord", "s", ["cost"]).count() == 0
    pages = spark.createDataFrame([], "page_id long, html string, code string")
    assert json_tree.state_products(pages, "page_id", "html", "code").count() == 0


def test_leaks_with_places(spark):
    df = spark.createDataFrame([(1, '{"a":[{"cost":1},{"x":{"cost":{"cost":2}}}],"t":"\\"cost\\": 1"}'), (2, "[]"), (3, None)], "ord long, s string")
    got = json_tree.leaked_keys_in(df, "ord", "s", ["cost"])
    assert {(r["doc"], r["path"]) for r in got.collect()} == {(1, "a[0].cost"), (1, "a[1].x.cost"), (1, "a[1].x.cost.cost")}


def test_product_is_the_one_asked_for(spark):
    script = lambda s: f'<p>x</p><script id="__NEXT_DATA__">{s}</script>'
    at_place = '{"props":{"pageProps":{"webData":%s}}}'
    cases = [
        (script(at_place % '{"productCode":"C1","productModel":"M"}'), "C1", "", "props.pageProps.webData"),
        (script('{"x":{"productCode":"C1"},"props":{"pageProps":{"webData":{"productCode":"C1"}}}}'), "C1", "", "props.pageProps.webData"),
        (script('{"z":[{"productCode":"C2"},{"y":{"productCode":"C1"}}]}'), "C1", "", "z[1].y"),
        (script(at_place % '{"productCode":"C2"}'), "C1", "c_number_mismatch", None),
        (script(at_place % '{"productCode":"C2"}'), None, "main_product_not_found", None),
        (script(at_place % "[1]"), "C1", "main_product_not_found", None),
        (script('{"props":'), "C1", "json_parse", None),
        (script('{"props":{"pageProps":{"dataIsNull":true}}}'), "C1", "data_is_null", None),
        ("<p>productCode</p>", "C1", "next_data_missing", None),
        (None, "C1", "next_data_missing", None),
    ]
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "page_id long, html string, code string")
    got = {r["page_id"]: (r["error"], r["path"]) for r in json_tree.state_products(df, "page_id", "html", "code").collect()}
    assert [got[i] for i in range(len(cases))] == [c[2:] for c in cases]


def test_rebuilt_whole(spark):
    rng = random.Random(8)
    texts = [json.dumps(tree(rng, 6)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, s string").withColumn("v", F.parse_json("s"))
    got = {r["doc"]: json.loads(r["json"]) for r in json_tree.rebuilt(json_tree.json_levels(df, "doc", "v")).collect()}
    assert got == {i: json.loads(t) for i, t in enumerate(texts)}


def test_nothing_is_broadcast(spark):
    """Levels grow with the texts, and Spark takes them for as small as what they came from."""
    texts = spark.range(2).select("id", F.concat(F.lit('{"a":{"costPrice":'), F.col("id").cast("string"), F.lit("}}")).alias("s"))
    states = spark.range(2).select("id", F.lit("C1").alias("code"), F.lit('<script id="__NEXT_DATA__">{"x":{"productCode":"C1"}}</script>').alias("html"))
    for out in (json_tree.isolate_keys_in(texts, "s", "out"), json_tree.state_products(states, "id", "html", "code")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
