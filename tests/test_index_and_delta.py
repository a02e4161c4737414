"""The kept search index and the incremental change plan against their full runs."""

import random

from pyspark.sql import functions as F

from catalogflow.operators import identity
from catalogflow.plans import publish, search


def entries(spark, names):
    rows = [(f"e{i}", ["PART", "CATEGORY"][i % 2], n, [n.lower().replace(" ", "")] if i % 3 else None, f"/{i}") for i, n in names]
    return spark.createDataFrame(rows, "entry_id string, type string, label string, aliases array<string>, url string")


def files_read(df):
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan "):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_index_equals_full_search(spark, tmp_path):
    rng = random.Random(2)
    names = list(enumerate(rng.choice(["Chip", "Power", "MOS fet", "Low Drop Out", ""]) + " " + rng.choice("abxyz") * rng.randrange(4) + str(rng.randrange(300)) for _ in range(240)))
    queries = spark.createDataFrame([(q,) for q in ["chip 1", "p", "LDO", "out", "x", "", None, "zzzz", "12", "mos fet", "ldo 1"]], "query string")
    index = search.SearchIndex(spark, str(tmp_path / "i"), 32)
    index.add(entries(spark, names[:150]), "a")
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "i").rglob("*.parquet")}
    index.add(entries(spark, names[150:]), "b")
    # a later batch leaves the files of the earlier one alone
    assert {p: t for p, t in before.items()} == {str(p): p.stat().st_mtime_ns for p in (tmp_path / "i").rglob("*.parquet") if "batch=a" in str(p)}
    key = lambda d: sorted((r["query"], r["entry_id"], r["score"]) for r in d.collect())
    want = key(search.search(entries(spark, names), queries))
    assert len(want) > 100 and key(index.search(queries)) == want
    index.add(entries(spark, names[150:]), "b")  # the same batch again
    assert key(index.search(queries)) == want
    rare = spark.createDataFrame([("ldo",), ("fet",)], "g string")
    read, all_ = files_read(index.rows("text", rare)), len(list((tmp_path / "i" / "text").rglob("*.parquet")))
    assert 0 < read <= 4 and all_ > 40


PAGES = "slug string, mpn string, grp string, ord long, price long"


def full(spark, rows):
    df = spark.createDataFrame(rows, PAGES)
    return df, publish.build_keys(df, ["mpn", "price"], identity.related_neighbours(df, "grp", "slug"))


def test_incremental_equals_full(spark):
    for seed in range(2):
        rng = random.Random(seed)
        # slugs in several groups, small groups that wrap, null groups
        rows = [(f"s{rng.randrange(60)}", f"M{i}", rng.choice(["a", "b", "c", "d", "e", None]), i, i % 7) for i in range(70)]
        one = {r[0]: r for r in rows}
        rows = sorted(one.values(), key=lambda r: r[3]) if seed else rows
        new = [r for r in rows if rng.random() < 0.95] + [(f"t{i}", f"N{i}", rng.choice("ab"), 1000 + i, 1) for i in range(2)]
        new = [(s, m + "-R" if rng.random() < 0.05 else m, g, o, p + (rng.random() < 0.1)) for s, m, g, o, p in new]
        old_df, old_keys = full(spark, rows)
        new_df, want = full(spark, new)
        got = publish.incremental_keys(new_df, old_keys, publish.places(old_df, "grp", "ord"), ["mpn", "price"], "grp", "ord")
        order = sorted(want.columns)
        assert sorted(map(tuple, got.select(order).collect())) == sorted(map(tuple, want.select(order).collect()))


def test_only_a_neighbour_changed(spark):
    rows = [(f"s{i}", f"M{i}", "ab"[i % 2], i, 1) for i in range(40)]
    old_df, old_keys = full(spark, rows)
    new = [r if r[0] != "s20" else ("s20", "M20-R", *r[2:]) for r in rows]
    new_df = spark.createDataFrame(new, PAGES)
    keys = publish.incremental_keys(new_df, old_keys, publish.places(old_df, "grp", "ord"), ["mpn", "price"], "grp", "ord")
    plan = {r["slug"]: (r["action"], r["kind"]) for r in publish.change_plan(keys, old_keys).collect()}
    assert plan["s20"] == ("UPDATE", "direct")
    # the six before it in its group list it; the other group is not touched
    assert {s for s, a in plan.items() if a == ("UPDATE", "dependency-induced")} == {f"s{i}" for i in range(8, 20, 2)}
    assert {r[0] for r in publish.changed_groups(publish.places(new_df, "grp", "ord"), publish.places(old_df, "grp", "ord")).collect()} == {"a"}
    same = publish.incremental_keys(old_df, old_keys, publish.places(old_df, "grp", "ord"), ["mpn", "price"], "grp", "ord")
    assert publish.change_plan(same, old_keys).where(F.col("action") != "SKIP").count() == 0
