"""Mixing, centroids and ranked search against plain runs written out here."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow.llm import centroids, mixing, ranked

# ---- mixing -------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, size int, target double, rate double, x string, cls int, block int, copy int, h int, n_chars long"


def texts(rng, n, sources, longest=40):
    out = []
    for i in range(n):
        size = rng.randrange(longest) if rng.random() < 0.95 else rng.randrange(500)
        out.append((i, None if i % 50 == 7 else "\t".join(["wörd"] * size) + rng.choice(["", " ", "\n"]), rng.choice(sources), 1, 1.0, 1.0, "x", 1, 1, 1, 1, 1))
    return out


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(w[s] for s in open_)
        over = {s for s in open_ if per * w[s] >= most * sizes[s]}
        if not over:
            return target | {s: per * w[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def n_words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("seed", range(1))
def test_mix(spark, seed):
    rng = random.Random(seed)
    rows = texts(rng, 900, ["a", "B", "é", "ab", None, ""] + ["hot"] * 6)
    rows += [rows[3]] * 40 + [(None, "one two three", "a", *rows[0][3:])] * 2 + [(5000, "", "empty", *rows[0][3:])]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = mixing.mix_sources(df).collect()
    again = mixing.mix_sources(df.repartition(3)).collect()
    key = lambda rs: sorted(map(str, rs))
    assert key(got) == key(again) and len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += n_words(r[1])
    want = plain_targets(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        copies = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["taken"] in {math.floor(copies) * r["size"], math.ceil(copies) * r["size"]} and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 3
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], n_words(r[1])) for r in rows)


def test_each_document_has_its_chance(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, " ".join("w" * rng.randrange(1, 30)), "ab"[i % 2]) for i in range(150)], "doc_id long, text string, source string").cache()
    seen = Counter()
    rounds = 5
    for seed in range(rounds):
        for r in mixing.mix_sources(df, weights=(1, 1), share=0.4, seed=seed).collect():
            seen[r["doc_id"]] += r["taken"] > 0
    # each is taken with a chance of about 0.4
    assert abs(sum(seen.values()) / (150 * rounds) - 0.4) < 0.06 and len(seen) > 125


def test_pair_keeps_words(spark):
    rng = random.Random(4)
    item = mixing._ITEM.format(id="bigint")
    rows = []
    for g in range(200):
        items = [(rng.randrange(1 << 40), i, 1, s := rng.randrange(1, 50), s * rng.uniform(0.01, 0.99)) for i in range(rng.randrange(1, 40))]
        rows.append((g, items, math.fsum(x[4] for x in items)))
    df = spark.createDataFrame(rows, f"g long, items array<{item}>, mass double")
    for r in df.select("g", "items", "mass", mixing._fold(F.col("items"), item, 3).alias("f")).collect():
        out = [*r["f"]["open"], *r["f"]["done"]]
        assert len(r["f"]["open"]) <= 1 and sorted(x["id"] for x in out) == sorted(x["id"] for x in r["items"])
        assert math.fsum(x["mass"] for x in out) == pytest.approx(r["mass"])
        assert all(x["mass"] in (0.0, x["size"]) for x in r["f"]["done"])


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix_sources(blank).collect()] == [(0.0, 0), (0.0, 0)]
    plan = mixing.mix_sources(blank)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- centroids ----------------------------------------------------------------------

def plain_nearest(v, centroids):
    d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
    return min(range(len(d)), key=lambda i: (d[i], i)), min(d)


@pytest.mark.parametrize("scale", [3, 60, 1 << 20, 1 << 40])
def test_nearest(scale):
    rng = np.random.default_rng(5)
    v, c = rng.integers(-scale, scale, (300, 64)), rng.integers(-scale, scale, (16, 64))
    v[:40], c[9], c[14] = c[rng.integers(0, 16, 40)], c[2], c[2]
    c[7], c[11], v[50] = 0, 0, 0
    best, d = centroids.nearest(v, c)
    assert [(int(a), int(b)) for a, b in zip(best, d)] == [plain_nearest(x, c.tolist()) for x in v.tolist()]


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, distance long, v int, dim int"


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e, *_ in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    cs = [v for i, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[plain_nearest(v, cs)[0]].append(v)
        cs = [[sum(x) // len(of[i]) for x in zip(*of[i])] if of[i] else c for i, c in enumerate(cs)]
    out = [(i, *plain_nearest(v, cs)) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in out)


@pytest.mark.parametrize("n", [1, 5, 400])
def test_clusters(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, (rng.normal(i % 5, 0.3, 64)).astype(np.float32).tolist(), 1, 1, 1, 1, 1) for i in range(n)]
    bad = rows[0][1]
    rows += [rows[-1], rows[-1], (None, bad, 1, 1, 1, 1, 1), (900, None, 1, 1, 1, 1, 1), (901, bad[:63], 1, 1, 1, 1, 1), (902, [*bad[:63], None], 1, 1, 1, 1, 1), (903, [*bad[:63], float("nan")], 1, 1, 1, 1, 1),
             (904, [float("-inf"), *bad[1:]], 1, 1, 1, 1, 1), (905, [*bad, 0.0], 1, 1, 1, 1, 1), (906, [], 1, 1, 1, 1, 1)]
    got = centroids.cluster_vectors(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    assert sorted((str(r["vec_id"]), *r[1:]) for r in got) == plain_clusters(rows)


def test_huge_components_and_no_vectors(spark):
    huge = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [1.0] * 64)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in centroids.cluster_vectors(huge, k=1).collect()}
    assert len(got) == 3 and got[1]["distance"] == (1 << 63) - 1 and got[3]["inertia"] == (1 << 63) - 1
    none = centroids.cluster_vectors(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# ---- ranked search ------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain_rank(docs, items, top=50):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, all_terms = sum(1 for _, c in held if c), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    of = defaultdict(set)
    for i, t in items:
        of[i] |= set(terms(t))
    out = []
    for item, wanted in of.items():
        scores = []
        for doc, c in held:
            m = 50 + 50 * c.total() * n_docs // all_terms if all_terms else 0
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            scores.append((-sum(w(t) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t]), doc is not None, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:top])]
    return sorted(out, key=str)


DOC = "doc_id long, text string, rank int, score long, item_id long, term string, block int, salt int"


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_rank(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ranked, "_BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(ranked, "_HELD", 30)
    rng = random.Random(6)
    words = ["a", "ab", "b", "B", "Ab", "é", "É", "日本", "x1", "1", "zz", "\u0085", "ſ"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "-", "\n", "_", "\x00", "\x7f", ".", "\t\t"]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 30))) for i in range(260)] + [(900, None), (901, ""), (902, " -_ "), (903, "zz " * 5000), (None, "zz"), (7, "zz x1"), (7, "zz x1")]
    items = [(1, "zz"), (2, text(8)), (3, None), (4, "--"), (2, "日本 again"), (5, "nowhere"), (6, text(40)), (None, "x1 X1 x1")]
    d = spark.createDataFrame([(*r, 1, 1, 1, "t", 1, 1) for r in docs], DOC).repartition(6)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = ranked.rank_documents(d, i).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_rank(docs, items)
    assert any(r["rank"] == 50 for r in got)


def test_rank_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.rank_documents(docs.limit(0), items).count() == 0
    assert ranked.rank_documents(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in ranked.rank_documents(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


def test_guarded_terms():
    assert ranked.guarded("A-é_b\x00É") == " a é b É ".encode()
    assert [ranked.number_of_terms(ranked.guarded(t)) for t in (None, "", "--", "a", " a b", "a" * 10**6 + " é")] == [0, 0, 0, 1, 2, 2]
