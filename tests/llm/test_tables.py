"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, columns of the same name."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from catalogflow.llm import attribution, components, decontaminate, licences, near, packing, pii, quality, toxicity, warc
from catalogflow.llm.queries import ORACLES, QUERIES
from catalogflow.llm.tokens import Encoder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, component string, node int, n int, words string, bits string, label int"


def words(rng, n):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(n))


def changed(rng, text, k):
    w = text.split()
    for i in rng.sample(range(len(w)), k):
        w[i] = "new" + str(rng.randrange(10**6))
    return " ".join(w)


def corpus():
    """Clusters around the bound of similarity, copies, texts of few words, a passage that all share."""
    rng, rows = random.Random(5), []
    passage = words(rng, 60)
    for c in range(6):
        base = words(rng, rng.randrange(60, 140))
        rows += [changed(rng, base, rng.randrange(0, 5)) for _ in range(14)] + [base.upper(), base.replace(" ", "\n")]
    rows += [passage + " " + words(rng, 150) for _ in range(30)]
    rows += ["one two three four", "ONE two  three four", "one two three", "x", None, "", " \n ", words(rng, 20_000)]
    out = [(i, t, "en", "s", len(t or ""), "h", "c", 1, 2, "w", "b", 0) for i, t in enumerate(rows)]
    return out + [out[3], out[3], (None, rows[3], None, None, None, "h", "c", 1, 2, "w", "b", 0), (None, "lonely text of a null id here", None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def sets_of(rows):
    out = {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        key = (-1 if r[0] is None else r[0], r[1])
        out[key] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def plain_components(rows):
    sets = sets_of(rows)
    keys, parent = list(sets), {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)), key=lambda k: k[0])
                parent[y] = x
    return {k: (len(sets[k]), root(k)[0]) for k in keys}


def test_near_against_all_pairs(spark, docs):
    rows = corpus()
    want = plain_components(rows)
    got = near.link_near(docs).collect()
    assert len(got) == len(rows)
    expected = sorted((-1 if r[0] is None else r[0], *want[(-1 if r[0] is None else r[0], r[1])]) for r in rows)
    assert sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in got) == expected
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(-1 if i is None else i for i in ids) == sorted(i for i, _, c in expected if i == c)


def test_near_in_a_large_cluster(spark):
    rng = random.Random(6)
    base = words(rng, 90)
    rows = [(i, changed(rng, base, rng.randrange(0, 7))) for i in range(260)]
    want = plain_components(rows)
    got = near.link_near(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {k[0]: v for k, v in want.items()}
    assert len({v[1] for v in want.values()}) > 3


def test_near_of_equal_prefix(spark, monkeypatch):
    """Near copies of equal size that differ behind the prefix, where no other set shares a shingle with them."""
    monkeypatch.setattr(near, "_COUNTERS", 16)
    rng, rows = random.Random(12), []
    for i in range(40):
        base = words(rng, rng.randrange(40, 120)).split()
        for k in range(rng.choice([2, 2, 3, 6])):
            rows.append((len(rows), " ".join([*base[:-1], f"last{i}x{k}"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    groups = near.document_sets(df, "doc_id", "text").groupBy("group").agg(F.countDistinct("set").alias("k")).where("k > 1").count()
    assert groups > 20
    want = plain_components(rows)
    assert {r[0]: (r[1], r[2]) for r in near.link_near(df).collect()} == {k[0]: v for k, v in want.items()}


def test_filters_lose_no_pair():
    rng = np.random.default_rng(7)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        drop = int(rng.integers(0, n // 4 + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 4 * both >= 3 * (len(a) + len(b) - both):
            assert near._parity_bound(near._parity(a), near._parity(b))
            order = lambda s: np.sort(s)
            assert set(order(a)[: near._prefix_size(len(a))].tolist()) & set(order(b)[: near._prefix_size(len(b))].tolist())


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 3), *((i, i + 1) for i in range(20, 60)), (59, 20)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 61)}}


def test_decontamination(spark, docs):
    rng = random.Random(8)
    item = words(rng, 40)
    near_item = changed(rng, item, 1)
    far_item = changed(rng, item, 4)
    items = spark.createDataFrame([(1, item), (2, "too short here"), (None, words(rng, 12)), (4, None), (5, ""), (1, item)], "item_id bigint, text string")
    texts = [f"{words(rng, 3000)} {item.upper()}, {words(rng, 30)}", f"x {near_item} y", f"x {far_item} y", "too short here", item, None, ""]
    rows = spark.createDataFrame([(i, t, "i") for i, t in enumerate(texts)] + [(4, item, "i")], "doc_id bigint, text string, item_id string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shingles"], r["n_found"]) for r in decontaminate.find_items(rows, items).collect()}
    assert got == {(0, 1): (36, 36), (1, 1): (36, 31), (4, 1): (36, 36)}
    assert sorted(r["doc_id"] for r in decontaminate.without_items(rows, items).collect()) == [2, 3, 5, 6]
    index = decontaminate.index_items(items).where("item_id = 1")
    assert index.count() == 36 and index.where("in_sketch").count() == 16
    assert decontaminate.find_items(rows.limit(0), items).isEmpty() and decontaminate.find_items(rows, items.limit(0)).isEmpty()


def test_packing_round_trip(spark, docs):
    own = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    placed = packing.pack_documents(own, size=64).cache()
    encode = Encoder()
    want = {r["doc_id"]: np.frombuffer(encode.ids(r["text"] or ""), "<u4").tolist() + [0] for r in own.collect()}
    pieces, fill = defaultdict(list), defaultdict(list)
    for r in placed.collect():
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"] and len(ids) == r["length"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, ids in want.items():
        got = sorted(pieces[doc])
        assert [p for p, _, _ in got] == list(range(len(got))) and sum(n for _, _, n in got) == len(ids)
        assert all(n == 64 for _, _, n in got[1:]) and (len(ids) > 64) == (len(got) > 1)
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    whole = {r["sequence_id"]: r["ids"] for r in packing.packed_ids(own, placed).collect()}
    assert {k: len(v) for k, v in whole.items()} == {k: sum(n for _, n in v) for k, v in fill.items()}
    total = sum(map(len, want.values()))
    assert len(fill) <= 1.1 * total / 64 + 2


def test_sections_add_up(spark, docs):
    got = attribution.section_tokens(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.max("end").alias("e"), F.count("*").alias("k")).where("doc_id is not null").collect()
    encode = Encoder()
    rows = defaultdict(list)
    for r in corpus():
        rows[r[0]].append(r[1] or "")
    assert {r["doc_id"]: (r["t"], r["e"]) for r in got} == {d: (sum(len(encode.ids(t)) // 4 for t in ts), max(map(len, ts))) for d, ts in rows.items() if d is not None}


def test_warc_round_trip(spark):
    big = "é" * 400_000
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u\r\n4", ""), (5, "u5", big), (6, "u6", "WARC/1.1\r\n\r\nx\r\n\r\n"), (None, "u", "alone"), (7, "u7", "same"), (7, "u7", "same"), (8, "u8", big)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, digest string, refers_to string").repartition(3)
    from catalogflow.llm.common import folder

    files = warc.write_archives(pages, folder(spark, "warc"))
    assert sum(r["records"] for r in files.collect()) == len(rows)
    chunks = warc.read_chunks(files).collect()
    assert max(len(r["data"]) for r in chunks) <= warc.CHUNK and max(r["chunk"] for r in chunks) == 3
    body = defaultdict(bytes)
    for r in sorted((r for r in chunks if r["record_type"] == "response"), key=lambda r: r["chunk"]):
        body[r["record_id"]] += r["data"] if r["record_id"] != "7" or not body["7"] else b""
    assert body == {"3": b"", "4": b"", "5": b"", "6": rows[5][2].encode(), "7": b"same", "8": big.encode(), None: b"alone"} or body == {k: v for k, v in {"4": b"", "6": rows[5][2].encode(), "7": b"same", "8": big.encode(), None: b"alone"}.items()}
    last = {(r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["digest_so_far"]) for r in warc.round_trip(pages).collect()}
    import base64

    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    refers = {1: "7", 2: "7", 3: "4", 5: "8"}
    assert last == {(str(i) if i else None, "revisit" if i in refers else "response", refers.get(i), len((t or "").encode()), digest(t)) for i, _, t in rows}
    assert warc.round_trip(pages.limit(0)).isEmpty()


def labelled(rng, n, ids):
    """Clean and toxic texts in two languages; toxic ones have a word with a toxic stem."""
    rows, labels = [], []
    stems = {"the and of": ["idiotic", "morons"], "der die und": ["loweichen", "loweient", "loweiung", "loweikeit"]}
    for i in range(n):
        common = rng.choice(list(stems))
        w = [rng.choice([*common.split(), words(rng, 1)]) for _ in range(rng.randrange(5, 120))]
        y = int(rng.random() < 0.3)
        if y:
            w[rng.randrange(len(w))] = rng.choice(stems[common])
        rows.append((ids + i, " ".join(w)))
        labels.append((ids + i, y))
    return rows, labels


def test_toxicity(spark):
    rng = random.Random(9)
    rows, labels = labelled(rng, 900, 0)
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(10**6, None, 1), (10**6 + 1, "", 1), (None, "the idiotic", 1)], "doc_id bigint, text string, toxic int")
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, known)
    got = {r[0]: r[1] for r in docs.select("doc_id", toxicity.toxicity_score(model, "text")).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.97
    assert all(0 <= s <= 1 for s in got.values()) and got[10**6] == got[10**6 + 1] < 0.5 <= got[None]
    # rows of fold 0 teach nothing
    turned = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels], "doc_id bigint, toxic int")
    other = toxicity.train(docs, turned)
    assert np.array_equal(model.table, other.table) and model.thresholds == other.thresholds
    none = toxicity.train(docs, known.limit(0))
    assert docs.limit(0).select(toxicity.toxicity_score(none, "text")).isEmpty()
    assert docs.where(toxicity.toxicity_score(none, "text") >= 0.5).isEmpty()


def test_quality(spark, nothing):
    rng = random.Random(10)
    good = [(i, "\n".join(" ".join(rng.choice("abcdefgh") * rng.randrange(2, 9) + str(rng.randrange(99)) for _ in range(rng.randrange(8, 15))) for _ in range(rng.randrange(8, 30)))) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "###" for w in good[i][1].split())) for i in range(20)]
    base = [(2000, "short"), (2001, None), (2002, "a b c " * 60), (None, good[0][1])]
    df = spark.createDataFrame([(d, t, "en" if (d or 0) % 2 else None, "src0", 1.0) for d, t in good + junk + base], "doc_id bigint, text string, lang string, source string, mean double")
    got = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert len(got) == len(good) + len(junk) + len(base)
    assert not any(got[d]["kept"] for d, _ in junk) and all(got[d]["base_failed"] and not got[d]["kept"] for d in (2000, 2001, 2002))
    assert sum(got[d]["kept"] for d, _ in good) >= 0.98 * len(good)
    assert quality.judge(nothing).isEmpty()
    assert quality.judge(df.limit(5)).count() == 5  # too few for an estimate


def test_licences_without_usual_words(spark):
    """No line is passed over for the words it lacks."""
    lines = ["No part of this publication may be reproduced or transmitted in any form.", "You may obtain a copy at http://www.apache.org/licenses/LICENSE-2.0",
             "This is free and unencumbered software released into the world.", "He went home by the river.", "", "this and this is by software and this"]
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    got = {r["line"]: r["family"] for r in licences.licence_lines(df).collect()}
    assert got[0] == "proprietary" and got[2] == "public-domain" and not {3, 4} & set(got)


def test_licences(spark):
    lines = [(i, "text before\n" + n + "\nafter") for i, (_, n) in enumerate((f, n) for f, ns in licences.NOTICES.items() for n in ns)]
    families = [f for f, ns in licences.NOTICES.items() for _ in ns]
    rows = lines + [(1000 + i, t) for i, t in enumerate(licences.OTHERS)] + [(2000, None), (2001, ""), (2002, "She renewed her driving licence yesterday."), (2003, "Der Text hat copyright und sonst nichts.")]
    df = spark.createDataFrame([(*r, "m") for r in rows], "doc_id bigint, text string, m string")
    got = {r["doc_id"]: r for r in licences.licence_lines(df).collect()}
    assert not [d for d in got if d >= 1000]
    right = [got[i]["family"] == f and got[i]["line"] == 1 and got[i]["confirmed"] for i, f in enumerate(families) if i in got]
    assert all(right) and len(right) >= 0.9 * len(families)
    assert licences.licence_lines(df.limit(0)).isEmpty()


def test_pii_columns(spark, docs, nothing):
    df = spark.createDataFrame([(1, "a x@y.zz b", 10, "k"), (2, None, None, "k"), (3, "", 0, "k")], "doc_id bigint, text string, n_chars int, spans string")
    out = pii.redact_pii(df)
    assert out.dtypes == df.dtypes and [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "a <EMAIL> b", 11, "k"), (2, None, None, "k"), (3, "", 0, "k")]
    assert pii.redact_pii(nothing).isEmpty() and packing.pack_documents(nothing).isEmpty() and attribution.section_tokens(nothing).isEmpty()
    assert near.link_near(nothing).isEmpty()


def test_pipeline_stages(spark, sf):
    """Each stage on what its predecessor kept, with the columns of the documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == docs.columns
        if name == "ngram_jaccard":
            want = plain_components([(r["doc_id"], r["text"]) for r in rows.collect()])
            assert {r["doc_id"] for r in out.collect()} == {k[0] for k, v in want.items() if v[1] == k[0]}
        rows = spark.createDataFrame(out.collect(), docs.schema)
        sizes.append(rows.count())
    assert sizes[0] >= sizes[1] > sizes[2] > 0 and sizes[3] == sizes[4]
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_queries_with_sql(spark, sf, name):
    from types import SimpleNamespace

    from tests.oracle import compare, connect

    ok, message, _ = compare(spark, connect(sf), SimpleNamespace(run=QUERIES[name], sql=ORACLES[name]), sf)
    assert ok, message
