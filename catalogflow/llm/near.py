"""Near-duplicate documents (grouped prefix join on five-word shingles).

A document is the set of its shingles. All sets share one order of shingles, rare ones first, and two
sets that are similar enough must share a shingle among the first of each (the prefix). Documents with equal
sets form a class, classes with equal prefix and size a group, and the index holds each group once:

1. A count sketch of fixed size over all documents gives the order.
2. The prefixes are dealt out by shingle. Those that one set alone has are told apart by a bit
   array of fixed size and dropped. Different sets of one group share their whole prefix.
3. Of the groups that share a shingle, first only one is compared with all others; this joins most
   of a large set of near copies without forming its pairs.
4. The rest is exact: pairs of groups that share a shingle and hold classes not yet joined pass the filters of size
   and position as groups, are expanded to their classes, and every pair is checked by parity bits and on the whole sets.

Shingles are compared by hashes of 64 bits.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.common import by_batch, stored
from catalogflow.llm.components import components

WORDS = 5
SHARE = (3, 4)  # least Jaccard similarity, as a fraction
_COUNTERS = 1 << 19  # of the count sketch
_BLOCK = 1 << 12  # counters, or bytes of a bit array, in a row while they are added up
_MOST_BITS = 1 << 30
_NO_ID = -(1 << 63)  # stands for a null id
_FEW_ROWS = 1 << 21  # hashes of rows, 16 MB, up to which they are broadcast

_SETS = "doc_id bigint, n int, set binary, key bigint, row bigint, bits binary, group bigint, prefix array<bigint>"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("set", pa.binary()), ("key", pa.int64()), ("row", pa.int64()), ("bits", pa.binary()), ("group", pa.int64()), ("prefix", pa.list_(pa.int64()))])
_BLOCKS = "block int, data binary"
_BLOCKS_ARROW = pa.schema([("block", pa.int32()), ("data", pa.binary())])


_STEP = 0x9E3779B97F4A7C15  # base of the polynomial over the bytes of a word, odd and so with an inverse
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    of = lambda x: np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)]), dtype=np.uint64)
    return of(np.uint64(_STEP)), of(np.uint64(pow(_STEP, -1, 1 << 64)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes. Fewer than five words make one shingle, no words none.

    The hash of a word is that of the bytes between its ends, by differences of running sums over the
    text, so no word becomes a Python object.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)  # bytes: only A-Z
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _WHITE[raw], [True]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    forth, back = _powers(1 << max(12, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * forth[: len(raw)], out=sums[1:])
    h = _mixed((sums[ends] - sums[starts]) * back[starts])
    size = min(WORDS, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(_STEP) + h[k : len(h) - size + 1 + k]
    return np.unique(_mixed(out))


def _summed(blocks: DataFrame, *kind: str) -> dict[int, np.ndarray]:
    """Blocks of one number added up (bits: or-ed), of the first kind to the second; the result has a fixed size, so it may go to the driver."""

    def add(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, total = None, None
        for block, data in rows:
            part = np.frombuffer(zlib.decompress(data), kind[0])
            if block != now:
                if now is not None:
                    yield now, zlib.compress(total.tobytes(), 1)
                now, total = block, part.astype(kind[1])
            else:
                total = total | part if kind[1] == "u1" else total + part
        if now is not None:
            yield now, zlib.compress(total.tobytes(), 1)

    dealt = blocks.repartition(16, "block").sortWithinPartitions("block")
    found = by_batch(dealt, _BLOCKS, _BLOCKS_ARROW, add).collect()
    return {r["block"]: np.frombuffer(zlib.decompress(r["data"]), kind[1]) for r in found}


def shingle_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Count sketch: of the distinct shingles of every document, how many fall to each counter."""

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        counters = np.zeros(_COUNTERS, np.uint32)
        for (words,) in rows:
            np.add.at(counters, (shingles(words) & np.uint64(_COUNTERS - 1)).astype(np.int64), np.uint32(1))
        for block in range(-(-_COUNTERS // _BLOCK)):
            part = counters[block * _BLOCK : (block + 1) * _BLOCK]
            if part.any():
                yield block, zlib.compress(part.tobytes(), 1)

    total = np.zeros(_COUNTERS, np.uint64)
    for block, part in _summed(by_batch(docs.select(text), _BLOCKS, _BLOCKS_ARROW, count), "u4", "u8").items():
        total[block * _BLOCK : (block + 1) * _BLOCK] = part
    return total


def _prefix_size(n: int) -> int:
    """A set of ``n`` must share one of this many first shingles with every smaller or equal set that is similar."""
    return n - -(-SHARE[0] * n // SHARE[1]) + 1


def _index_size(n: Column) -> Column:
    """As many first shingles suffice for a set met by sets of its own size or larger."""
    return n - F.ceil(F.lit(2 * SHARE[0]) * n / (SHARE[0] + SHARE[1])) + 1


def _long(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _key(doc: int, digest: bytes) -> int:
    """Names a text of a document; rows that repeat an id with another text have another key."""
    return _long(doc.to_bytes(8, "little", signed=True) + digest)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, text, row): the rows with a hash of id and text, by which a row can be found again without its shingles."""
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text).alias("text"))
    return keyed.withColumn("row", F.xxhash64("id", "text"))


def document_sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: the size of its set, digests of the set, of id and set, of the row and of the prefix, the set's parity bits, and the prefix."""
    counts = shingle_counts(docs, text)

    def sets(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, words, row in rows:
            h = shingles(words)
            n = len(h)
            first = h[np.lexsort((h, counts[(h & np.uint64(_COUNTERS - 1)).astype(np.int64)]))[: _prefix_size(n) if n else 0]]
            digest = _digest(h)
            yield doc, n, digest, _key(doc, digest), row, _parity(h), _long(n.to_bytes(8, "little") + first.tobytes()), first.view(np.int64)

    return stored(by_batch(_keyed(docs, doc_id, text), _SETS, _SETS_ARROW, sets), "sets")


def _bit_array(rows: DataFrame, key) -> np.ndarray:
    """Bits of the keys of ``rows``, at least sixteen to a row up to a fixed size, so it may go to the driver and the tasks."""
    size = 1 << 18
    while size < min(16 * rows.count(), _MOST_BITS):
        size *= 2

    def fill(incoming: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, np.ndarray] = {}
        for row in incoming:
            at = key(*row) & (size - 1)
            block = held.get(at >> 15)
            if block is None:
                block = held[at >> 15] = np.zeros(_BLOCK, np.uint8)
            block[(at >> 3) & (_BLOCK - 1)] |= 1 << (at & 7)
        for block, data in held.items():
            yield block, zlib.compress(data.tobytes(), 1)

    total = np.zeros(size // 8, np.uint8)
    for block, part in _summed(by_batch(rows, _BLOCKS, _BLOCKS_ARROW, fill), "u1", "u1").items():
        total[block * _BLOCK : (block + 1) * _BLOCK] = part
    return total


def _index(sets: DataFrame) -> DataFrame:
    """(h, group, n, at): the prefix shingles that several different sets have, with their place in each group."""
    marked = sets.where("n > 0").select("group", "n", "prefix", F.xxhash64("set").alias("mark"))
    spread = marked.select("mark", F.explode("prefix").alias("h"))
    shared = stored(spread.groupBy("h").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where("low < high").select("h"), "shared")
    bits = _bit_array(shared, lambda h: h)
    size = 8 * len(bits)

    def keep(rows: Iterator[tuple]) -> Iterator[tuple]:
        for group, n, prefix, mark in rows:
            slot = np.array(prefix, np.int64) & (size - 1)
            for at in np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).tolist():
                yield prefix[at], group, n, at, mark

    arrow = pa.schema([("h", pa.int64()), ("group", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("mark", pa.int64())])
    found = by_batch(marked, "h bigint, group bigint, n int, at int, mark bigint", arrow, keep)
    entries = stored(found.groupBy("h", "group").agg(F.min("n").alias("n"), F.min("at").alias("at"), F.min("mark").alias("low"), F.max("mark").alias("high")), "entries")
    # the bit array lets a few through that one set alone has
    several = entries.groupBy("h").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("h")
    return stored(entries.drop("low", "high").join(several, "h"), "entries")


def _may_link(a: str, b: str) -> Column:
    """Filters of size and position: enough shingles can follow the shared one in both sets."""
    n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
    least = SHARE[0] * (n + m)  # (SHARE[0] + SHARE[1]) times the overlap that is needed
    rest = F.least(n - F.col(f"{a}_at"), m - F.col(f"{b}_at"))
    indexed = lambda x, at: F.col(at) < _index_size(x)
    order = F.when(n < m, indexed(n, f"{a}_at")).when(m < n, indexed(m, f"{b}_at")).otherwise(indexed(n, f"{a}_at") | indexed(m, f"{b}_at"))
    return (SHARE[1] * F.least(n, m) >= SHARE[0] * F.greatest(n, m)) & ((SHARE[0] + SHARE[1]) * rest >= least) & order


def _side(entries: DataFrame, name: str) -> DataFrame:
    return entries.select(*[F.col(c).alias(c if c == "h" else f"{name}_{c}") for c in entries.columns])


class _Verifier:
    """Checks pairs of classes, by their parity bits and then on their whole sets.

    The whole sets of the classes that pass the first test are worked out again from the texts of their rows, which are few and
    found by a semi-join on the hash of the row, so texts of others do not go through Python. Up to ``_FEW_ROWS`` wanted hashes are
    broadcast, so texts are not shuffled; beyond, Spark chooses the join.
    """

    def __init__(self, docs: DataFrame, classes: DataFrame, doc_id: str, text: str):
        self._docs = _keyed(docs, doc_id, text)
        self._rows = classes.select("class", "row")
        self._bits = classes.select("class", F.col("bits").alias("data"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar."""
        near = stored(_with_data(pairs, self._bits).where(_parity_passes("a_data", "b_data")).select("a", "b"), "near")
        if near.isEmpty():
            return near
        ends = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = stored(ends.join(self._rows, "class").select("row").distinct(), "wanted")

        def sets(rows: Iterator[tuple]) -> Iterator[tuple]:
            for id_, words in rows:
                h = shingles(words)
                yield _key(id_, _digest(h)), h.view(np.int64)

        arrow = pa.schema([("class", pa.int64()), ("data", pa.list_(pa.int64()))])
        few = F.broadcast(wanted) if wanted.count() <= _FEW_ROWS else wanted
        texts = self._docs.join(few, "row", "left_semi").select("id", "text")
        whole = stored(by_batch(texts, "class bigint, data array<bigint>", arrow, sets), "whole").dropDuplicates(["class"])
        both = F.size(F.array_intersect("a_data", "b_data"))
        similar = SHARE[1] * both >= SHARE[0] * (F.size("a_data") + F.size("b_data") - both)
        return stored(_with_data(near, whole).where(similar).select("a", "b").distinct(), "similar")


def _with_data(pairs: DataFrame, of: DataFrame) -> DataFrame:
    for end in ("b", "a"):
        pairs = pairs.join(of.select(F.col("class").alias(end), F.col("data").alias(f"{end}_data")), end)
    return pairs


def _parity(h: np.ndarray) -> bytes:
    """Bits that tell whether an odd number of the set's shingles falls to them; the size of the set stands before them."""
    size = max(64, 1 << int(4 * len(h) - 1).bit_length())
    counts = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return len(h).to_bytes(8, "little") + np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _parity_bound(x: bytes, y: bytes) -> bool:
    """False only if the sets differ in too many shingles: each odd bit between them needs one."""
    n, m = int.from_bytes(x[:8], "little"), int.from_bytes(y[:8], "little")
    a, b = np.frombuffer(x, np.uint8, offset=8), np.frombuffer(y, np.uint8, offset=8)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):  # fold the longer one
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    differ = int(np.bitwise_count(a ^ b).sum())
    return (SHARE[0] + SHARE[1]) * (n + m - differ) >= 2 * SHARE[0] * (n + m)


@F.arrow_udf(T.BooleanType())
def _parity_passes(x: pa.Array, y: pa.Array) -> pa.Array:
    return pa.array([_parity_bound(a, b) for a, b in zip(x.to_pylist(), y.to_pylist())], pa.bool_())


def _members(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(set, n, group, class, doc, row, bits): the classes, each named by the key of its smallest document; and (group, first): a class of each group."""
    of = sets.where("n > 0").groupBy("set")
    least = F.min_by(F.struct("key", "row"), F.struct("doc_id", "row")).alias("least")
    classes = stored(of.agg(least, F.min("doc_id").alias("doc"), F.min("n").alias("n"), F.min("group").alias("group"), F.first("bits").alias("bits")).select("set", "n", "group", F.col("least.key").alias("class"), "doc", F.col("least.row").alias("row"), "bits"), "classes")
    return classes, classes.groupBy("group").agg(F.min("class").alias("first"))


def _star(entries: DataFrame, key: str, by: Column) -> DataFrame:
    """For each shingle, its entry with the least ``by`` with each of the others that it may link."""
    hub = entries.groupBy("h").agg(F.min_by(F.struct(key, "n", "at"), by).alias("hub"))
    hubs = hub.select("h", F.col(f"hub.{key}").alias(f"a_{key}"), F.col("hub.n").alias("a_n"), F.col("hub.at").alias("a_at"))
    met = _side(entries, "b").join(hubs, "h").where((F.col(f"a_{key}") != F.col(f"b_{key}")) & _may_link("a", "b"))
    return met.select(F.least(f"a_{key}", f"b_{key}").alias("a"), F.greatest(f"a_{key}", f"b_{key}").alias("b")).distinct()


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with ``component``, of those that are linked and of the others."""
    joined = components(links)
    linked = classes.drop("bits", "row").join(joined.withColumnRenamed("node", "class"), "class", "left")
    return stored(linked.withColumn("component", F.coalesce("component", "class")), "labels")


def _apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries by class, of the shingles whose classes are not all joined."""
    by_class = entries.drop("n").join(labels.select("group", "class", "n", "component"), "group").drop("group")
    split = by_class.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    return stored(by_class.join(split, "h"), "apart")


def _all_pairs(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Every pair of classes in different components whose groups share a shingle and pass the filters.

    Groups are paired, and only pairs that pass are expanded to their classes. Of each shingle the component that most
    groups belong to as a whole is the rest; only groups with a class outside it look for partners, so the pairs inside a large
    component are not even visited.
    """
    of_group = labels.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    marked = entries.join(of_group, "group")
    split = marked.groupBy("h").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("h")
    apart = stored(marked.join(split, "h"), "apart")
    sizes = apart.where("low = high").groupBy("h", F.col("low").alias("component")).agg(F.count(F.lit(1)).alias("k"))
    rest = sizes.groupBy("h").agg(F.max_by("component", F.struct("k", "component")).alias("rest"))
    rows = apart.join(rest, "h", "left").withColumn("outside", ~((F.col("low") == F.col("high")) & F.col("low").eqNullSafe(F.col("rest")))).drop("rest")
    seek, all_ = _side(rows.where("outside").drop("outside"), "a"), _side(rows, "b")
    once = ~F.col("b_outside") | (F.col("a_group") <= F.col("b_group"))
    differ = F.least("a_low", "b_low") < F.greatest("a_high", "b_high")
    met = seek.join(all_, "h").where(differ & once & _may_link("a", "b")).select("a_group", "b_group").distinct()
    groups = stored(met, "groups")
    of = labels.select("group", "class", "component")
    side = lambda name: of.select(*[F.col(c).alias(f"{name}_{c}") for c in of.columns])
    pairs = groups.join(side("a"), "a_group").join(side("b"), "b_group").where("a_component <> b_component")
    return pairs.select(F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b")).distinct()


def link_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Two documents link when their sets have a Jaccard similarity of at least 3/4; ``component_id`` is
    the smallest id that links reach. Null and empty texts have no shingles and link with nothing. Repeated rows
    are copies of one another. A null id is smaller than any other and stays null.
    """
    sets = document_sets(docs, doc_id, text)
    classes, firsts = _members(sets)
    entries = _index(sets)
    verify = _Verifier(docs, classes, doc_id, text)
    named = firsts.select(F.col("group").alias("a"), F.col("first").alias("x"))
    hubs = _star(entries, "group", F.col("group"))
    pairs = hubs.join(named, "a").join(named.select(F.col("a").alias("b"), F.col("x").alias("y")), "b")
    links = verify.links(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    labels = _labelled(classes, links)
    for by in (F.struct(F.col("n") * -1, "class"), F.struct("at", F.xxhash64("class"))):
        apart = _apart(entries, labels)
        component = F.col("component").alias("c")
        tried = _star(apart, "class", by)
        own = labels.select(F.col("class").alias("_c"), component)
        fresh = tried.join(own.toDF("a", "ca"), "a").join(own.toDF("b", "cb"), "b").where("ca <> cb").select("a", "b")
        links = links.unionByName(verify.links(fresh))
        labels = _labelled(classes, links)
    links = links.unionByName(verify.links(_all_pairs(entries, labels)))
    labels = _labelled(classes, links)
    smallest = labels.groupBy("component").agg(F.min("doc").alias("least"))
    named = stored(labels.join(smallest, "component").select("set", "least"), "labels")
    found = sets.select("doc_id", "n", "set").join(named, "set", "left")
    real = lambda c: F.when(c != _NO_ID, c)
    return found.select(real(F.col("doc_id")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), real(F.coalesce("least", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id names their component: one document of each group of near copies.

    Documents without words stay. Of repeated rows with the id that stays, all stay.
    """
    found = link_near(docs, doc_id, text)
    dropped = stored(found.where("NOT doc_id <=> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(dropped, docs[doc_id].eqNullSafe(dropped["_gone"]), "left_anti")
