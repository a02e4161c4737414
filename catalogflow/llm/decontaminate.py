"""Test items inside documents (size-partitioned MinHash containment search, exact verification).

Items are split into classes by their number of distinct five-word shingles. An item keeps a bottom
sketch: the shingles with the smallest hashes, as many as its class needs for one of them to be in every
text that holds the wanted share of the item. A document is a candidate if any of its shingles is in
a sketch. For candidates all shingles that any item has are compared as text, and a pair is
reported if the share of the item's shingles found is large enough, so hashing loses and adds nothing.

Only functions of Spark SQL are used. Sketches and shingles are tested against bit arrays of a fixed
size where the rows are, so no document text and hardly a foreign shingle is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import stored

WORDS = 5
_SLOTS = 1 << 14  # numbers of 64 bits in a bit array


def _words(text: str) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for each row."""
    return F.transform(F.array(value), body)[0]


def _hashes(words: Column) -> Column:
    """Hash of each shingle, by its place; none with fewer than five words."""
    places = F.sequence(F.lit(0), F.size(words) - WORDS)
    each = lambda hashed: F.transform(places, lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WORDS)]))
    return F.when(F.size(words) >= WORDS, _let(F.transform(words, lambda w: F.xxhash64(w)), each)).otherwise(F.array().cast("array<bigint>"))


def _shingle(words: Column, place: Column) -> Column:
    return F.array_join(F.slice(words, place + 1, WORDS), " ")


def _slot(h: Column) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(_SLOTS - 1)).cast("int")


def _in_bits(bits: Column, h: Column) -> Column:
    return F.call_function("getbit", F.get(bits, _slot(h)), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _bit_array(hashes: DataFrame) -> Column:
    """A bit array of the column ``h``, as a subquery of one row; its size does not depend on the data."""
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    held = hashes.groupBy(_slot(F.col("h")).alias("slot")).agg(F.bit_or(one).alias("bits"))
    dense = hashes.sparkSession.range(_SLOTS).select(F.col("id").cast("int").alias("slot")).join(held, "slot", "left").select("slot", F.coalesce("bits", F.lit(0)).alias("bits"))
    return dense.agg(F.array_sort(F.collect_list(F.struct("slot", "bits"))).alias("all")).select(F.col("all")["bits"]).scalar()


def index_items(items: DataFrame, item_id: str = "item_id", text: str = "text", share: float = 0.75) -> DataFrame:
    """(item_id, n_shingles, size_class, shingle, h, in_sketch): a row per distinct shingle of each item.

    The class of an item is the power of two at or below its number of shingles. A text may lack
    up to ``1 - share`` of them, so a sketch has one more than that part of the largest size in its class.
    Items of fewer than five words have no shingles and are found nowhere.
    """
    texts = items.select(F.col(item_id).alias("item_id"), _words(text).alias("words"))
    placed = texts.select("item_id", "words", F.posexplode(_hashes(F.col("words"))).alias("place", "h"))
    shingles = placed.select("item_id", "h", _shingle(F.col("words"), F.col("place")).alias("shingle")).distinct()
    sized = stored(shingles, "shingles")
    sizes = sized.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"), F.array_sort(F.collect_list("h")).alias("sorted"))
    size_class = F.pow(F.lit(2), F.floor(F.log2("n_shingles"))).cast("bigint")
    lacking = F.floor((F.lit(1) - F.lit(share)) * (2 * F.col("size_class") - 1)).cast("int")
    bounds = sizes.withColumn("size_class", size_class).select(F.col("item_id").alias("_item"), "n_shingles", "size_class", F.get("sorted", F.least(lacking, F.col("n_shingles").cast("int") - 1)).alias("last"))
    same = F.col("item_id").eqNullSafe(F.col("_item"))
    return stored(sized.join(bounds, same).select("item_id", "n_shingles", "size_class", "shingle", "h", (F.col("h") <= F.col("last")).alias("in_sketch")), "index")


def find_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = 0.75) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of all pairs with at least ``share`` of the item's shingles in the document.

    Null and empty texts hold nothing. Rows of one doc_id count as one document, rows of one item_id as
    one item; null ids are ids like others.
    """
    index = index_items(items, item_id, item_text, share)
    sketch, every = _bit_array(index.where("in_sketch").select("h")), _bit_array(index.select("h"))

    def shared(words: Column, hashes: Column) -> Column:
        """Shingles of a candidate that some item has too, with the number of all its shingles."""
        known = F.filter(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda x: _in_bits(F.col("every"), x["h"]))
        texts = F.transform(known, lambda x: F.struct(x["h"].alias("h"), _shingle(words, x["i"]).alias("shingle"), F.size(hashes).alias("size")))
        return F.when(F.exists(hashes, lambda h: _in_bits(F.col("sketch"), h)), F.array_distinct(texts))

    # one expression, and an outer explode, so that Spark cannot move a part of it into a filter and work it out twice
    met = _let(_words(text), lambda words: _let(_hashes(words), lambda hashes: shared(words, hashes)))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(text), sketch.alias("sketch"), every.alias("every"))
    shingles = texts.select("doc_id", F.explode_outer(met).alias("s")).select("doc_id", "s.*").where("h IS NOT NULL")
    # a document with fewer shingles than the share of a size class needs cannot hold its items
    pairs = shingles.join(index, ["h", "shingle"]).where(F.col("size") >= F.lit(share) * F.col("size_class"))
    # no more shingles than the item has
    found = pairs.groupBy("doc_id", "item_id", "n_shingles").agg(F.size(F.collect_set("shingle")).cast("bigint").alias("n_found"), F.bool_or("in_sketch").alias("_candidate"))
    enough = found.where(F.col("_candidate") & (F.col("n_found") >= F.lit(share) * F.col("n_shingles")))
    return enough.select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = 0.75) -> DataFrame:
    """Rows of ``docs`` that hold no item."""
    found = stored(find_items(docs, items, doc_id, text, item_id, item_text, share).select(F.col("doc_id").alias("_held")).distinct(), "held")
    return docs.join(found, docs[doc_id].eqNullSafe(found["_held"]), "left_anti")
