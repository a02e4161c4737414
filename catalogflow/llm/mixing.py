"""Documents taken so that sources meet target weights (pivotal dependent rounding).

A source's rate is its target over its size. Each document is taken as often as the whole part of the rate says, and
the rest is its fraction of one more copy. Fractions become whole copies in pairs: of two documents one hands words to the
other, in a direction drawn so that each keeps its expectation, until one of the two has no fraction left. The words of
a pair stay the same, so the words of a source do too.

The pairs form a reduction tree. Documents of one source and like size are dealt by hash into blocks of about 64;
a block is folded to one residual document, 64 blocks to one again, up to one residual for each size class. The root of a
source settles these few from the largest down. There a draw is made only where the smaller residuals
can make up for either outcome, so what a source misses of its target is about the size of a small document.

Only functions of Spark SQL are used, and a draw is a hash of the documents paired, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import stored
from catalogflow.operators.ordering import global_rank

_FAN = 6  # bits of a block number that one level of the tree takes away
_WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: str) -> Column:
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(text, F.lit(_WORD))).cast("long")


def target_sizes(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) of a table (source, source_size), one row for each source.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A
    target stops at ``most`` times the source's size, and what is over is shared anew by weight until no target is above.
    A source without words has the target 0.
    """
    ranked = global_rank(sizes, [F.col("source").isNull(), F.col("source")], "_rank")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights)).cast("int"))
    named = stored(ranked.select("source", "source_size", weight.alias("_w"), (F.lit(float(most)) * F.col("source_size")).alias("_cap")), "sources")
    total = named.agg(F.sum("source_size").alias("all"), F.sum("_w").alias("w")).first()
    wanted = share * (total["all"] or 0)
    level = wanted / total["w"] if total["w"] else 0.0
    while True:
        above = F.col("_cap") <= F.lit(level) * F.col("_w")
        left = named.agg(F.sum(F.when(above, F.col("_cap"))).alias("capped"), F.sum(F.when(~above, F.col("_w"))).alias("w")).first()
        if not left["w"]:  # every source is at its bound
            break
        further = (wanted - (left["capped"] or 0.0)) / left["w"]
        if further <= level:
            break
        level = further
    target = F.least("_cap", F.lit(level) * F.col("_w"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return stored(named.select("source", "source_size", target.alias("target"), rate.alias("rate")), "targets")


def _draw(seed: int, *of: Column) -> Column:
    """A number from 0 to below 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11).cast("double") / F.lit(float(1 << 53))


def _with(item: Column, mass: Column) -> Column:
    return item.withField("mass", mass)


def _pair(a: Column, b: Column, seed: int) -> Column:
    """The two documents after one has handed words to the other."""
    room_a, room_b = a["size"] - a["mass"], b["size"] - b["mass"]
    to_a, to_b = F.least(room_a, b["mass"]), F.least(a["mass"], room_b)
    up = F.array(
        _with(a, F.when(room_a <= b["mass"], a["size"].cast("double")).otherwise(a["mass"] + b["mass"])),
        _with(b, F.when(room_a <= b["mass"], b["mass"] - room_a).otherwise(0.0)),
    )
    down = F.array(
        _with(a, F.when(a["mass"] <= room_b, 0.0).otherwise(a["mass"] - room_b)),
        _with(b, F.when(a["mass"] <= room_b, b["mass"] + a["mass"]).otherwise(b["size"].cast("double"))),
    )
    # up to to_a words with the chance to_b / (to_a + to_b), or to_b words the other way: nobody's expectation changes
    drawn = _draw(seed, a["id"], a["copy"], b["id"], b["copy"])
    return F.when(drawn * (to_a + to_b) < to_b, up).otherwise(down)


def _is_whole(x: Column) -> Column:
    return (x["mass"] <= 0.0) | (x["mass"] >= x["size"])


_ITEM = "struct<h:bigint,id:{id},copy:bigint,size:bigint,mass:double>"


def _fold(items: Column, item: str, seed: int) -> Column:
    """(open, done): documents with a fraction, one at most, and those with none, of the array ``items``."""
    none = F.array().cast(f"array<{item}>")
    zero = F.struct(none.alias("open"), none.alias("done"))

    def add(state: Column, x: Column) -> Column:
        both = F.when(F.size(state["open"]) == 0, F.array(x)).otherwise(_pair(state["open"][0], x, seed))
        return F.transform(F.array(both), lambda b: F.struct(F.filter(b, lambda y: ~_is_whole(y)).alias("open"), F.concat(state["done"], F.filter(b, _is_whole)).alias("done")))[0]

    return F.aggregate(items, zero, add)


def _root(items: Column, item: str, seed: int) -> Column:
    """All residuals of a source, sorted by size downwards, as whole copies.

    ``wanted`` are the words that the residuals not yet settled should give, ``later`` the sizes after this one.
    """
    start = F.struct(F.aggregate(items, F.lit(0.0), lambda s, x: s + x["mass"]).alias("wanted"), F.aggregate(items, F.lit(0.0), lambda s, x: s + x["mass"]).alias("mass"),
                     F.aggregate(items, F.lit(0).cast("long"), lambda s, x: s + x["size"]).alias("later"), F.array().cast(f"array<{item}>").alias("done"))

    def settle(s: Column, x: Column) -> Column:
        later, size = s["later"] - x["size"], x["size"].cast("double")
        chance = (x["mass"] + s["wanted"] - s["mass"]) / size
        short, over = s["wanted"] - later, size - s["wanted"]  # words missed if left, words too many if taken
        taken = F.when((short > 0) & (over > 0), over < short).when(short > 0, True).when(over > 0, False).otherwise(_draw(seed, x["id"], x["copy"]) < chance)
        got = F.when(taken, size).otherwise(0.0)
        return F.struct((s["wanted"] - got).alias("wanted"), (s["mass"] - x["mass"]).alias("mass"), later.alias("later"), F.concat(s["done"], F.array(_with(x, got))).alias("done"))

    return F.aggregate(items, start, settle)["done"]


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 11,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs``; taken is a whole number of copies of the document's words.

    Null and empty texts have the size 0 and are taken 0 times. A null source is a source of its own. Rows that repeat are
    documents of their own, told apart by a running number. Null ids are ids like others. A document is taken at least as often
    as the whole part of its source's rate and at most once more, never more than ``most`` times, rounded up. An empty table gives an empty one.
    """
    sized = stored(docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), words_in(text).alias("size")), "sized")
    item = _ITEM.format(id=sized.schema["id"].dataType.simpleString())
    targets = target_sizes(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    rates = targets.select(F.col("source").alias("_source"), "rate")
    rated = sized.groupBy("id", "source", "size").count().join(rates, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    each = rated.select("id", "source", "size", "rate", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("copy"))
    mass = (F.col("rate") - F.floor("rate")) * F.col("size")
    placed = each.select("source", F.when(F.col("size") > 0, F.floor(F.log2("size") * 4)).otherwise(-1).alias("cls"),
                         F.struct(F.xxhash64(F.lit(seed), "id", "copy", "size").alias("h"), "id", "copy", "size", mass.alias("mass")).cast(item).alias("x"))
    rows = stored(placed, "documents")
    done = [rows.where(_is_whole(F.col("x"))).select("source", "x")]
    open_ = rows.where(~_is_whole(F.col("x")))
    cells = open_.groupBy("source", "cls").agg(F.count(F.lit(1)).alias("n"))
    bits = (F.greatest(F.ceil(F.log2("n")) - _FAN, F.lit(0))).cast("int")
    cells = stored(cells.select(F.col("source").alias("_source"), F.col("cls").alias("_cls"), bits.alias("bits")), "cells")
    levels = -(-(cells.agg(F.max("bits")).first()[0] or 0) // _FAN) + 1
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("cls") == F.col("_cls"))
    block = F.col("x.h").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bits")) - 1)
    open_ = open_.join(cells, same).select("source", "cls", block.alias("block"), "x")
    for level in range(levels):
        met = open_.groupBy("source", "cls", "block").agg(F.array_sort(F.collect_list("x")).alias("items"))
        folded = stored(met.select("source", "cls", "block", _fold(F.col("items"), item, seed + 1 + level).alias("f")), "folded")
        done.append(folded.select("source", F.explode("f.done").alias("x")))
        left = folded.where(F.size("f.open") > 0)
        open_ = left.select("source", "cls", F.shiftrightunsigned("block", _FAN).alias("block"), F.col("f.open")[0].alias("x"))
    # one residual of each size class at most: 252 classes hold every size
    last = open_.groupBy("source").agg(F.array_sort(F.collect_list(F.struct((-F.col("x.size")).alias("by"), "x"))).alias("items"))
    done.append(last.select("source", F.explode(_root(F.transform("items", lambda y: y["x"]), item, seed)).alias("x")))
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    known = targets.withColumnRenamed("source", "_source")
    copies = F.floor("rate") + F.when(F.col("size") > 0, F.round(F.col("mass") / F.col("size"))).otherwise(0).cast("long")
    found = settled.select("source", F.col("x.id").alias("doc_id"), F.col("x.size").alias("size"), F.col("x.mass").alias("mass")).join(known, F.col("source").eqNullSafe(F.col("_source")))
    return found.select("doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))
