"""JSON of any depth as rows (P20, P21, F64): nodes level by level with Variant, texts rebuilt from the nodes.

A level holds the members of the containers that the level above has opened; each is checkpointed, and levels are made until
none has an open container left. So the number of jobs is the depth of the deepest text, and everything else is joins and
groups keyed by (text, place). A group is the members of one container.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.attrs import INTERNAL_KEYS
from catalogflow.functions.markup import page_state
from catalogflow.functions.keys import let
from catalogflow.session import cut


def is_container(v: Column) -> Column:
    """An object or array with at least one member."""
    return let(F.to_json(v), lambda t: t.rlike(r"^[{\[]") & ~t.isin("{}", "[]"))


def names_key(v: Column, keys: Sequence[str]) -> Column:
    """Whether a key of ``keys`` is somewhere inside; a text that only looks like one may pass too."""
    return F.coalesce(F.to_json(v).rlike('"(' + "|".join(keys) + r')"\s*:'), F.lit(False))


def json_levels(docs: DataFrame, doc: str, value: str, opens: Callable[[Column, Column], Column] | None = None) -> list[DataFrame]:
    """Levels from the root down: (doc, at, path, key, value, opened).

    ``docs`` has a unique column ``doc`` and a Variant column ``value``. ``at`` is the place as positions from the root and ``path``
    the same as text; ``key`` is null in arrays. ``opens(key, value)`` says which containers are opened, all if it is not given.
    Rows whose value is null have a root and nothing below.
    """
    chosen = lambda key, v: is_container(v) & (opens(key, v) if opens else F.lit(True))
    root = docs.select(F.col(doc).alias("doc"), F.array().cast("array<int>").alias("at"), F.lit("").alias("path"), F.lit(None).cast("string").alias("key"), F.col(value).alias("value"))
    levels = [cut(root.withColumn("opened", F.coalesce(chosen(F.col("key"), F.col("value")), F.lit(False))))]
    tvf = docs.sparkSession.tvf
    while not (above := levels[-1].where("opened")).isEmpty():
        held = above.select("doc", F.col("at").alias("_up"), F.col("path").alias("_path"), F.col("value").alias("_container"))
        met = held.lateralJoin(tvf.variant_explode(F.col("_container").outer()))
        path = F.when(F.col("key").isNull(), F.concat("_path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat_ws(".", F.nullif("_path", F.lit("")), "key"))
        rows = met.select("doc", F.array_append("_up", F.col("pos")).alias("at"), path.alias("path"), "key", "value")
        levels.append(cut(rows.withColumn("opened", F.coalesce(chosen(F.col("key"), F.col("value")), F.lit(False)))))
    return levels


def _met(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join of rows of levels as a merge join: Spark takes a checkpointed level for as small as the file its texts came from, and would send all of it to the driver to broadcast it."""
    return left.join(right.hint("merge"), on, how)


def rebuilt(levels: list[DataFrame]) -> DataFrame:
    """(doc, json): the texts of the nodes in ``levels``; what was filtered out of a level is left out of the text. Keys are in Variant's order."""
    built = None
    for level in reversed(levels):
        own = F.when(~F.col("opened"), F.to_json("value")).otherwise(F.when(F.to_json("value").startswith("{"), "{}").otherwise("[]"))
        if built is None:
            texts = level.withColumn("json", F.coalesce(own, F.lit("null")))
        else:
            texts = _met(level, built, ["doc", "at"]).withColumn("json", F.coalesce("_json", own, F.lit("null"))).drop("_json")
        name = F.to_json(F.array("key"))
        member = F.when(F.col("key").isNull(), F.col("json")).otherwise(F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":"), "json"))
        up = texts.where(F.size("at") > 0).select("doc", F.slice("at", F.lit(1), F.size("at") - 1).alias("_at"), F.element_at("at", -1).alias("pos"), member.alias("member"), F.col("key").isNull().alias("listed"))
        joined = up.groupBy("doc", "_at").agg(F.array_sort(F.collect_list(F.struct("pos", "member"))).alias("m"), F.bool_and("listed").alias("listed"))
        inner = F.array_join(F.col("m")["member"], ",")
        built = joined.select("doc", F.col("_at").alias("at"), F.when(F.col("listed"), F.concat(F.lit("["), inner, F.lit("]"))).otherwise(F.concat(F.lit("{"), inner, F.lit("}"))).alias("_json"))
    return texts.select("doc", "json")


def isolate_keys_in(df: DataFrame, c: str, out: str, forbidden: Sequence[str] = INTERNAL_KEYS) -> DataFrame:
    """P20 over a table, any depth: ``out`` is struct<public, isolated<path, key, value>> of the JSON text ``c``.

    Only texts that name a key are taken apart, and in them only containers that do. Equal texts are worked on once. A text that is not JSON stays
    as it is with nothing isolated, and so does null. Taken-out values are in the order of their paths.
    """
    suspect = F.coalesce(F.col(c).rlike('"(' + "|".join(forbidden) + r')"'), F.lit(False))
    none = F.array().cast("array<struct<path:string,key:string,value:string>>")
    clean = df.where(~suspect).withColumn(out, F.struct(F.col(c).alias("public"), none.alias("isolated")))
    found = df.where(suspect).withColumn("_doc", F.sha2(c, 256))
    texts = found.groupBy("_doc").agg(F.first(c).alias("_text")).withColumn("_v", F.try_parse_json("_text")).where("_v IS NOT NULL")
    inner = F.coalesce(F.col("key").isin(*forbidden), F.lit(False))
    levels = json_levels(texts, "_doc", "_v", lambda key, v: ~F.coalesce(key.isin(*forbidden), F.lit(False)) & names_key(v, forbidden))
    taken = None
    for level in levels[1:]:
        rows = level.where(inner).select("doc", "path", "key", F.to_json("value").alias("value"))
        taken = rows if taken is None else taken.unionByName(rows)
    public = rebuilt([level.where(~inner) for level in levels]).select(F.col("doc").alias("_doc"), F.col("json").alias("_public"))
    joined = _met(found, public, "_doc")
    if taken is None:
        listed = joined.withColumn("_isolated", none)
    else:
        lists = taken.groupBy(F.col("doc").alias("_doc")).agg(F.array_sort(F.collect_list(F.struct("path", "key", "value"))).alias("_isolated"))
        listed = _met(joined, lists, "_doc")
    parts = F.struct(F.coalesce("_public", F.col(c)).alias("public"), F.coalesce("_isolated", none).alias("isolated"))
    return clean.unionByName(listed.withColumn(out, parts).drop("_doc", "_public", "_isolated"))


def leaked_keys_in(df: DataFrame, doc: str, c: str, forbidden: Sequence[str]) -> DataFrame:
    """P21 as rows (doc, path, key): forbidden keys at any depth of the JSON text, with their places. Keys inside values that look like keys are not taken for one."""
    texts = df.select(F.col(doc).alias("doc"), F.try_parse_json(c).alias("_v")).where("_v IS NOT NULL")
    levels = json_levels(texts, "doc", "_v", lambda key, v: names_key(v, forbidden))
    found = levels[0].where("false").select("doc", "path", "key")
    for level in levels[1:]:
        found = found.unionByName(level.where(F.col("key").isin(*forbidden)).select("doc", "path", "key"))
    return found


# ---- product node of a page state (F64) -------------------------------------------------

# Where the product node belongs, the key that names its part, and keys that it should have.
_PLACE = "props.pageProps.webData"
_CODE = "productCode"
_EXPECTED = ("productModel", "brandNameEn", "wmCatalogNameEn")


def state_products(pages: DataFrame, page_id: str, html: str, code: str) -> DataFrame:
    """F64 per page: (page_id, error, path, product, notes).

    The product node is an object that names a part by its code. It is looked for at its own place first and then at any depth, the
    shallowest and then the first in the page; a node counts only if its code is the one asked for, so another product on the page is
    never taken. ``error`` is blank when there is a product: ``next_data_missing`` without an embedded state, ``json_parse`` when it is
    damaged, ``data_is_null`` when it says so itself, ``main_product_not_found`` without any such node, ``c_number_mismatch`` when
    all of them name other parts. ``notes`` lists expected keys that are blank.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(code).cast("string").alias("_code"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    has_state = F.col("_html").rlike(r'<script[^>]*id="__NEXT_DATA__"')
    parsed = cut(rows.select("page_id", "_code", has_state.alias("_has"), page_state("_html").alias("_state")))
    empty = F.coalesce(F.try_variant_get("_state", "$.props.pageProps.dataIsNull", "boolean"), F.lit(False))
    levels = json_levels(parsed.where(F.col("_state").isNotNull() & ~empty), "page_id", "_state", lambda key, v: names_key(v, [_CODE]))
    nodes = None
    for level in levels:
        of_level = level.where("opened").select("doc", "path", "at", "value", F.try_variant_get("value", f"$.{_CODE}", "string").alias("found")).where("found IS NOT NULL")
        nodes = of_level if nodes is None else nodes.unionByName(of_level)
    asked = _met(nodes, parsed.select(F.col("page_id").alias("doc"), "_code"), "doc", "inner")
    ranked = Window.partitionBy("doc").orderBy((F.col("found") != F.col("_code")).cast("int"), (F.col("path") != _PLACE).cast("int"), F.size("at"), "at")
    best = asked.where(F.col("_code").isNotNull()).withColumn("_n", F.row_number().over(ranked)).where("_n = 1")
    good = F.col("found") == F.col("_code")
    product = best.select(F.col("doc").alias("page_id"), good.alias("_good"), "path", F.when(good, F.col("value")).alias("product"))
    blank = F.array_compact(F.array(*[F.when(F.coalesce(F.try_variant_get("product", f"$.{k}", "string"), F.lit("")) == "", F.lit(f"missing:{k}")) for k in _EXPECTED]))
    error = (
        F.when(~F.col("_has"), "next_data_missing").when(F.col("_state").isNull(), "json_parse").when(empty, "data_is_null")
        .when(F.col("_good").isNull(), "main_product_not_found").when(~F.col("_good"), "c_number_mismatch").otherwise("")
    )
    joined = _met(parsed, product, "page_id").withColumn("error", error)
    usable = F.col("error") == ""
    return joined.select("page_id", "error", F.when(usable, F.col("path")).alias("path"), F.to_json("product").alias("product"), F.when(usable, blank).alias("notes"))
