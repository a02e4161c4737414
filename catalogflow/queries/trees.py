"""Queries over nested JSON and embedded page data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import bindings as b
from catalogflow.functions import attrs, markup
from catalogflow.functions.keys import nonblank
from catalogflow.operators import json_tree
from catalogflow.queries.registry import query

# Internal keys at depths 1 to 5: in objects, in arrays of objects, beside members that stay; a text without any; one
# that is not JSON; and a value that only reads like a key.
_DEEP_SQL = """CASE WHEN size>40 THEN '{"a":{"b":[{"c":{"costPrice":'||size||',"d":[{"keep":'||ord||',"warehouseCode":"w'||ord||'"}]}},{"c":{}}],"profitRate":{"x":[1,2]}},"mpn":"'||mpn||'"}'
   WHEN size>30 THEN '[[{"purchasePrice":null,"z":[]}],'||ord||']' WHEN size>20 THEN '{"a":{"b":{"c":{"d":{"note":"costPrice"}}}},"n":'||ord||'}' WHEN size>10 THEN '{"costPrice":1' END"""


def _deep(spark, sf):
    t = lambda x: F.col(x).cast("string")
    s = F.col("size")
    text = (
        F.when(s > 40, F.concat(F.lit('{"a":{"b":[{"c":{"costPrice":'), t("size"), F.lit(',"d":[{"keep":'), t("ord"), F.lit(',"warehouseCode":"w'), t("ord"), F.lit('"}]}},{"c":{}}],"profitRate":{"x":[1,2]}},"mpn":"'), "mpn", F.lit('"}')))
        .when(s > 30, F.concat(F.lit('[[{"purchasePrice":null,"z":[]}],'), t("ord"), F.lit("]")))
        .when(s > 20, F.concat(F.lit('{"a":{"b":{"c":{"d":{"note":"costPrice"}}}},"n":'), t("ord"), F.lit("}"))).when(s > 10, '{"costPrice":1')
    )
    return b.parts(spark, sf).select("ord", text.alias("j"))


@query(b.sql(f"""SELECT ord, CASE WHEN size>40 THEN '{{"a":{{"b":[{{"c":{{"d":[{{"keep":'||ord||'}}]}}}},{{"c":{{}}}}]}},"mpn":"'||mpn||'"}}' WHEN size>30 THEN '[[{{"z":[]}}],'||ord||']' ELSE {_DEEP_SQL} END AS public,
  CASE WHEN size>40 THEN 'a.b[0].c.costPrice='||size||';a.b[0].c.d[0].warehouseCode="w'||ord||'";a.profitRate={{"x":[1,2]}}' WHEN size>30 THEN '[0][0].purchasePrice=null' ELSE '' END AS isolated FROM parts_v""", "parts_v"))
def commercial_keys_deep(spark, sf):
    out = json_tree.isolate_keys_in(_deep(spark, sf), "j", "deep")
    return out.select("ord", F.col("deep.public").alias("public"), F.array_join(F.transform("deep.isolated", lambda x: F.concat_ws("=", x["path"], x["value"])), ";").alias("isolated"))


@query(b.sql("""SELECT ord, CASE WHEN size>40 THEN 'a.b[0].c.d[0].warehouseCode' ELSE '[0][0].purchasePrice' END AS path, CASE WHEN size>40 THEN 'warehouseCode' ELSE 'purchasePrice' END AS key FROM parts_v WHERE size>30""", "parts_v"))
def leaked_key_paths(spark, sf):
    return json_tree.leaked_keys_in(_deep(spark, sf), "ord", "j", attrs.FORBIDDEN_KEYS).withColumnRenamed("doc", "ord")


def _state_pages(spark, sf):
    """``pages`` with an embedded state: the product at its place, deeper beside another one, damaged, foreign, empty, without product, absent."""
    i, code = F.col("page_id"), F.concat(F.lit("C"), F.col("page_id").cast("string"))
    node = lambda c, name: F.concat(F.lit('{"productCode":"'), c, F.lit('","productModel":"'), F.col("url"), F.lit(f'","brandNameEn":"{name}","paramVOList":[{{"a":[1]}}]}}'))
    other = F.concat(code, F.lit("9"))
    at_place = lambda n: F.concat(F.lit('{"props":{"pageProps":{"webData":'), n, F.lit("}}}"))
    state = (
        F.when(i % 7 == 0, at_place(node(code, "Maker")))
        .when(i % 7 == 1, F.concat(F.lit('{"props":{"pageProps":{"webData":{"productCode":"C0","list":[1]},"views":[{"main":{"items":['), node(other, "Other"), F.lit(","), node(code, ""), F.lit("]}}]}}}")))
        .when(i % 7 == 2, F.lit('{"props":{"pageProps":'))
        .when(i % 7 == 3, at_place(node(other, "Other")))
        .when(i % 7 == 4, F.lit('{"props":{"pageProps":{"dataIsNull":true}}}'))
        .when(i % 7 == 5, F.lit('{"props":{"pageProps":{"webData":{"list":[{"x":1}]}}}}'))
    )
    script = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), F.replace(state, F.lit('"'), F.lit("&quot;")), F.lit("</script>"))
    return b.read(spark, sf, "pages").select("page_id", F.concat(F.coalesce(script, F.lit("")), F.coalesce("html", F.lit(""))).alias("html"), code.alias("code"))


@query("""SELECT page_id, ['','','json_parse','c_number_mismatch','data_is_null','main_product_not_found','next_data_missing'][page_id%7+1] AS error,
  CASE page_id%7 WHEN 0 THEN 'props.pageProps.webData' WHEN 1 THEN 'props.pageProps.views[0].main.items[1]' END AS path, CASE WHEN page_id%7<2 THEN url END AS model,
  CASE page_id%7 WHEN 0 THEN 'missing:wmCatalogNameEn' WHEN 1 THEN 'missing:brandNameEn,missing:wmCatalogNameEn' END AS notes FROM pages""")
def page_states(spark, sf):
    out = json_tree.state_products(_state_pages(spark, sf), "page_id", "html", "code")
    return out.select("page_id", "error", "path", F.get_json_object("product", "$.productModel").alias("model"), F.array_join("notes", ",").alias("notes"))


@query("""SELECT page_id, k AS pos, 'S'||page_id||'-'||k AS supplier_sku, CASE k WHEN 1 THEN url ELSE 'Part '||k END AS mpn, 'Part '||k AS title, CASE k WHEN 2 THEN '' ELSE page_id||'.50' END AS price,
  CASE k WHEN 0 THEN 'In Stock' WHEN 1 THEN 'https://schema.org/OutOfStock' ELSE '' END AS stock FROM pages, range(3) r(k) WHERE page_id%4<2""")
def listing_products(spark, sf):
    """A list of three products in the page's data block, alone or in a graph; damaged; and absent."""
    i = F.col("page_id").cast("string")
    item = lambda k, mpn, offer: F.concat(F.lit('{"item":{"@type":"Product","sku":"S'), i, F.lit(f'-{k}","name":"Part {k}"'), mpn, offer, F.lit("}}"))
    offer = lambda kind: F.concat(F.lit(',"offers":{"price":"'), i, F.lit(f'.50","availability":"https://schema.org/{kind}"}}'))
    none = F.lit("")
    listed = F.concat(F.lit('{"@type":"ItemList","itemListElement":['), item(0, none, offer("InStock")), F.lit(","), item(1, F.concat(F.lit(',"mpn":"'), F.col("url"), F.lit('"')), offer("OutOfStock")), F.lit(","),
                      item(2, none, none), F.lit(',{"item":{"@type":"Brand","name":"B"}}]}'))
    turn = F.col("page_id") % 4
    data = F.when(turn == 0, listed).when(turn == 1, F.concat(F.lit('{"@context":"x","@graph":[{"@type":"WebPage"},'), listed, F.lit("]}"))).when(turn == 2, F.substring(listed, 1, 60))
    html = F.concat(F.coalesce(F.concat(F.lit('<script type="application/ld+json">'), data, F.lit("</script>")), none), F.coalesce("html", none))
    rows = b.read(spark, sf, "pages").select("page_id", F.posexplode(markup.item_list(html)).alias("pos", "r"))
    return rows.select("page_id", "pos", "r.supplier_sku", "r.mpn", "r.title", "r.price", "r.stock")


@query("""SELECT page_id, k AS pos, k+1 AS level, CAST(page_id*10+k AS VARCHAR) AS id, ['Power','Regulators','LDO & more'][k+1] AS name, 'https://www.example.com/catalog/'||(page_id*10+k)||'.html' AS url,
  CASE k WHEN 0 THEN '' WHEN 1 THEN 'Power' ELSE 'Power > Regulators' END AS above FROM pages, range(3) r(k)""")
def category_anchors(spark, sf):
    """Anchors of three levels, one of no level, and the names above each."""
    i = F.col("page_id")
    anchor = lambda k, mark, name: F.concat(F.lit('<a class="c" href="https://www.example.com/catalog/'), (i * 10 + k).cast("string"), F.lit(f'.html?spm=x{mark}y"><span>{name}</span></a>'))
    html = F.concat(anchor(0, ".ls.ca.", "Power (1,234)"), anchor(1, ".ca.cal.", "Regulators"), anchor(5, ".none.", "Other"), anchor(2, ".cal.ke.", "LDO &amp; more"), F.coalesce("html", F.lit("")))
    rows = b.read(spark, sf, "pages").select("page_id", markup.tree_anchors(html).alias("a"))
    each = rows.select("page_id", "a", F.posexplode("a").alias("pos", "x"))
    above = F.array_join(F.transform(F.filter(F.slice("a", F.lit(1), F.col("pos")), lambda y: nonblank(y["name"])), lambda y: y["name"]), " > ")
    return each.select("page_id", "pos", "x.level", "x.id", "x.name", "x.url", above.alias("above"))
