"""Facts out of page markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow.functions.keys import _col, key_noparen, let, text
from catalogflow.functions.text import collapse, normalize_visible, repair_mojibake, sanitize_desc, strip_count, unescape_html


def _html(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip_tags(c, gap: str = " ") -> Column:
    return collapse(F.regexp_replace(_html(c), "<[^>]+>", gap))


def json_ld_blocks(c) -> Column:
    return F.regexp_extract_all(_html(c), F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))


def property_pairs(c) -> Column:
    """(name, value) of the JSON-LD property values, first of each name."""
    pattern = r'"@type":"PropertyValue","name":"([^"]*)","value":"([^"]*)"'
    names = F.regexp_extract_all(_html(c), F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(_html(c), F.lit(pattern), F.lit(2))
    pairs = F.zip_with(names, values, lambda n, v: F.struct(repair_mojibake(F.trim(n)).alias("name"), repair_mojibake(F.trim(v)).alias("value")))
    filled = F.filter(pairs, lambda p: (p["name"] != "") & (p["value"] != ""))
    return let(filled, lambda xs: F.filter(xs, lambda p, i: ~F.exists(F.slice(xs, F.lit(1), i), lambda q: F.lower(q["name"]) == F.lower(p["name"]))))


def _nodes(c) -> Column:
    """JSON-LD nodes as JSON texts: the members of @graph, else the block itself."""
    def of_block(b):
        v = F.try_parse_json(b)
        graph = F.try_variant_get(v, "$['@graph']", "array<variant>")
        return F.when(graph.isNotNull(), F.transform(graph, lambda g: F.to_json(g))).when(v.isNotNull(), F.array(b)).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(json_ld_blocks(c), of_block))


def _typed(c, name: str) -> Column:
    return F.filter(_nodes(c), lambda n: F.get_json_object(n, "$['@type']") == name)


def section(c, heading: str) -> Column:
    """Markup between a second-level heading and the next one."""
    return F.regexp_extract(_html(c), rf"(?s)<h2[^>]*>{heading}</h2>(.*?)(?:<h2|</section)", 1)


def page_description(c) -> Column:
    """JSON-LD product text, else the introduction, else the meta description."""
    product = F.filter(F.transform(_typed(c, "Product"), lambda n: sanitize_desc(F.get_json_object(n, "$.description"))), lambda d: d != "")
    intro = [F.nullif(sanitize_desc(strip_tags(section(c, h))), F.lit("")) for h in ("Introduction", "Description")]
    meta = sanitize_desc(F.regexp_extract(_html(c), r'<meta[^>]+name="description"[^>]+content="([^"]*)"', 1))
    return F.coalesce(F.try_element_at(product, F.lit(1)), *intro, meta)


def page_faq(c) -> Column:
    """question and answer pairs of the FAQ nodes."""
    entry = "array<struct<name:string,acceptedAnswer:struct<text:string>>>"
    lists = F.transform(_typed(c, "FAQPage"), lambda n: F.from_json(F.get_json_object(n, "$.mainEntity"), entry))
    clean = lambda x: normalize_visible(F.trim(F.regexp_replace(x, "<[^>]+>", "")))
    pairs = F.filter(F.flatten(F.filter(lists, lambda x: x.isNotNull())), lambda q: (F.coalesce(q["name"], F.lit("")) != "") & (F.coalesce(q["acceptedAnswer"]["text"], F.lit("")) != ""))
    return F.transform(pairs, lambda q: F.struct(clean(q["name"]).alias("question"), clean(q["acceptedAnswer"]["text"]).alias("answer")))


def page_brand(c) -> Column:
    """brand, else manufacturer, of the first product node that has one."""
    names = F.transform(_typed(c, "Product"), lambda n: F.coalesce(
        F.nullif(F.get_json_object(n, "$.brand.name"), F.lit("")), F.get_json_object(n, "$.manufacturer.name")))
    return F.coalesce(F.try_element_at(F.filter(names, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(1)), F.lit(""))


def list_after_heading(c, heading: str = "Applications") -> Column:
    """items of the list under a heading."""
    items = F.regexp_extract_all(section(c, heading), F.lit(r"(?s)<li[^>]*>(.*?)</li>"), F.lit(1))
    return F.transform(F.filter(F.transform(items, lambda x: strip_tags(x, "")), lambda x: x != ""), normalize_visible)


def alternate_anchors(c, own_code, own_mpn) -> Column:
    """(code, mpn) of the alternates table, the part itself left out, first of each code."""
    html = _html(c)
    mark = "Alternative Parts</h2>"
    after = F.when(F.instr(html, mark) > 0, F.substring_index(F.regexp_replace(html, r"(?s)^.*?" + mark, ""), "</table>", 1)).otherwise(html)
    pattern = r'(?s)<a[^>]+href="[^"]*/product-detail/(C\d+)\.html[^"]*"[^>]*>(.*?)</a>'
    codes = F.regexp_extract_all(after, F.lit(pattern), F.lit(1))
    labels = F.regexp_extract_all(after, F.lit(pattern), F.lit(2))
    pairs = F.zip_with(codes, labels, lambda k, t: F.struct(k.alias("code"), strip_tags(t, "").alias("mpn")))
    own = key_noparen(own_mpn)
    kept = F.filter(pairs, lambda p: (p["code"] != text(own_code)) & (p["mpn"] != "") & ((own == "") | (key_noparen(p["mpn"]) != own)))
    return let(kept, lambda xs: F.filter(xs, lambda p, i: ~F.exists(F.slice(xs, F.lit(1), i), lambda q: q["code"] == p["code"])))


def page_state(c, variable: str = "__NEXT_DATA__") -> Column:
    """F64: JSON embedded in the page by its script id, entities undone."""
    raw = F.regexp_extract(_html(c), rf'(?s)<script[^>]*id="{variable}"[^>]*>(.*?)</script>', 1)
    return F.try_parse_json(unescape_html(raw))


def main_product(state) -> Column:
    """F64: the product node of the page state, at its one fixed place."""
    return F.try_variant_get(_col(state), "$.props.pageProps.webData", "variant")


# Error classes of a fetched page.
def page_error_class(status, c, code) -> Column:
    """F64: why a page cannot be used; blank when it can. ``code`` is the part that was asked for."""
    s, html = _col(status).cast("int"), _html(c)
    has_state = html.rlike(r'<script[^>]*id="__NEXT_DATA__"')
    state = page_state(c)
    product = F.try_variant_get(state, "$.props.pageProps.webData", "variant")
    found = F.try_variant_get(state, "$.props.pageProps.webData.productCode", "string")
    empty = F.try_variant_get(state, "$.props.pageProps.dataIsNull", "boolean")
    return (
        F.when(s == 404, "not_found_404").when(s == 429, "rate_limited").when(s == 403, "hard_blocked")
        .when((s >= 500) & (s <= 599), "server_error").when(s != 200, "http_error")
        .when(~has_state, "next_data_missing").when(state.isNull(), "json_parse")
        .when(F.coalesce(empty, F.lit(False)), "data_is_null")
        .when(product.isNull() | ~F.schema_of_variant(product).startswith("OBJECT"), "main_product_not_found")
        .when(~found.eqNullSafe(_col(code)), "c_number_mismatch").otherwise(""))


def item_list(c) -> Column:
    """product rows of the JSON-LD item lists."""
    product = ("struct<`@type`:string,mpn:string,name:string,sku:string,description:string,"
               "offers:struct<price:string,availability:string>>")
    entry = f"array<struct<item:{product}>>"
    lists = F.transform(_typed(c, "ItemList"), lambda n: F.from_json(F.get_json_object(n, "$.itemListElement"), entry))
    rows = F.filter(F.flatten(F.filter(lists, lambda x: x.isNotNull())), lambda r: r["item"]["@type"] == "Product")
    available = lambda r: F.coalesce(r["item"]["offers"]["availability"], F.lit(""))
    return F.transform(rows, lambda r: F.struct(
        text(r["item"]["sku"]).alias("supplier_sku"),
        F.when(text(r["item"]["mpn"]) != "", text(r["item"]["mpn"])).otherwise(text(r["item"]["name"])).alias("mpn"),
        text(r["item"]["name"]).alias("title"), text(r["item"]["description"]).alias("description"),
        F.coalesce(r["item"]["offers"]["price"], F.lit("")).alias("price"),
        F.when(available(r).contains("InStock"), F.lit("In Stock")).otherwise(available(r)).alias("stock")))


def hrefs(c) -> Column:
    """F66."""
    return F.regexp_extract_all(_html(c), F.lit(r'href="([^"]*)"'), F.lit(1))


def title(c) -> Column:
    return collapse(F.regexp_extract(_html(c), r"(?is)<title[^>]*>(.*?)</title>", 1))


def first_heading(c) -> Column:
    return strip_tags(F.regexp_extract(_html(c), r"(?is)<h1[^>]*>(.*?)</h1>", 1))


def visible_text(c) -> Column:
    body = F.regexp_replace(_html(c), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    return strip_tags(F.regexp_replace(body, r"(?s)<!--.*?-->", " "))


def tree_anchors(c) -> Column:
    """category anchors in document order: level from the marker in the URL, id, name, url."""
    pattern = r'(?s)<a[^>]*href="(https?://[^"/]*/catalog/(\d+)\.html[^"]*)"[^>]*>(.*?)</a>'
    urls = F.regexp_extract_all(_html(c), F.lit(pattern), F.lit(1))
    ids = F.regexp_extract_all(_html(c), F.lit(pattern), F.lit(2))
    names = F.regexp_extract_all(_html(c), F.lit(pattern), F.lit(3))
    rows = F.transform(F.arrays_zip(urls.alias("u"), ids.alias("i"), names.alias("n")), lambda r: F.struct(
        F.when(r["u"].contains(".ls.ca."), 1).when(r["u"].contains(".ca.cal."), 2).when(r["u"].contains(".cal.ke."), 3).otherwise(0).alias("level"),
        r["i"].alias("id"), strip_count(unescape_html(strip_tags(r["n"], ""))).alias("name"), F.substring_index(r["u"], "?", 1).alias("url")))
    return F.filter(rows, lambda r: r["level"] > 0)


def mask_for_scan(c) -> Column:
    """comments, bilingual attributes and the other-language branch blanked before a scan."""
    # Comment forms, the attribute family, and the language switch.
    s = F.regexp_replace(_html(c), r"(?s)//[^\n]*|/\*.*?\*/|<!--.*?-->", "")
    s = F.regexp_replace(s, r"""(?i)data-zh[a-z-]*\s*=\s*(?:"[^"]*"|'[^']*')""", "")
    return F.regexp_replace(s, r"""(getLang\(\)\s*===\s*"zh"\s*\)\s*\?\s*)("[^"]*"|'[^']*')(\s*:)""", '$1""$3')
