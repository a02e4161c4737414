"""Column lists and declared schemas of the catalog data sets."""

from __future__ import annotations

from pyspark.sql import types as T

# MASTER columns in their stored order, and the columns a new row must fill.
MASTER_COLUMNS = (
    "mpn", "clean_mpn", "manufacturer", "brand", "url_slug", "description",
    "applications", "keywords", "attributes_json", "availability",
    "alternative_parts", "alternative_parts_detail", "datasheet_url", "faq",
    "image", "source", "source_url", "supplier_reference", "native_l1",
    "lcsc_parent_chain", "lcsc_leaf_id", "lcsc_leaf_name", "lcsc_parent_id",
    "lcsc_parent_name", "lcsc_depth",
)
REQUIRED_COLUMNS = ("mpn", "manufacturer", "description")
NUMERIC_MASTER_COLUMNS = ("lcsc_depth", "lcsc_leaf_id", "lcsc_parent_id")


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MASTER = strings(*MASTER_COLUMNS)

RAW_FLAT = T.StructType(
    [T.StructField("rank", T.IntegerType())]
    + strings(
        "mpn", "manufacturer_raw", "catalogName", "category", "description",
        "attributes_json", "source_datasheet_url", "supplier_sku",
    ).fields
)

PARAMETER = T.StructType([
    T.StructField("paramName", T.StringType()),
    T.StructField("paramNameEn", T.StringType()),
    T.StructField("paramValue", T.StringType()),
    T.StructField("paramValueEn", T.StringType()),
    T.StructField("isMain", T.BooleanType()),
    T.StructField("sort", T.IntegerType()),
])
CATALOG_NODE = T.StructType([
    T.StructField("catalogId", T.LongType()),
    T.StructField("catalogName", T.StringType()),
    T.StructField("catalogNameEn", T.StringType()),
])
FAQ = strings("question", "answer")
ALTERNATE_RAW = strings("productModel", "brandNameEn", "productCode", "type", "encapStandard")
ALTERNATE = strings("mpn", "manufacturer", "lcsc", "type", "package")

MAIN_PRODUCT = T.StructType(
    strings(
        "productCode", "productModel", "brandNameEn", "catalogName", "parentCatalogName",
        "wmCatalogNameEn", "productNameEn", "productIntroEn", "productKeyAttributes",
        "pdfUrl", "encapStandard", "eccn", "rohsCertType", "productImageUrlBig", "productImageUrl",
    ).fields
    + [
        T.StructField("catalogId", T.LongType()),
        T.StructField("isRohsCert", T.BooleanType()),
        T.StructField("isAsianBrand", T.BooleanType()),
        T.StructField("htsMap", T.MapType(T.StringType(), T.StringType())),
        T.StructField("productImages", T.ArrayType(T.StringType())),
        T.StructField("paramVOList", T.ArrayType(PARAMETER)),
        T.StructField("parentCatalogList", T.ArrayType(CATALOG_NODE)),
        T.StructField("faqs", T.ArrayType(FAQ)),
    ]
)
ENVELOPE = T.StructType([
    T.StructField("c_number", T.StringType()),
    T.StructField("captured_at", T.TimestampType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("source_raw", T.StructType([
        T.StructField("main_product", MAIN_PRODUCT),
        T.StructField("overviewData", strings("productIntroEn", "productFeaturesEn", "pdfApplicationAreasEn")),
        T.StructField("alternatePartList", T.ArrayType(ALTERNATE_RAW)),
    ])),
])

LEDGER = T.StructType([
    T.StructField("mpn", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

TAXONOMY = T.StructType([
    T.StructField("top_scopes", T.ArrayType(strings("slug", "name", "publish_status"))),
    T.StructField("l1_categories", T.ArrayType(strings("slug", "top_scope", "en_display", "publish_status"))),
])

EXCEPTION = strings("code", "severity", "mpn", "message")
