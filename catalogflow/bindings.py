"""Catalog views over the driver tables.

The driver has no part catalog, so these functions derive one from ``part``, ``lineitem``,
``supplier``, ``events`` and ``documents``. Every view covers its whole tables. ``VIEWS``
holds the same definitions in SQL for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STORAGE_HOST = "files.r2.dev"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tasks_for(df: DataFrame, rows: int = 20_000) -> int:
    """Tasks for costly work on ``df``: some for each core, and more once a task would have more than ``rows``. Rows are counted first, which a file's footer tells."""
    return max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def dealt(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Rows dealt out to many tasks. A table of short rows is one split of one file, however much work each row is."""
    return df.repartition(n or tasks_for(df), *keys)


def mpn_of(name: str = "p_name") -> Column:
    return F.upper(F.replace(F.col(name), F.lit(" "), F.lit("-")))


# Family nouns of the driver's part names, with the catalog they stand in for.
NOUNS = {
    "plate": ("Capacitors", "Multilayer Ceramic Capacitors MLCC"),
    "rod": ("Inductors, Coils, Chokes", "Power Inductors"),
    "anvil": ("Resistors", "Chip Resistor - Surface Mount"),
    "gear": ("Power Management (PMIC)", "Voltage Regulators - Linear, LDO"),
    "gizmo": ("Embedded Processors & Controllers", "Microcontrollers (MCU/MPU/SOC)"),
    "ring": ("Diodes", "Schottky Diodes"),
    "bolt": ("Transistors/Thyristors", "MOSFETs"),
    "widget": ("Circuit Protection", "TVS Diodes"),
}


def _noun_map(i: int) -> Column:
    pairs = [F.lit(x) for noun, v in NOUNS.items() for x in (noun, v[i])]
    return F.create_map(*pairs)[F.substring_index(F.col("p_name"), " ", -1)]


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per part with the catalog columns the operators use."""
    p = read(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("ord"),
        mpn_of().alias("mpn"),
        F.col("p_brand").alias("manufacturer"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("cid"),
        F.col("p_name").alias("description"),
        _noun_map(0).alias("parent_catalog"),
        _noun_map(1).alias("catalog_name"),
        quantity_text().alias("quantity"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def quantity_text() -> Column:
    """A measurement text per part whose form follows the part type."""
    n = F.col("p_size").cast("string")
    return (
        F.when(F.col("p_type") == "ECONOMY", F.concat(n, F.lit("mV")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("4V~"), n, F.lit("V")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("3V;"), n, F.lit("V")))
        .when(F.col("p_type") == "MEDIUM", F.concat(F.lit("1.25V@"), n, F.lit("mA")))
        .when(F.col("p_type") == "PROMO", n)
        .otherwise(F.concat(F.lit("Level "), n))
    )


def offers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line: a supplier's offer for a part.

    The brand is written as different suppliers write it: upper case, lower case with a
    leading blank, or as listed.
    """
    li = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    p = read(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name")
    raw_brand = (
        F.when(F.col("l_returnflag") == "A", F.upper("p_brand"))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit(" "), F.lower("p_brand")))
        .otherwise(F.col("p_brand"))
    )
    return (
        li.join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice").alias("ord"),
            mpn_of().alias("mpn"),
            raw_brand.alias("manufacturer"),
            F.col("p_type").alias("category"),
            F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.col("p_name")).alias("description"),
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("stock "), F.col("p_type"))).otherwise(F.lit("")).alias("availability"),
            F.col("s_name").alias("source"),
            F.col("l_partkey").alias("partkey"),
            F.col("l_suppkey").alias("suppkey"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_returnflag").alias("returnflag"),
            F.col("l_linestatus").alias("linestatus"),
            F.col("p_size").alias("size"),
        )
    )


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Brand spellings seen in ``part`` with their canonical form, Brand#7 -> BRAND_7."""
    return read(spark, sf, "part").select(
        F.lower("p_brand").alias("raw"),
        F.replace(F.upper("p_brand"), F.lit("#"), F.lit("_")).alias("canonical"),
    ).distinct()


def listing_tasks(spark: SparkSession, sf: str, rows: int = 500_000) -> int | None:
    """Tasks for work on listings, each with those of about ``rows`` order lines; None as long as Spark's own number will do.

    Left alone, Spark puts 64 MB into one task, which is millions of short rows.
    """
    tasks = -(-read(spark, sf, "lineitem").count() // rows)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def listings(spark: SparkSession, sf: str, where: str, tasks: int | None = None) -> DataFrame:
    """One row per (part, supplier) from the order lines that satisfy ``where``.

    MASTER, batch and snapshot tables are such listings over different lines. Many lines are dealt out before they are aggregated:
    nearly every line is a pair of its own, so there is little to add up before.
    """
    li = read(spark, sf, "lineitem").where(where)
    if n := tasks or listing_tasks(spark, sf):
        li = dealt(li, "l_partkey", "l_suppkey", n=n)
    agg = li.groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").cast("long").alias("qty"),
        F.max("l_shipdate").cast("date").cast("string").alias("last_ship"),
    )
    p = read(spark, sf, "part")
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name")
    return (
        agg.join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("ord"),
            F.concat_ws("-", mpn_of(), F.col("p_size").cast("string")).alias("mpn"),
            F.col("s_name").alias("manufacturer"),
            F.concat(F.lit("C"), F.col("l_partkey").cast("string"), F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplier_reference"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("description"),
            "lines", "qty", "last_ship",
            F.col("p_brand").alias("brand"),
        )
    )


def master(spark: SparkSession, sf: str) -> DataFrame:
    """Listings already accepted: lines with status F."""
    return listings(spark, sf, "l_linestatus = 'F'")


def batch(spark: SparkSession, sf: str) -> DataFrame:
    """Listings that arrive: lines with status O."""
    return listings(spark, sf, "l_linestatus = 'O'")


def snapshot_new(spark: SparkSession, sf: str) -> DataFrame:
    """Listings of the next build: lines that were not returned."""
    return listings(spark, sf, "l_returnflag <> 'R'")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Asset log: one row per event, the event type is the status."""
    return read(spark, sf, "events").select(
        F.col("user_id").alias("asset"), F.col("event_type").alias("status"),
        F.col("ts").alias("at"), F.col("event_id").alias("ord"), F.col("value").alias("size"),
    )


_NOUN_SQL = {
    i: "CASE split_part(p_name,' ',2) " + " ".join(f"WHEN '{n}' THEN '{v[i]}'" for n, v in NOUNS.items()) + " END"
    for i in (0, 1)
}

_QUANTITY_SQL = """CASE p_type WHEN 'ECONOMY' THEN p_size||'mV' WHEN 'STANDARD' THEN '4V~'||p_size||'V'
 WHEN 'LARGE' THEN '3V;'||p_size||'V' WHEN 'MEDIUM' THEN '1.25V@'||p_size||'mA'
 WHEN 'PROMO' THEN p_size||'' ELSE 'Level '||p_size END"""


def _listing_sql(where: str) -> str:
    return f"""SELECT l_partkey*1000000+l_suppkey AS ord, upper(replace(p_name,' ','-'))||'-'||p_size AS mpn,
 s_name AS manufacturer, 'C'||l_partkey||'S'||l_suppkey AS supplier_reference, p_type AS category,
 p_name AS description, lines, qty, last_ship, p_brand AS brand
 FROM (SELECT l_partkey, l_suppkey, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS qty,
   CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_ship FROM lineitem WHERE {where} GROUP BY 1,2) g
 JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey"""


VIEWS = {
    "parts_v": f"""SELECT p_partkey AS ord, upper(replace(p_name,' ','-')) AS mpn, p_brand AS manufacturer,
 p_type AS category, 'C'||p_partkey AS cid, p_name AS description, {_NOUN_SQL[0]} AS parent_catalog,
 {_NOUN_SQL[1]} AS catalog_name, {_QUANTITY_SQL} AS quantity, p_size AS size, p_retailprice AS price FROM part""",
    "offers_v": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS ord,
 upper(replace(p_name,' ','-')) AS mpn,
 CASE l_returnflag WHEN 'A' THEN upper(p_brand) WHEN 'N' THEN ' '||lower(p_brand) ELSE p_brand END AS manufacturer,
 p_type AS category, CASE l_returnflag WHEN 'R' THEN '' ELSE p_name END AS description,
 CASE l_linestatus WHEN 'O' THEN 'stock '||p_type ELSE '' END AS availability, s_name AS source,
 l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity, l_extendedprice AS price,
 l_returnflag AS returnflag, l_linestatus AS linestatus, p_size AS size
 FROM lineitem JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey""",
    "alias_v": "SELECT DISTINCT lower(p_brand) AS raw, replace(upper(p_brand),'#','_') AS canonical FROM part",
    "master_v": _listing_sql("l_linestatus='F'"),
    "batch_v": _listing_sql("l_linestatus='O'"),
    "snap_v": _listing_sql("l_returnflag<>'R'"),
    "ledger_v": "SELECT user_id AS asset, event_type AS status, ts AS at, event_id AS ord, value AS size FROM events",
}


def sql(body: str, *views: str) -> str:
    """Prefix a query with the views it uses."""
    head = ", ".join(f"{v} AS ({VIEWS[v]})" for v in views)
    if not head:
        return body.strip()
    rest = body.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {head}, {rest[5:]}"
    return f"WITH {head} {rest}"
