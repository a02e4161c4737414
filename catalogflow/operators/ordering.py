"""Operators that depend on input order (W1, W2, W6, W7r, W8, W12-W15, O8).

Spark rows have no order, so each operator takes an explicit order column (``ord``),
unique per row. Ranks over large data never run in a window without a partition key
and never put one large group into one task: rows are range partitioned on the full
sort key, so even a group that holds a third of all rows spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.keys import KEY_MODES, text
from catalogflow.session import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in the low 33 bits


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def global_rank(df: DataFrame, order: Sequence, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """W7r: 1-based position of every row in the order of ``order``.

    ``order`` must identify a row (end it with ``ord``), which also makes the range
    partitions even when a leading column repeats. The sorted rows are checkpointed once,
    so positions cannot move when a lost executor makes Spark compute a partition again.
    Only one row per partition goes into the running total. Without ``partitions`` Spark sizes
    the ranges from the data at run time.
    """
    cols = [_c(o) for o in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    placed = cut(
        ranged.sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    pid = F.shiftrightunsigned(F.col("_mid"), _ROW_BITS)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(pid.alias("_pid"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row per partition: its size is bound by spark.sql.shuffle.partitions
    return (
        placed.withColumn("_pid", pid)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, row + F.col("_off") + 1)
        .drop("_mid", "_pid", "_off")
    )


def grouped_rank(
    df: DataFrame, group: Sequence[str], order: Sequence, name: str = "rank", size: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """1-based position inside each group, and the group size if ``size`` names a column.

    The position is the global position less the first global position of the group,
    so the sort work of a large group is shared by many tasks.
    """
    ranked = global_rank(df, [*group, *order], "_g", partitions)
    first = ranked.groupBy(*group).agg(F.min("_g").alias("_gfirst"), F.count(F.lit(1)).alias("_gsize"))
    joined = _null_safe_join(ranked, first, group)
    out = joined.withColumn(name, F.col("_g") - F.col("_gfirst") + 1)
    if size:
        out = out.withColumn(size, F.col("_gsize"))
    return out.drop("_g", "_gfirst", "_gsize")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right
    cond = F.lit(True)
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"_j{i}")
        cond = cond & left[k].eqNullSafe(F.col(f"_j{i}"))
    return left.join(renamed, cond, how).drop(*[f"_j{i}" for i in range(len(keys))])


# ---- first and last per key ---------------------------------------------------

def _pick(df: DataFrame, keys: Sequence, order: Column) -> DataFrame:
    # row_number() = 1 is cut down to one row per key inside every map task
    # (WindowGroupLimit) before the shuffle, so a repeated key costs nothing extra.
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_order(df: DataFrame, ord: str = "ord") -> DataFrame:
    """``df`` with an order column: where the caller has none, the content of the rows, so that the pick is at least always the same."""
    return df if ord in df.columns else df.withColumn(ord, F.to_json(F.struct(*df.columns)))


def first_occurrence(df: DataFrame, keys: Sequence, ord: str = "ord") -> DataFrame:
    """The first row of every key."""
    return _pick(df, keys, F.col(ord).asc())


def last_occurrence(df: DataFrame, keys: Sequence, ord: str = "ord") -> DataFrame:
    """The last row of every key, as a dict overwrite would leave it."""
    return _pick(df, keys, F.col(ord).desc())


def repeat_count(df: DataFrame, keys: Sequence) -> DataFrame:
    """One row: how many rows ``first_occurrence`` leaves out."""
    per_key = df.groupBy(*[_c(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"))


def flag_repeats(df: DataFrame, keys: Sequence[str], ord: str = "ord", name: str = "is_repeat") -> DataFrame:
    """Keep every row and mark all but the first of its key."""
    first = df.groupBy(*keys).agg(F.min(ord).alias("_first"))
    return _null_safe_join(df, first, keys).withColumn(name, F.col(ord) != F.col("_first")).drop("_first")


# ---- top rows per group -------------------------------------------------------

def top_per_group(df: DataFrame, group: Sequence, order: Sequence, k: int, name: str = "pos") -> DataFrame:
    """First ``k`` rows of each group for a small fixed ``k`` (a report feature).

    Spark pre-cuts each map task to ``k`` rows per group before the shuffle.
    """
    w = Window.partitionBy(*[_c(g) for g in group]).orderBy(*[_c(o) for o in order])
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def cap_per_group(
    df: DataFrame, group: str, caps: dict[str, int], ord: str = "ord", default: int | None = None,
    total: int | None = None, order: Sequence | None = None,
) -> DataFrame:
    """At most ``caps[group]`` rows per group in order, groups without a cap skipped
    (or held to ``default``), then at most ``total`` rows overall.

    ``order`` puts richer rows first; the overall cut follows it too.
    """
    by = list(order) if order else [ord]
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])[F.col(group)] if caps else F.lit(None)
    cap = F.coalesce(cap, F.lit(default)).cast("long")
    out = (
        grouped_rank(df.withColumn("_cap", cap).where("_cap is not null"), [group], by, "_pos")
        .where("_pos <= _cap")
        .drop("_cap", "_pos")
    )
    if total is None:
        return out
    return global_rank(out, by, "_r").where(F.col("_r") <= total).drop("_r")


def streamed_limit(df: DataFrame, keys: Sequence, n: int, ord: str = "ord") -> DataFrame:
    """The first ``n`` rows that survive de-duplication, in input order."""
    kept = first_occurrence(df, keys, ord)
    return global_rank(kept, [ord], "_r").where(F.col("_r") <= n).drop("_r")


# ---- numbered pieces ----------------------------------------------------------

def plan_slices(df: DataFrame, size: int = 500, order: Sequence = ("ord",), wave: str = "wave") -> DataFrame:
    """1-based slice number and slice id for fixed-size slices."""
    ranked = global_rank(df, order, "_r")
    idx = F.floor((F.col("_r") - 1) / F.lit(size)).cast("long") + 1
    return (
        ranked.withColumn("slice_idx", idx)
        .withColumn("slice_id", F.format_string(wave + "_%04d", F.col("slice_idx")))
        .drop("_r")
    )


def slice_manifest(sliced: DataFrame, key: str = "mpn") -> DataFrame:
    """One row per slice: how many rows, first and last key."""
    return sliced.groupBy("slice_idx", "slice_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )


def paginate(df: DataFrame, group: Sequence[str], order: Sequence, size: int = 50) -> DataFrame:
    """Page number, page count, previous and next page for each row of a group."""
    ranked = grouped_rank(df, group, order, "_pos", "_total")
    pages = F.ceil(F.col("_total") / F.lit(size)).cast("long")
    page = F.floor((F.col("_pos") - 1) / F.lit(size)).cast("long") + 1
    return (
        ranked.withColumn("page", page)
        .withColumn("pages", pages)
        .withColumn("prev_page", F.when(F.col("page") > 1, F.col("page") - 1))
        .withColumn("next_page", F.when(F.col("page") < F.col("pages"), F.col("page") + 1))
        .withColumn("pos_on_page", (F.col("_pos") - 1) % size + 1)
        .drop("_pos", "_total")
    )


def clamp_page(page: Column, pages: Column) -> Column:
    """Requested page forced into 1..pages."""
    return F.least(F.greatest(page, F.lit(1)), F.greatest(pages, F.lit(1)))


# ---- samples ------------------------------------------------------------------

def _draw(key: str, seed: int) -> Column:
    """A number per key that any engine works out alike."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)


def spot_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The same ``n`` rows on every run, spread over the data (a sampling operator)."""
    h = _draw(key, seed)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def stratified_sample(df: DataFrame, by: Sequence[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` repeatable rows per stratum."""
    h = _draw(key, seed)
    return top_per_group(df, by, [h, F.col(key)], n, "_pos").drop("_pos")


def first_reports(df: DataFrame, by: Sequence[str], value: str, n: int) -> DataFrame:
    """The first ``n`` offenders of each kind in one list, with the full count."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    heads = (
        top_per_group(df.select(*by, value).distinct(), by, [value], n)
        .groupBy(*by)
        .agg(F.array_join(F.sort_array(F.collect_list(value)), ", ").alias("examples"))
    )
    return counts.join(heads, list(by))


# ---- logs ---------------------------------------------------------------------

def carry_parent(df: DataFrame, ord: str = "ord", level: str = "level", id: str = "id") -> DataFrame:
    """Stamp the last seen level-1 and level-2 node on the rows that follow; a level-1 node
    resets level 2.

    No window runs over the whole table: rows get a global position and fall into buckets of
    4,096; inside a bucket a running maximum finds the ancestor, and the last ancestor of each
    bucket is carried to the buckets after it.
    """
    ranked = global_rank(df, [ord], "_r")
    size = 4096
    ranked = ranked.withColumn("_b", F.floor((F.col("_r") - 1) / F.lit(size)).cast("long"))
    in_bucket = Window.partitionBy("_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    l1 = F.when(F.col(level) == 1, F.struct(F.col("_r").alias("r"), F.col(id).alias("id")))
    l2 = F.when(F.col(level) == 2, F.struct(F.col("_r").alias("r"), F.col(id).alias("id")))
    local = ranked.withColumn("_p1", F.max(l1).over(in_bucket)).withColumn("_p2", F.max(l2).over(in_bucket))
    ends = local.groupBy("_b").agg(F.max("_p1").alias("_e1"), F.max("_p2").alias("_e2"))
    carried = _carry_ends(ends)
    out = local.join(carried, "_b", "left")
    p1 = F.coalesce(F.col("_p1"), F.col("_c1"))
    p2 = F.coalesce(F.col("_p2"), F.col("_c2"))
    valid2 = F.when(p2["r"] > F.coalesce(p1["r"], F.lit(0)), p2["id"])
    return out.withColumn("l1_id", p1["id"]).withColumn("l2_id", valid2).drop("_r", "_b", "_p1", "_p2", "_c1", "_c2")


def _carry_ends(ends: DataFrame) -> DataFrame:
    """Greatest ancestor before each bucket, in two steps: within blocks of buckets, then over blocks."""
    block = 4096
    e = ends.withColumn("_blk", F.floor(F.col("_b") / F.lit(block)).cast("long"))
    prev = Window.partitionBy("_blk").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("_i1", F.max("_e1").over(prev)).withColumn("_i2", F.max("_e2").over(prev))
    # one row per 16.7 million input rows: small enough for a single window task
    tops = e.groupBy("_blk").agg(F.max("_e1").alias("_t1"), F.max("_e2").alias("_t2"))
    over = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_blk", F.max("_t1").over(over).alias("_o1"), F.max("_t2").over(over).alias("_o2"))
    return e.join(tops, "_blk").select(
        "_b",
        F.coalesce(F.col("_i1"), F.col("_o1")).alias("_c1"),
        F.coalesce(F.col("_i2"), F.col("_o2")).alias("_c2"),
    )


def skip_taken(rows: DataFrame, taken: DataFrame, key: str, rank: str, number: str, first: int, name: str) -> DataFrame:
    """The ``rank``-th number from ``first`` on that is not ``taken`` under the same key.

    ``rows`` have ranks 1, 2, … per key, ``taken`` distinct numbers of at least ``first``. Before the i-th taken number
    lie ``number - first - (i - 1)`` free ones, so the rows that pass it are those of a higher rank: both are
    put on one line per key and ranked together, which spreads a key with very many of either over many tasks.
    """
    placed = grouped_rank(taken, [key], [number], "_i").select(key, (F.col(number) - first - F.col("_i") + 2).alias("_at"), F.lit(0).alias("_kind"), F.col(number).alias("_tie"))
    line = placed.unionByName(rows.select(key, F.col(rank).cast("long").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_tie")))
    passed = grouped_rank(line, [key], ["_at", "_kind", "_tie"], "_r").where("_kind = 1").select(key, F.col("_at").alias(rank), (F.col("_r") + first - 1).alias(name))
    return rows.join(passed, [key, rank])


def unique_seo_slugs(df: DataFrame, base: str = "base", id: str = "id", ord: str = "ord") -> DataFrame:
    """The first use keeps the base, later uses append their id; an id used again under
    the same base takes the next counter from 3 on, past numbers that are ids of that base."""
    ranked = grouped_rank(df, [base], [ord], "_n")
    later = grouped_rank(ranked.where("_n > 1"), [base, id], [ord], "_m")
    counted = grouped_rank(later.where("_m > 1"), [base], [ord], "_k", "_repeats")
    number = F.col(id).cast("string").try_cast("long")
    taken = later.where("_m = 1").join(counted.select(base).distinct(), base, "left_semi").select(F.col(base), number.alias("_id")).where("_id >= 3")
    counted = skip_taken(counted, taken, base, "_k", "_id", 3, "_counter")
    with_id = F.concat_ws("-", F.col(base), F.col(id).cast("string"))
    parts = [
        ranked.where("_n = 1").withColumn("seo_slug", F.col(base)),
        later.where("_m = 1").withColumn("seo_slug", with_id).drop("_m"),
        counted.withColumn("seo_slug", F.concat_ws("-", F.col(base), F.col("_counter").cast("string"))).drop("_m", "_k", "_repeats", "_counter"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("_n")


def normalised_key(df: DataFrame, col: str, mode: str, name: str = "_key") -> DataFrame:
    return df.withColumn(name, KEY_MODES[mode](text(col)))
