"""Operators over status logs (W11, W13, T3 in batch form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.operators.ordering import global_rank

# Batch states and the states each may change to.
TRANSITIONS = {
    "INTAKE": ("QUALIFICATION", "FAILED"), "QUALIFICATION": ("DEDUP", "FAILED"), "DEDUP": ("BACKUP", "FAILED"),
    "BACKUP": ("PROCESSING", "FAILED"), "PROCESSING": ("BUILT", "FAILED"), "BUILT": ("AUDITED", "FAILED"),
    "AUDITED": ("READY_FOR_RELEASE", "FAILED"), "READY_FOR_RELEASE": ("APPROVED", "FAILED"),
    "APPROVED": ("DEPLOYED", "FAILED"), "DEPLOYED": (), "FAILED": ("INTAKE",),
}
# Consecutive errors of a kind that open the breaker.
STREAK_LIMITS = {"429": 2, "5xx": 5}


def previous_in_key(log: DataFrame, key: str, order: Sequence[str], col: str, name: str) -> DataFrame:
    """The value of ``col`` in the row before, within the key, however long the key's log is.

    Rows get a global position by (key, order); the row before is the one at position - 1,
    found by an equality join, so one busy key is shared by many tasks.
    """
    ranked = global_rank(log, [key, *order], "_r")
    prev = ranked.select((F.col("_r") + 1).alias("_r"), F.col(key).alias("_pk"), F.col(col).alias(name))
    joined = ranked.join(prev, "_r", "left")
    return joined.withColumn(name, F.when(F.col("_pk") == F.col(key), F.col(name))).drop("_pk", "_r")


def validate_transitions(log: DataFrame, key: str, order: Sequence[str], status: str, allowed: dict[str, Sequence[str]] = TRANSITIONS) -> DataFrame:
    """Status changes that are not allowed (before, after)."""
    pairs = [f"{a}>{b}" for a, bs in allowed.items() for b in bs]
    stepped = previous_in_key(log, key, order, status, "before")
    changed = stepped.where(F.col("before").isNotNull() & (F.col("before") != F.col(status)))
    return changed.where(~F.concat_ws(">", "before", status).isin(*pairs)) if pairs else changed


def current_status(log: DataFrame, key: str, order: Sequence[str], status: str) -> DataFrame:
    """Latest status per key."""
    return log.groupBy(key).agg(F.max_by(status, F.struct(*order)).alias(status))


def ready_list(log: DataFrame, key: str, order: Sequence[str], status: str, state: str = "READY_FOR_RELEASE") -> DataFrame:
    """Keys that wait in ``state``."""
    return current_status(log, key, order, status).where(F.col(status) == state).select(key)


def status_class(code: Column) -> Column:
    """Error class of an HTTP status: 429, 5xx, hard block, ok or other."""
    c = code.cast("int")
    return F.when(c == 429, "429").when((c >= 500) & (c <= 599), "5xx").when(c == 403, "403").when((c >= 200) & (c <= 299), "ok").otherwise("other")


def error_streaks(log: DataFrame, key: str, order: Sequence[str], kind: str, errors: Sequence[str], threshold: int) -> DataFrame:
    """Runs of at least ``threshold`` consecutive rows of one error kind; others reset.

    Gaps and islands on global positions: inside a run, position minus the number of rows of
    the same kind before it is constant. Runs come out of an aggregation by that difference.
    """
    ranked = global_rank(log, [key, *order], "_r")
    per_kind = global_rank(ranked.where(F.col(kind).isin(*errors)), [key, kind, "_r"], "_k")
    first = per_kind.groupBy(key, kind).agg(F.min("_k").alias("_k0"))
    runs = per_kind.join(first, [key, kind]).withColumn("_island", F.col("_r") - (F.col("_k") - F.col("_k0")))
    return runs.groupBy(key, kind, "_island").agg(
        F.count(F.lit(1)).alias("length"), F.min("_r").alias("_from"), *[F.min(o).alias(f"from_{o}") for o in order],
        *[F.max(o).alias(f"to_{o}") for o in order]).where(F.col("length") >= threshold).drop("_island", "_from")


def ledger_latest(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row per key."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(key, "x.*")


def outcome_counts(log: DataFrame, ts: str, status: str, width: str = "1 hour") -> DataFrame:
    """T2 in batch form: outcomes per time bucket."""
    return log.groupBy(F.window(ts, width).alias("w"), F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("bucket"), "status", "n")
