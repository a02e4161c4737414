"""Operators for SQL users, as table functions with a TABLE argument.

    register(spark)
    SELECT * FROM error_streaks(TABLE(SELECT asset AS key, ord AS at, status AS kind FROM log) PARTITION BY key ORDER BY (at), 'error,view', 2)

A call gets the rows of a key in order and holds a few values, not the rows, so its memory does not grow with the key. One key is read
by one task; where a key may have a large part of all rows, the DataFrame operators of the same name deal it over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.types import IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def _column(table: AnalyzeArgument, name: str):
    if table.isTable is False or name not in table.dataType.fieldNames():
        raise ValueError(f"the table argument needs a column {name}")
    return table.dataType[name].dataType


class ErrorStreaks:
    """(key, kind, length, from_at, to_at) of runs of at least ``threshold`` rows of one of the comma-separated ``kinds``; other rows end a run."""

    @staticmethod
    def analyze(log: AnalyzeArgument, kinds: AnalyzeArgument, threshold: AnalyzeArgument) -> AnalyzeResult:
        at = _column(log, "at")
        _column(log, "kind")
        return AnalyzeResult(StructType().add("key", _column(log, "key")).add("kind", StringType()).add("length", LongType()).add("from_at", at).add("to_at", at))

    def __init__(self) -> None:
        self._key = self._kind = self._from = self._to = None
        self._n, self._least = 0, 1

    def _run(self) -> Iterator[tuple]:
        if self._kind is not None and self._n >= self._least:
            yield self._key, self._kind, self._n, self._from, self._to

    def eval(self, log: Row, kinds: str, threshold: int) -> Iterator[tuple]:
        kind = log["kind"] if log["kind"] is not None and log["kind"] in kinds.split(",") else None
        self._least = threshold
        if kind is None or kind != self._kind:
            yield from self._run()
            self._key, self._kind, self._from, self._n = log["key"], kind, log["at"], 0
        self._n, self._to = self._n + 1, log["at"]

    def terminate(self) -> Iterator[tuple]:
        yield from self._run()


class CarryParent:
    """W9 within a key: (key, id, level, l1_id, l2_id); each row with the last level-1 and level-2 node so far, a level-1 node resets level 2."""

    @staticmethod
    def analyze(nodes: AnalyzeArgument) -> AnalyzeResult:
        node = _column(nodes, "id")
        _column(nodes, "level")
        return AnalyzeResult(StructType().add("key", _column(nodes, "key")).add("id", node).add("level", IntegerType()).add("l1_id", node).add("l2_id", node))

    def __init__(self) -> None:
        self._first = self._second = None

    def eval(self, nodes: Row) -> Iterator[tuple]:
        if nodes["level"] == 1:
            self._first, self._second = nodes["id"], None
        elif nodes["level"] == 2:
            self._second = nodes["id"]
        yield nodes["key"], nodes["id"], nodes["level"], self._first, self._second


FUNCTIONS = {"error_streaks": ErrorStreaks, "carry_parent": CarryParent}


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL of this session."""
    from pyspark.sql.functions import udtf

    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, udtf(function))
