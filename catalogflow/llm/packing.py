"""Documents packed into training sequences (bounded-space online best-fit).

Each task keeps a fixed number of open sequences. A bitset has a bit per amount of free space that
some open sequence has, so the tightest fit for a piece is the lowest set bit from its length up.
When a piece fits nowhere and no further sequence may open, the fullest one closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch, stored
from catalogflow.llm.tokens import encoder

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PLACED = _PIECES + ", sequence_id bigint, offset bigint"
_PLACED_ARROW = pa.schema([*_PIECES_ARROW, ("sequence_id", pa.int64()), ("offset", pa.int64())])


class OpenSequences:
    """Up to ``most`` sequences of ``size`` tokens that still take pieces."""

    def __init__(self, size: int, most: int):
        self._size, self._most, self._open, self._made = size, most, 0, 0
        self._free: list[list[int]] = [[] for _ in range(size + 1)]  # open sequences by free space
        self._bits = 0

    def _take(self, free: int) -> int:
        found = self._free[free]
        number = found.pop()
        if not found:
            self._bits &= ~(1 << free)
        self._open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fits = self._bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self._open == self._most:
                self._take((self._bits & -self._bits).bit_length() - 1)
            free, number = self._size, self._made
            self._made += 1
        left = free - length
        if left:
            self._free[left].append(number)
            self._bits |= 1 << left
            self._open += 1
        return number, self._size - free


def cut_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: the ids of a document and the id 0 after them, cut when longer than ``size``.

    The last pieces have ``size`` tokens, the first has what remains. Null and empty texts give
    one piece of one token. Repeated rows give repeated pieces.
    """

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode = encoder(vocabulary)
        for doc, words in rows:
            ids = encode.ids(words or "") + bytes(4)
            total = len(ids) // 4
            ends = range((total - 1) % size + 1, total + 1, size)
            start = 0
            for piece, end in enumerate(ends):
                yield doc, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])
                start = end

    return by_batch(docs.select(F.col(doc_id).cast("long"), text), _PIECES, _PIECES_ARROW, pieces)


def pack(pieces: DataFrame, size: int = 2048, most_open: int = 1024, rows_per_task: int = 32768) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence holds more than ``size`` tokens.

    Only the piece table is dealt out, by a hash of its rows, into tasks of about ``rows_per_task``
    pieces. Within a task the order is that of the hash, so a repeated task packs alike.
    """
    kept = stored(pieces, "pieces")
    tasks = max(1, -(-kept.count() // rows_per_task))
    order = F.xxhash64("doc_id", "piece", "length", "ids_crc32")

    def placed(rows: Iterator[tuple]) -> Iterator[tuple]:
        sequences = OpenSequences(size, most_open)
        first = TaskContext.get().partitionId() << 40
        for row in rows:
            number, offset = sequences.place(row[3])
            yield (*row, first + number, offset)

    dealt = kept.withColumn("_h", order).repartition(tasks, "_h").sortWithinPartitions("_h", "doc_id", "piece", "start").drop("_h")
    return by_batch(dealt, _PLACED, _PLACED_ARROW, placed)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2048, vocabulary: str | None = None) -> DataFrame:
    return pack(cut_documents(docs, doc_id, text, size, vocabulary), size)


def packed_ids(docs: DataFrame, placed: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The sequences themselves: (sequence_id, ids), for placed pieces of documents with unique ids.

    Tokens are encoded again, which costs less than shuffling all ids twice. A sequence is bounded
    by its size, so gathering its pieces is too.
    """

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array, starts: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for t, a, n in zip(texts, starts, lengths):
            ids = np.frombuffer(encoder(vocabulary).ids(t.as_py() or "") + bytes(4), "<u4")
            out.append(ids[a.as_py() : a.as_py() + n.as_py()].astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    parts = placed.join(whole, "doc_id").select("sequence_id", "offset", ids_of("_text", "start", "length").alias("ids"))
    gathered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten("parts.ids").alias("ids"))
