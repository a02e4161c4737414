"""Documents ranked for each item by their common terms (Aho-Corasick document scan).

The terms of all items form one automaton, which every task builds from a list of bounded size. A document is
brought to its terms with one space around each, so that a term between two spaces is matched as a whole and
nowhere inside a longer one. One scan of the texts counts the documents of each term; a second one counts the occurrences again,
follows each term to its items and adds up scores. No index of the documents is kept, and no text leaves its task: a task
hands on the best rows of each item only, so a shuffle has no more of them than tasks times items times rows wanted.

Items are dealt into blocks by hash so that the terms of a block have a bounded size; each block has scans of its own.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch, stored

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TO_LOWER = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))
_BLOCK_BYTES = 16 << 20  # of the terms of a block of items, each counted with 16 bytes more
_EXACT = 1 << 53  # sums below are exact in doubles
_HELD = 1 << 16  # rows that a task holds beyond the best ones before it sorts them out
_SALTS = 64
_NO_ID = -(1 << 63)


def guarded(text: str | None) -> bytes:
    """The terms of a text with a space before and after each, A-Z in lower case."""
    return b" " + (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER) + b" "


def number_of_terms(raw: bytes) -> int:
    term = np.frombuffer(raw, np.uint8) != 32
    return int(np.count_nonzero(term[1:] & ~term[:-1]))


@functools.lru_cache(maxsize=2)
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """Numbers of terms by their bytes between two spaces."""
    built = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        built.add_word(guarded(term).decode("latin-1"), number)
    built.make_automaton()
    return built


def term_counts(raw: bytes, automaton: ahocorasick.Automaton) -> Counter:
    """Occurrences of each term of the automaton in a guarded text."""
    return Counter(map(itemgetter(1), automaton.iter(raw.decode("latin-1"))))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, block): the distinct terms of each item; the rows of one id are one item."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pairs = stored(items.select(F.coalesce(F.col(item_id).cast("long"), F.lit(_NO_ID)).alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(_TERM), 0)).alias("term")).distinct(), "terms")
    held = pairs.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-2 * held // _BLOCK_BYTES) if held > _BLOCK_BYTES else 1
    return pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))


_COUNTS = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_BEST = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _frequencies(docs: DataFrame, terms: tuple[str, ...]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents of each of ``terms``."""

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        automaton, of_term, held, every = _automaton(terms), np.zeros(len(terms), np.int64), 0, 0
        for (text,) in rows:
            raw = guarded(text)
            n = number_of_terms(raw)
            held, every = held + (n > 0), every + n
            found = term_counts(raw, automaton)
            of_term[np.fromiter(found, np.int64, len(found))] += 1
        yield from [(-1, held), (-2, every)]
        for at in np.flatnonzero(of_term).tolist():
            yield at, int(of_term[at])

    counts = by_batch(docs.select("text"), "key long, n long", _COUNTS, count).groupBy("key").agg(F.sum("n").alias("n"))
    found = {r["key"]: r["n"] for r in counts.collect()}  # one number for each term of the block
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(i, 0) for i in range(len(terms))], np.int64)


class _Best:
    """The rows of a task that can be among the ``top`` of their item."""

    def __init__(self, items: int, top: int):
        self._top, self._least = top, np.ones(items, np.int64)
        self._kept, self._new, self._n = np.zeros((3, 0), np.int64), [], 0

    def add(self, doc: int, scores: np.ndarray) -> None:
        hit = np.flatnonzero(scores >= self._least)
        if len(hit):
            self._new.append(np.stack([hit, np.full(len(hit), doc, np.int64), scores[hit]]))
            self._n += len(hit)
            if self._n > _HELD + self._kept.shape[1]:
                self.rows()

    def rows(self) -> np.ndarray:
        """Items, documents and scores, of each item the ``top`` best."""
        all_ = np.concatenate([self._kept, *self._new], axis=1)
        item, doc, score = all_[:, np.lexsort((all_[1], -all_[2], all_[0]))]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self._top - 1
        self._least[item[last]] = score[last]
        self._kept, self._new, self._n = np.stack([item, doc, score])[:, place < self._top], [], 0
        return self._kept


def _block_scores(docs: DataFrame, pairs: list[tuple[int, str]], top: int) -> DataFrame:
    """(item_id, doc_id, score): of each item the best rows of each task."""
    terms, ids = tuple(sorted({t for _, t in pairs})), sorted({i for i, _ in pairs})
    number, place = {t: k for k, t in enumerate(terms)}, {i: k for k, i in enumerate(ids)}
    holders = np.array(sorted((number[t], place[i]) for i, t in pairs), np.int64).reshape(-1, 2)
    first, item = np.searchsorted(holders[:, 0], np.arange(len(terms) + 1)), np.ascontiguousarray(holders[:, 1])
    n_docs, all_terms, df = _frequencies(docs, terms)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def scores(m: int, found: Counter) -> np.ndarray:
        at, tf = np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
        part = weight[at] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        width = first[at + 1] - first[at]
        held = item[np.repeat(first[at] - (np.cumsum(width) - width), width) + np.arange(width.sum())]
        if int(part.sum()) < _EXACT:
            return np.bincount(held, np.repeat(part, width), len(ids)).astype(np.int64)
        total = np.zeros(len(ids), np.int64)
        np.add.at(total, held, np.repeat(part, width))
        return total

    def rank(rows: Iterator[tuple]) -> Iterator[tuple]:
        automaton, best = _automaton(terms), _Best(len(ids), top)
        for doc, text in rows:
            raw = guarded(text)
            found = term_counts(raw, automaton)
            if found:
                best.add(doc, scores(50 + 50 * number_of_terms(raw) * n_docs // all_terms, found))
        for i, doc, score in best.rows().T.tolist():
            yield ids[i], doc, score

    return by_batch(docs, "item_id long, doc_id long, score long", _BEST, rank)


def rank_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item the ``top`` documents with the highest scores above 0, equal scores by ascending id.

    Null and empty texts have no terms; an item without terms has no row. Rows of one item id are one item with the terms of
    all; repeated rows of ``docs`` are documents of their own and each takes a rank. A null document id comes before all others.
    """
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    pairs = item_terms(items, item_id, item_text)
    found = None
    for block in [r["block"] for r in pairs.select("block").distinct().orderBy("block").collect()]:
        # a block has at most about _BLOCK_BYTES of terms
        own = [(r["item_id"], r["term"]) for r in pairs.where(F.col("block") == block).select("item_id", "term").collect()]
        rows = stored(_block_scores(texts, own, top), "scores")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return pairs.selectExpr("item_id", "0 AS rank", "item_id AS doc_id", "0L AS score")
    by = (F.desc("score"), F.asc("doc_id"))
    # two steps, so that the rows of an item from very many tasks do not meet in one
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*by))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*by))).where(F.col("rank") <= top)
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return ranked.select(real("item_id"), "rank", real("doc_id"), "score")
