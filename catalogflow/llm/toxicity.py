"""Toxic text (convolutional classifier over hashed word embeddings).

The embedding of a word is the sum of rows of one hashed table: the row of the word and those of its
first three to six letters, so unseen forms of a known stem are recognised. Filters of several widths
run over the words, the largest answer of each filter over the whole text is kept, and a linear layer
turns those into a logit. All of it is trained in numpy on a bounded sample of labelled rows; the
threshold of each language is set on rows that the training left out. The language is told from the
common words of the text itself, so no other column bears on a score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.common import given_back, stored

WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
DIM = 8
ROWS = 1 << 16  # of the embedding table; row 0 stands for nothing
PARTS = 5  # table rows that make up a word
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»…“”‘’„"

# Common words by language.
_COMMON = {
    "en": "the and of to that is was for with are this it from not be by on or as in".split(),
    "de": "der die das und ist nicht den von mit sich ein eine dem für auf auch im zu".split(),
    "fr": "le les et des une est pas que dans pour sur qui au avec du aux ce il".split(),
    "es": "el los las y que una por para con del se no su al lo como es más".split(),
}
LANGS = (*_COMMON, "other")
_LANG_OF = {w: i for i, words in enumerate(_COMMON.values()) for w in words if sum(w in x for x in _COMMON.values()) == 1}


def word_rows(word: str) -> tuple[int, ...]:
    """Table rows of a word: itself and its first letters; 0 fills up."""
    core = word.lower().strip(_EDGES)
    if not core:
        return (0,) * PARTS
    hashed = lambda s: 1 + zlib.crc32(s.encode("utf-8", "surrogatepass")) % (ROWS - 1)
    return (hashed("=" + core), *(hashed(core[:k]) if len(core) >= k else 0 for k in (3, 4, 5, 6)))


class Words:
    """Numbers the words that it meets, with the table rows and the language of each; bounded."""

    def __init__(self, limit: int = 200_000):
        self._limit = limit
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows = np.zeros((1024, PARTS), np.int32)
        self.langs = np.zeros(1024, np.int8)

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        known = self.number
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > self._limit:
                self._clear()
                known, new = self.number, list(set(words))
            first = len(known)
            while first + len(new) > len(self.langs):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.langs = np.concatenate([self.langs, np.zeros_like(self.langs)])
            self.rows[first : first + len(new)] = [word_rows(w) for w in new]
            self.langs[first : first + len(new)] = [_LANG_OF.get(w.lower().strip(_EDGES), len(_COMMON)) for w in new]
            known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def language(self, numbers: np.ndarray) -> int:
        votes = np.bincount(self.langs[numbers], minlength=len(LANGS))[:-1]
        return int(np.argmax(votes)) if votes.any() else len(LANGS) - 1


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: list[float] = field(default_factory=lambda: [0.0] * len(LANGS))
    scale: float = 1.0

    def logit(self, rows: np.ndarray) -> float:
        """Of one text, given the table rows of its words."""
        pad = max(WIDTHS) - 1
        x = np.zeros((len(rows) + 2 * pad, DIM), np.float32)
        x[pad : pad + len(rows)] = self.table[rows].sum(1)
        return float(self._pooled(x)[0] @ self.out + self.out_bias)

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        best, where = [], []
        for k, f in zip(WIDTHS, self.filters):
            n = len(x) - k + 1
            z = sum(x[j : j + n] @ f[j] for j in range(k))
            at = z.argmax(0)
            where.append(at)
            best.append(z[at, np.arange(FILTERS)])
        return np.maximum(np.concatenate(best) + self.bias, 0), where

    def score(self, logit: float, lang: int) -> float:
        """0.5 at the threshold of the language."""
        z = np.clip(self.scale * (logit - self.thresholds[lang]), -30, 30)
        return float(1 / (1 + np.exp(-z)))


def _initial(texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator, least_texts: int) -> Model:
    """Random weights but for the first dimension, which starts as the log odds of each table row; rare rows stay zero."""
    seen = np.zeros((2, ROWS))
    for rows, y in zip(texts, labels):
        seen[int(y), np.unique(rows)] += 1
    table = rng.normal(0, 0.02, (ROWS, DIM)).astype(np.float32)
    share = (seen + 0.5) / (np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]]) + 1)
    table[:, 0] = np.clip(np.log(share[1] / share[0]), -1, 6) * 0.3
    table[seen.sum(0) < least_texts] = 0
    table[0] = 0
    filters = [rng.normal(0, 0.1, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] += 0.5
    size = len(WIDTHS) * FILTERS
    return Model(table, filters, np.zeros(size, np.float32), rng.normal(0.2, 0.05, size).astype(np.float32), -1.0)


def fit(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 6, rate: float = 0.02, decay: float = 1e-4, least_texts: int = 3, seed: int = 7) -> Model:
    """Train on texts given as table rows of their words, by adaptive gradient steps on one text at a time.

    A step touches only the windows that won the pooling, so it costs one pass over the text.
    """
    rng = np.random.default_rng(seed)
    model = _initial(texts, labels, rng, least_texts)
    used = model.table.any(1)
    pad = max(WIDTHS) - 1
    sums = {name: np.full_like(v, 1e-2) for name, v in (("table", model.table), ("bias", model.bias), ("out", model.out))}
    filter_sums, out_bias_sum = [np.full_like(f, 1e-2) for f in model.filters], 1e-2
    weight = {1: min(4.0, 0.5 / max(labels.mean(), 1e-3)), 0: 1.0}
    for _ in range(epochs):
        for t in rng.permutation(len(texts)):
            rows = texts[t]
            x = np.zeros((len(rows) + 2 * pad, DIM), np.float32)
            x[pad : pad + len(rows)] = model.table[rows].sum(1)
            pooled, where = model._pooled(x)
            z = float(pooled @ model.out + model.out_bias)
            y = int(labels[t])
            slope = weight[y] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            if abs(slope) < 1e-3:
                continue
            back = slope * model.out * (pooled > 0)
            step = slope * pooled + decay * model.out
            sums["out"] += step**2
            model.out -= rate * step / np.sqrt(sums["out"])
            out_bias_sum += slope**2
            model.out_bias -= rate * slope / out_bias_sum**0.5
            sums["bias"] += back**2
            model.bias -= rate * back / np.sqrt(sums["bias"])
            dx: dict[int, np.ndarray] = {}
            for w, (k, f) in enumerate(zip(WIDTHS, model.filters)):
                g = back[w * FILTERS : (w + 1) * FILTERS]
                df = np.empty_like(f)
                for j in range(k):
                    df[j] = x[where[w] + j].T * g
                    for c in np.flatnonzero(g):
                        at = int(where[w][c]) + j - pad
                        if 0 <= at < len(rows):
                            dx[at] = dx.get(at, 0) + f[j, :, c] * g[c]
                df += decay * f
                filter_sums[w] += df**2
                f -= rate * df / np.sqrt(filter_sums[w])
            for at, d in dx.items():
                for r in rows[at]:
                    if used[r]:
                        sums["table"][r] += d**2
                        model.table[r] -= rate * d / np.sqrt(sums["table"][r])
    return model


def _best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The bound with fewest errors, in the middle of the gap between the logits it parts."""
    order = np.argsort(logits)
    z, y = logits[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    cut = best[len(best) // 2]
    low, high = z[cut - 1] if cut else z[0] - 2, z[cut] if cut < len(z) else z[-1] + 2
    return float((low + high) / 2)


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, langs: np.ndarray, least: int = 15) -> None:
    """Threshold per language; a language with fewer than ``least`` rows of either label gets the common one."""
    both = 0 < labels.sum() < len(labels)
    common = _best_threshold(logits, labels) if both else 0.0
    for lang in range(len(LANGS)):
        own = langs == lang
        enough = min(labels[own].sum(), (1 - labels[own]).sum()) >= least
        model.thresholds[lang] = _best_threshold(logits[own], labels[own]) if enough else common


def in_fold(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most_rows: int, most_words: int) -> DataFrame:
    """(fold, label, words' table rows) of up to ``most_rows`` labelled documents and ``most_words`` words, both bounds documented.

    Up to a third of the sample has label 1. Rows are chosen by a hash of their id. The ids of
    the sample are at most ``most_rows``, which is what makes them fit to broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & (in_fold(doc_id) != 0)).groupBy(doc_id).agg(F.max(label).cast("int").alias("_y"))
    ranked = known.withColumn("_h", F.xxhash64(doc_id)).orderBy("_h", doc_id)
    sample = ranked.where("_y = 1").limit(most_rows // 3).unionByName(ranked.where("_y = 0").limit(most_rows - most_rows // 3))
    sample = stored(sample.select(F.col(doc_id).alias("_id"), "_y", "_h"), "sample")

    @F.arrow_udf(T.BinaryType())
    def rows_of(texts: pa.Array) -> pa.Array:
        words, out = _words(), []
        for t in texts:
            numbers = words.of(t.as_py() or "")
            out.append(words.rows[numbers].tobytes())
        return given_back(pa.array(out, pa.binary()))

    met = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    found = stored(met.select("_h", "_id", "_y", in_fold("_id").alias("fold"), rows_of("_text").alias("rows")), "sample")
    # a window over the sample alone, which is bounded
    so_far = Window.orderBy("_h", "_id", "rows").rowsBetween(Window.unboundedPreceding, 0)
    return found.withColumn("_n", F.sum(F.length("rows") / (4 * PARTS)).over(so_far)).where(F.col("_n") <= most_words).orderBy("_h", "_id", "rows").select("fold", F.col("_y").alias("label"), "rows")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = 6000, most_words: int = 4_000_000) -> Model:
    """A calibrated model from the labelled rows outside fold 0.

    Fold 1 sets the thresholds, folds 2 to 4 train. Without any usable label every score is 0.5 at a logit of 0,
    and nothing is toxic.
    """
    sample = training_sample(docs, labels, doc_id, text, label, most_rows, most_words).collect()
    texts = [np.frombuffer(r["rows"], np.int32).reshape(-1, PARTS) for r in sample]
    y, fold = np.array([r["label"] for r in sample], int), np.array([r["fold"] for r in sample], int)
    learn = np.flatnonzero(fold != 1) if len(set(y[fold != 1])) == 2 else np.arange(len(y))
    if len(set(y[learn])) < 2:
        model = Model(np.zeros((ROWS, DIM), np.float32), [np.zeros((k, DIM, FILTERS), np.float32) for k in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), -1.0)
        return model
    model = fit([texts[i] for i in learn], y[learn])
    check = np.flatnonzero(fold == 1) if len(set(y[fold == 1])) == 2 else learn
    logits = np.array([model.logit(texts[i]) for i in check])
    calibrate(model, logits, y[check], np.array([_language_of_rows(texts[i]) for i in check]))
    return model


_LANG_OF_ROW = {word_rows(w)[0]: i for w, i in _LANG_OF.items()}


def _language_of_rows(rows: np.ndarray) -> int:
    votes = np.bincount([_LANG_OF_ROW[r] for r in rows[:, 0].tolist() if r in _LANG_OF_ROW] or [len(_COMMON)], minlength=len(LANGS))[:-1]
    return int(np.argmax(votes)) if votes.any() else len(LANGS) - 1


def toxicity_score(model: Model, text: str | Column) -> Column:
    """Score of each text from 0 to 1, 0.5 at the threshold of its language. Null counts as empty."""

    @F.arrow_udf(T.DoubleType())
    def scores(texts: pa.Array) -> pa.Array:
        words, out = _words(), []
        for t in texts:
            numbers = words.of(t.as_py() or "")
            out.append(model.score(model.logit(words.rows[numbers]), words.language(numbers)))
        return given_back(pa.array(out, pa.float64()))

    return scores(text)


_WORDS: list[Words] = []


def _words() -> Words:
    """One numbering per worker process, kept from batch to batch."""
    if not _WORDS:
        _WORDS.append(Words())
    return _WORDS[0]
