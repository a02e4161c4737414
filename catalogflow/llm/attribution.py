"""Token counts of the sections of a document (offset-mapped attribution).

A document is encoded whole, once. Each token has a span of characters; spans and sections are both
in order, so a search in the section bounds joins them. A token that crosses a bound goes to the
section that holds most of its characters, of several the earliest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch
from catalogflow.llm.tokens import encoder

_SCHEMA = "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
_ARROW = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])


def sections_of(text: str, pattern: str = "\n") -> np.ndarray:
    """Starts of the sections and, last, the end of the text; a section ends behind each match of ``pattern``."""
    bounds = [0, *(m.end() for m in re.finditer(pattern, text) if m.end() < len(text)), len(text)]
    return np.array(bounds, np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a bound."""
    first = np.searchsorted(bounds[1:-1], starts, "right")
    last = np.searchsorted(bounds[1:-1], ends - 1, "right")
    crossing = last > first
    owner = first.copy()
    for t in np.flatnonzero(crossing):
        held = [min(ends[t], bounds[s + 1]) - max(starts[t], bounds[s]) for s in range(first[t], last[t] + 1)]
        owner[t] = first[t] + int(np.argmax(held))
    return owner, crossing


def section_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", pattern: str = "\n", vocabulary: str | None = None) -> DataFrame:
    """One row per section: its bounds in characters, its tokens, and how many of those cross a bound.

    The tokens of all sections of a document add up to those of the document. Null and empty
    texts have one section without tokens. Repeated rows give repeated sections; columns other
    than the two named are not read.
    """

    def counted(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode = encoder(vocabulary)
        for doc, words in rows:
            bounds = sections_of(words or "", pattern)
            owner, crossing = allocate(*encode.spans(words or ""), bounds)
            tokens = np.bincount(owner, minlength=len(bounds) - 1).tolist()
            crossed = np.bincount(owner[crossing], minlength=len(bounds) - 1).tolist()
            at = bounds.tolist()
            for s in range(len(at) - 1):
                yield doc, s, at[s], at[s + 1], tokens[s], crossed[s]

    return by_batch(docs.select(F.col(doc_id).cast("long"), text), _SCHEMA, _ARROW, counted)
