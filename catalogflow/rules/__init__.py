"""Rule tables kept as plain tab separated text, read once at plan time.

Every table here is a small fixed list (under 200 rows) that must match the
published data format. They end up as literals or local relations in the plan,
so their size is known before a query starts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from importlib.resources import files

_added: ContextVar[Mapping[str, tuple[tuple[str, ...], ...]]] = ContextVar("added", default={})


@contextmanager
def extended(added: Mapping[str, Sequence[Sequence[str]]]) -> Iterator[None]:
    """Expressions built inside see the rows of ``added`` (by table name) before those of the files, so where the first hit wins, they do.

    Extensions nest; the inner one comes first. Nothing is kept afterwards.
    """
    before = _added.get()
    rows = {name: tuple(map(tuple, new)) + before.get(name, ()) for name, new in added.items()}
    token = _added.set({**before, **rows})
    try:
        yield
    finally:
        _added.reset(token)


def added(name: str) -> tuple[tuple[str, ...], ...]:
    """The rows that extensions have added to a table."""
    return _added.get().get(name, ())


def table(name: str) -> tuple[tuple[str, ...], ...]:
    """Added rows, then those of ``<name>.tsv`` in file order."""
    return added(name) + _file(name)


@lru_cache(maxsize=None)
def _file(name: str) -> tuple[tuple[str, ...], ...]:
    """Rows of ``<name>.tsv`` in file order, comment lines left out."""
    text = (files(__name__) / f"{name}.tsv").read_text(encoding="utf-8")
    rows = []
    for line in text.split("\n"):
        if line and not line.startswith("# Fixed values"):
            rows.append(tuple(line.split("\t")))
    return tuple(rows)


def mapping(name: str) -> dict[str, str]:
    """Two-column table as a dict; a later row replaces an earlier one, and an added row any."""
    return {row[0]: row[1] for row in (*_file(name), *reversed(added(name)))}


def mapping_of_added(name: str) -> dict[str, str]:
    """The added rows alone, as a dict."""
    return {row[0]: row[1] for row in reversed(added(name))}
