"""Families added by a caller (extension point of F40-F44).

A family is rows for the rule tables, no code: where it is told from, its level-1 slug, and its attributes.

    with registered(Family("Relay", "relays", catalogs=("relay",), attributes=(Attribute("coil_v", "voltage", "1", ("线圈电压",)),))):
        rows = df.withColumn("family", detect_family(...))

Columns built inside know the family; the rule tables are the same as before afterwards.
"""

from __future__ import annotations

from contextlib import AbstractContextManager
from dataclasses import dataclass

from catalogflow import rules


@dataclass(frozen=True)
class Attribute:
    """A canonical key with the kind of its values (a parser of ``units``, or ``enum``), digits kept (or ``int``), and source keys by preference."""

    key: str
    kind: str
    rounding: str = ""
    sources: tuple[str, ...] = ()
    english: tuple[str, ...] = ()


@dataclass(frozen=True)
class Family:
    """What tells a family: parent catalogs (lower case, whole), patterns on catalog names and descriptions, source attribute keys; and its attributes.

    Signals count in the order of ``detect_family``, an added family before the others at each.
    """

    name: str
    l1: str
    parents: tuple[str, ...] = ()
    catalogs: tuple[str, ...] = ()
    descriptions: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    attributes: tuple[Attribute, ...] = ()


def registered(*families: Family) -> AbstractContextManager[None]:
    """A context in which expressions know ``families``; of several that claim the same signal the first given counts."""
    named = [f.name for f in families]
    if len(set(named)) < len(named):
        raise ValueError("a family is given twice")
    each = lambda what: [(x, f.name) for f in families for x in what(f)]
    return rules.extended({
        "family_l1": [(f.name, f.l1) for f in families],
        "parent_family": each(lambda f: f.parents), "catalog_patterns": each(lambda f: f.catalogs), "description_patterns": each(lambda f: f.descriptions),
        "attribute_fingerprint": each(lambda f: f.keys),
        "families": [(f.name, a.key, a.kind, a.rounding, "|".join(a.sources), "|".join(a.english or (a.key,))) for f in families for a in f.attributes],
    })
