"""Registered queries, one module per area."""

from __future__ import annotations

from importlib import import_module

AREAS = ("merge", "identity", "functions", "jobs", "extra", "files", "trees", "releases", "scans", "extension", "branches", "readers", "family", "integrity")


def load() -> None:
    for area in AREAS:
        import_module(f"catalogflow.queries.{area}")
