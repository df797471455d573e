"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from .plans import base, events, items, landed, names, pages, profile, reports  # noqa: F401  each registers its queries


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
