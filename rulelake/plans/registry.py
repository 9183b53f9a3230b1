"""All queries and SQL of the library's core."""

from __future__ import annotations

from . import base, candidates, changes, details, finding, history, judging, minutes, names, operations, pages, problems, scoring, sources, streams, texts  # noqa: F401


def queries() -> dict:
    return {**base.QUERIES, **problems.QUERIES}


def oracle_sql() -> dict:
    return {**base.SQL, **problems.SQL}
