"""What the modules of queries share."""

from __future__ import annotations

from collections.abc import Callable


def collection() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """Queries by name, their SQL by name, and the decorator that puts a query, with its SQL if there is any, into both."""
    queries: dict[str, Callable] = {}
    sql_of: dict[str, str] = {}

    def query(sql: str | None = None):
        def put(f):
            queries[f.__name__] = f
            if sql:
                sql_of[f.__name__] = sql
            return f

        return put

    return queries, sql_of, query
