"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

#: name -> (body, names it reads); composed into WITH clauses
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, body: str, *reads: str) -> None:
    """Declare a named sub-query for checks."""
    VIEWS[name] = (body, reads)


def sql(final: str, *reads: str) -> str:
    """A statement with the views it needs in front, each before its readers."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS[name][1]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        visit(name)
    clauses = ", ".join(f"{n} AS ({VIEWS[n][0]})" for n in ordered)
    return f"WITH RECURSIVE {clauses} {final}" if clauses else final  # recursive ones may be among them


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with its check if SQL can express one."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered already")
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add
