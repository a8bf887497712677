"""Where query modules put their queries and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.fixtures import FIXTURE_SQL, Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_fixtures(body: str, names: str) -> str:
    """A SQL query over the named fixtures, and those that they are made from, as common table expressions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in FIXTURE_SQL[name][0].split():
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    body = body.strip()
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n][1].strip()})" for n in wanted)
    if not ctes:
        return body
    return f"WITH {ctes}{',' + body[4:] if body.upper().startswith('WITH') else chr(10) + body}"


def query(name: str, sql: str | None = None, uses: str = "") -> Callable:
    """Register f(fixtures) under a name, with its SQL over the named fixtures."""

    def register(f: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_fixtures(sql, uses)
        return f

    return register
