"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.fixtures import FIXTURES
from sightline.session import configure

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages",
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SOURCE = re.compile(r"\b(from|join)(\s+)(\w+)", re.IGNORECASE)


def _references(sql: str) -> list[str]:
    return [m.group(3) for m in _SOURCE.finditer(sql) if m.group(3) in FIXTURES]


def _dialect(name: str, engine: str) -> str:
    text = FIXTURES[name]
    return (text if isinstance(text, str) else text[engine]).strip()


def with_fixtures(sql: str) -> str:
    """A SQL statement preceded by the fixtures it reads, as common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _references(text):
            if name not in order:
                visit(_dialect(name, "duckdb"))
                if name not in order:
                    order.append(name)

    sql = sql.strip()
    visit(sql)
    prelude = ",\n".join(f"{n} AS (\n{_dialect(n, 'duckdb')}\n)" for n in order)
    if not prelude:
        return sql
    if sql[:5].lower() == "with ":
        return f"WITH {prelude},\n{sql[5:]}"
    return f"WITH {prelude}\n{sql}"


class Tables:
    """Given tables and fixtures of one folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._load(name)
        return self._cache[name]

    def _load(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.sql(_dialect(name, "spark"))

    def sql(self, text: str) -> DataFrame:
        """Run a statement over given tables and fixtures."""
        used: dict[str, DataFrame] = {}
        escaped = text.replace("{", "{{").replace("}", "}}")

        def place(match: re.Match) -> str:
            name = match.group(3)
            if name not in FIXTURES and name not in BASE:
                return match.group(0)
            used[name] = getattr(self, name)
            return f"{match.group(1)}{match.group(2)}{{{name}}}"

        return self.spark.sql(_SOURCE.sub(place, escaped), **used)


def query(key: str, oracle: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a key, with its SQL counterpart."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        run.__name__ = key
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = with_fixtures(oracle)
        return build

    return register
