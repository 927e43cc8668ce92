"""Registered queries: an operator, the domain views it reads, and the same result in DuckDB's SQL.

Views turn the given tables into domain tables. Their text runs in Spark and in DuckDB; ``{name}`` is a table or another view.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
VIEWS: dict[str, str] = {}
DUCK: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _names(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)) if n in VIEWS or n in TABLES]


def _plain(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in VIEWS or m[1] in TABLES else m[0], sql)


def view(name: str, sql: str, duck: str | None = None) -> None:
    """``duck``: the text for DuckDB where the dialects differ."""
    VIEWS[name] = " ".join(sql.split())
    DUCK[name] = " ".join((duck or sql).split())


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder or a view over its tables."""
    if name in VIEWS:
        sql = VIEWS[name]
        return spark.sql(sql, **{n: read(spark, sf_dir, n) for n in _names(sql)})
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _needed(name: str, out: list[str]) -> None:
    if name in VIEWS and name not in out:
        for n in _names(DUCK[name]):
            _needed(n, out)
        out.append(name)


def oracle(sql: str) -> str:
    """DuckDB text: the views that ``{name}`` asks for as common table expressions, then the query."""
    needed: list[str] = []
    for n in _names(sql):
        _needed(n, needed)
    sql = _plain(sql.strip())
    ctes = [f"{n} AS ({_plain(DUCK[n])})" for n in needed]
    if re.match(r"WITH\s", sql):
        head, sql = re.match(r"WITH\s+(RECURSIVE\s+)?", sql)[0], re.sub(r"^WITH\s+(RECURSIVE\s+)?", "", sql)
        return f"WITH RECURSIVE {', '.join(ctes) + ', ' if ctes else ''}{sql}" if "RECURSIVE" in head or ctes else f"WITH {sql}"
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql


def query(*reads: str, sql: str | None = None, name: str | None = None):
    """Register ``f`` of the DataFrames named; ``sql`` is its equivalent over the same tables and views."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: f(*(read(spark, sf_dir, n) for n in reads))
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return f

    return register
