"""Register a query under its name with the inventory lines it covers and its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from granary.session import configure, use_folder
from workload import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def as_doubles(df: DataFrame) -> DataFrame:
    """Exact decimals leave as doubles, a type both engines return alike."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in wide}) if wide else df


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with the ``fx_…`` tables it names and those they name in turn."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_(\w+)", text):
            if name not in order:
                visit(fixtures.SQL[name])
                order.append(name) if name not in order else None

    visit(body)
    tables = ",\n".join(f"fx_{n} AS ({fixtures.SQL[n]})" for n in order)
    body = body.strip()
    if not tables:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {tables},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {tables},\n{body[5:]}"
    return f"WITH {tables}\n{body}"


def query(covers: str, sql: str | None = None):
    """Decorator: the function's name becomes the query's name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_doubles(build(use_folder(configure(spark)), sf_dir))

        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return build

    return register
